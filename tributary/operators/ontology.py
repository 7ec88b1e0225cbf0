"""Building a whole ontology from mapped datasets: concepts, instances, relations, rules, actions, texts for vectors."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import relation_id, row_id, strip
from tributary.operators import links, mapping
from tributary.operators.profiling import alternate_keys_of

RELATION = "id string, source string, target string, type string, confidence double, origin string"


@dataclass
class Dataset:
    name: str
    df: DataFrame
    mapping: dict
    #: Columns that describe a document as a whole, which relate nothing.
    document_columns: tuple[str, ...] = ("source_file", "doc_summary", "sections")
    facts: dict = field(default_factory=dict)


def prepared(d: Dataset) -> Dataset:
    """The dataset with missing columns mapped, its key repaired and its columns profiled."""
    full = mapping.suggest(d.name, d.df.columns)
    m = {**full, **d.mapping, "properties": {**full["properties"], **d.mapping.get("properties", {})}}
    facts = mapping.facts_of(d.df, d.df.columns)
    m["primary_key"] = mapping.repaired_key(m, d.df, facts)
    return Dataset(d.name, d.df, m, d.document_columns, facts)


def _row(ontology: str, d: Dataset, key: Column) -> Column:
    return row_id(F.lit(ontology), F.lit(d.mapping["entity_class"]), F.concat(F.lit(f"{d.mapping['primary_key']}:"), key.cast("string")))


def pair_relations(ontology: str, s: Dataset, t: Dataset, candidates: list[dict] | None = None) -> list[DataFrame]:
    """Relations from one dataset to another: foreign keys first, then shared columns, then alternate keys; a column relates once."""
    sp, tp = s.mapping["primary_key"], t.mapping["primary_key"]
    if "__row_hash__" in (sp, tp):
        return []
    out, used = [], {sp, *s.document_columns}

    def add(pairs: DataFrame, kind: str, origin: str) -> None:
        ids = pairs.select(_row(ontology, s, F.col("source")).alias("source"), _row(ontology, t, F.col("target")).alias("target")).distinct()
        out.append(ids.select(relation_id(F.lit(ontology), F.col("source"), F.lit(kind), F.col("target"), F.lit(origin)).alias("id"), "source", "target", F.lit(kind).alias("type"), F.lit(links.CONFIDENCE[origin]).alias("confidence"), F.lit(origin).alias("origin")))

    for c in mapping.fk_candidates(s.df, s.name, t.df, t.name, tp, sp) if candidates is None else candidates:
        p = links.exact_or_normal(s.df.select(sp, c["column"]), c["column"], t.df.select(tp), tp)
        add(p.select(F.col(sp).alias("source"), F.col("target_key").alias("target")), c["relation"], "fk")
        used.add(c["column"])
    kind = f"HAS_{t.name.upper().rstrip('S')}"
    for c in links.same_name_columns(s.df.columns, t.df.columns):
        if c not in used and t.facts[c]["distinct_count"] >= 2:
            add(links.same_name_join(s.df, sp, t.df, tp, c), kind, "same_name")
            used.add(c)
    for alternate in alternate_keys_of(t.facts, [c for c in t.df.columns if c != tp]):
        for c in s.df.columns:
            if c not in used and s.df.schema[c].dataType.typeName() == "string" and s.facts[c]["distinct_count"] > 1:
                add(links.alternate_key_join(s.df, sp, c, t.df, tp, alternate), kind, "alt_key")
    return out


def link_relations(ontology: str, by_name: dict[str, Dataset], link: dict) -> DataFrame:
    """Relations of an explicit, active link: trimmed keys that are equal."""
    s, t = by_name[link["source"]], by_name[link["target"]]
    a = s.df.select(F.col(s.mapping["primary_key"]).alias("source"), strip(F.col(link["src_key"]).cast("string")).alias("k"))
    b = t.df.select(F.col(t.mapping["primary_key"]).alias("target"), strip(F.col(link["tgt_key"]).cast("string")).alias("k"))
    p = a.join(b, "k").select(_row(ontology, s, F.col("source")).alias("source"), _row(ontology, t, F.col("target")).alias("target")).distinct()
    return p.select(relation_id(F.lit(ontology), F.col("source"), F.lit(link["relation"]), F.col("target"), F.lit("link")).alias("id"), "source", "target", F.lit(link["relation"]).alias("type"), F.lit(links.CONFIDENCE["link"]).alias("confidence"), F.lit("link").alias("origin"))


def build_all(spark, ontology: str, datasets: list[Dataset], explicit: list[dict] | None = None) -> dict[str, DataFrame]:
    """Everything of an ontology as lazy tables by name, with ``summary`` counting them.

    Each dataset is profiled once; one aggregation for each source decides which of its columns relate to
    which other dataset, and each accepted column is one join. Ids are stable, so that a rebuild changes nothing.
    """
    ready = [prepared(d) for d in datasets]
    by_name = {d.name: d for d in ready}
    instances = None
    for d in ready:
        one = mapping.instances(d.df, ontology, d.mapping)
        instances = one if instances is None else instances.unionByName(one)
    relations = spark.createDataFrame([], RELATION)
    found: list[dict] = []
    keyed = [t for t in ready if t.mapping["primary_key"] != "__row_hash__"]
    for s in ready:
        others = [(t.name, t.df, t.mapping["primary_key"]) for t in keyed if t is not s]
        candidates = mapping.fk_candidates_of(s.df, s.name, others, s.mapping["primary_key"]) if others and s in keyed else {}
        for t in ready:
            if s is not t:
                for r in pair_relations(ontology, s, t, candidates.get(t.name, [])):
                    relations = relations.unionByName(r)
                    found.append({"source": s.name, "relation": f"HAS_{t.name.upper().rstrip('S')}", "target": t.name})
    for x in explicit or []:
        if x.get("status", "active") == "active":
            relations = relations.unionByName(link_relations(ontology, by_name, x))
    concepts = mapping.concepts(spark, ontology, [d.mapping["entity_class"] for d in ready])
    rules = [{"entity_class": d.mapping["entity_class"], **r} for d in ready for r in mapping.discover_rules(d.mapping, d.facts, {}, [f for f in found if f["source"] == d.name])]
    actions = mapping.discover_actions([d.mapping["entity_class"] for d in ready], {}, [c for d in ready for c in d.df.columns if c.endswith("_at")], found)
    out = {
        "concepts": concepts,
        "instances": instances,
        "relations": relations.dropDuplicates(["id"]),
        "rules": spark.createDataFrame([(r["name"], r["logic_type"]) for r in rules], "name string, logic_type string"),
        "actions": spark.createDataFrame([(a["name"], a["effect"]) for a in actions], "name string, effect string"),
        "texts": concepts.select("id", F.col("entity_class").alias("text")),
    }
    summary = None
    for name, df in out.items():
        one = df.agg(F.lit(name).alias("part"), F.count("*").alias("n"))
        summary = one if summary is None else summary.unionByName(one)
    return out | {"summary": summary}


#: Columns that name a row, tried in order.
NAME_COLUMNS = ["name_cn", "name", "title", "名称", "订单号", "filename"]


def display_name(columns: list[str], entity_class: str, pk: str | None, ordinal: Column) -> Column:
    """A row's name: its key (unless that is a hash), the first name-like column, else the class and an ordinal; 200 characters at most."""
    text = lambda c: F.nullif(strip(F.col(f"`{c}`").cast("string")), F.lit(""))
    named = [c for c in columns if any(x in c.lower() for x in ("name", "title", "名称"))]
    order = [*[c for c in NAME_COLUMNS if c in columns], *named, *([pk] if pk and pk != "__row_hash__" else [])]
    return F.left(F.coalesce(*[text(c) for c in dict.fromkeys(order)], F.concat(F.lit(f"{entity_class} #"), ordinal.cast("string"))), F.lit(200))

