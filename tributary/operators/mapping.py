"""Curated tables to entity instances and relations: suggestions, stable ids, inferred keys, discovered rules and actions."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.functions.text import concept_id, key_normal, relation_id, row_id, row_identity
from tributary.plans.durable import cut
from tributary.operators.links import CONFIDENCE, exact_or_normal
from tributary.operators.profiling import choose_key, guess_type, key_facts


def camel(name: str) -> str:
    return "".join(p.capitalize() for p in re.split(r"[_\-\s]+", name) if p)


def suggest(dataset: str, columns: list[str]) -> dict:
    """A mapping by rule: class name, key and properties from names."""
    pk = next((c for c in columns if c.lower() in ("id", f"{dataset.lower()}_id")), columns[0] if columns else None)
    return {"entity_class": camel(dataset), "primary_key": pk, "properties": {c: (c.lower().replace(" ", "_"), guess_type(c)) for c in columns}, "confidence": 0.6}


def suggest_or(dataset: str, columns: list[str], model=None) -> dict:
    """An injected suggestion, the rules where there is none or it fails."""
    try:
        return (model and model(dataset, columns)) or suggest(dataset, columns)
    except Exception:  # noqa: BLE001
        return suggest(dataset, columns)


def suggest_links(dataset: str, columns: list[str], targets: list[str]) -> list[dict]:
    """Links from ``_id`` columns to tables whose singular name they hold."""
    out = []
    for c in columns:
        for t in targets:
            one = t.lower().rstrip("s")
            if t != dataset and c.lower().endswith("_id") and one in c.lower():
                out.append({"source": dataset, "column": c, "target": t, "relation": f"HAS_{one.upper()}", "confidence": 0.85})
    return out


def facts_of(df: DataFrame, columns: list[str]) -> dict[str, dict]:
    """Key facts of a table's columns: one row a column, so that it may come to the driver."""
    return {r.column_name: r.asDict() for r in key_facts(df, columns).collect()}


def repaired_key(mapping: dict, df: DataFrame, facts: dict[str, dict] | None = None) -> str:
    """The mapping's key if it is unique, or an order class whose rows all have one; else the best other."""
    pk, cols = mapping.get("primary_key"), df.columns
    facts = facts_of(df, cols) if facts is None else facts
    if pk == "__row_hash__":
        return pk
    if pk in facts:
        f = facts[pk]
        full = f["filled"] == f["rows"]
        if full and (f["distinct_count"] == f["rows"] or re.search("order|订单", mapping["entity_class"], re.IGNORECASE)):
            return pk
    return choose_key(facts, cols)


def instances(df: DataFrame, ontology: str, mapping: dict, order: str | None = None) -> DataFrame:
    """(id, ontology_id, entity_class, identity, row_data): a stable instance for each identity; of repeated ones the last in order, of equals the greatest text."""
    pk = mapping["primary_key"]
    shown = {c: p[0] for c, p in mapping["properties"].items() if not c.startswith("__")}
    data = F.map_filter(F.create_map(*[x for c, p in shown.items() for x in (F.lit(p), F.col(f"`{c}`").cast("string"))]), lambda _, v: v.isNotNull())
    rows = df.select(row_identity(pk, df.columns).alias("identity"), data.alias("row_data"), (F.col(order) if order else F.lit(0)).alias("__o"))
    one = rows.groupBy("identity").agg(F.max_by("row_data", F.struct("__o", F.to_json("row_data"))).alias("row_data"), F.count("*").alias("source_row_count"))
    return one.select(row_id(F.lit(ontology), F.lit(mapping["entity_class"]), F.col("identity")).alias("id"), F.lit(ontology).alias("ontology_id"), F.lit(mapping["entity_class"]).alias("entity_class"), "identity", "row_data", "source_row_count")


def concepts(spark, ontology: str, classes: list[str]) -> DataFrame:
    """One concept a class, with a stable id."""
    df = spark.createDataFrame([(c,) for c in classes], "entity_class string").distinct()
    return df.select(concept_id(F.lit(ontology), F.col("entity_class")).alias("id"), F.lit(ontology).alias("ontology_id"), "entity_class")


def _tokens(name: str) -> list[str]:
    return [t for t in re.split(r"[_\W]+", re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name).lower()) if len(t) > 1]


def name_affinity(column: str, target: str, prefix: str = "") -> bool:
    """Whether a column's name, without the table's prefix and ``key`` or ``id``, names the target."""
    bare = re.sub(r"(_?key|_?id)$", "", column.lower().removeprefix(prefix))
    t = target.lower().rstrip("s")
    return bool(bare) and (bare == t or bare in t or t in bare)


def fk_candidates(source: DataFrame, source_name: str, target: DataFrame, target_name: str, target_pk: str, own_pk: str | None = None) -> list[dict]:
    """Columns of ``source`` that may hold keys of ``target``: by name suffix, shared word, value overlap or id pattern."""
    return fk_candidates_of(source, source_name, [(target_name, target, target_pk)], own_pk)[target_name]


def fk_candidates_of(source: DataFrame, source_name: str, targets: list[tuple[str, DataFrame, str]], own_pk: str | None = None) -> dict[str, list[dict]]:
    """The candidate columns of ``source`` for each target (name, table, key).

    The distinct values of all columns meet the tagged keys of all targets in one join, so that a source is
    read once however many targets there are. Numeric keys overlap by chance, so they also need a name that
    names the target.
    """
    cols = [c for c in source.columns if c != own_pk]
    keys = None
    for name, df, pk in targets:
        own = df.select(key_normal(F.col(pk).cast("string")).alias("k")).filter("k <> ''").distinct().select("k", F.lit(name).alias("target"))
        keys = own if keys is None else keys.unionAll(own)
    values = source.unpivot([], [F.col(f"`{c}`").cast("string").alias(c) for c in cols], "column_name", "value").filter("trim(value) <> ''").select("column_name", key_normal(F.col("value")).alias("k")).distinct()
    facts = values.groupBy("column_name").agg(F.count("*").alias("distinct"), F.sum(F.col("k").rlike("^[0-9]+$").cast("int")).alias("numeric"), F.sum(F.col("k").rlike("^[A-Z]+[0-9]+$").cast("int")).alias("ids"))
    hits = values.join(keys, "k").groupBy("column_name", "target").agg(F.count("*").alias("hits"))
    prefix = _prefix(source.columns)
    out: dict[str, list[dict]] = {name: [] for name, _, _ in targets}
    for r in hits.join(facts, "column_name").orderBy("target", "column_name").collect():  # one row a column and target
        c, named = r.column_name, name_affinity(r.column_name, r.target, prefix)
        overlap = r.hits >= 2 and r.hits * 2 >= r.distinct
        if named and re.search(r"(_id|Id|ID|key)$", c):
            how = "name"
        elif set(_tokens(c)) & set(_tokens(r.target)):
            how = "word"
        elif overlap and r.numeric < r.distinct:
            how = "values"
        elif r.ids >= 2 and overlap:
            how = "pattern"
        else:
            continue
        out[r.target].append({"column": c, "how": how, "relation": f"HAS_{r.target.upper().rstrip('S')}", "hits": r.hits, "source": source_name, "target": r.target})
    return out


def _prefix(columns: list[str]) -> str:
    m = re.match(r"^[a-z]{1,2}_", columns[0]) if columns else None
    return m[0] if m and all(c.startswith(m[0]) for c in columns) else ""


def infer_relations(source: DataFrame, source_class: str, source_pk: str, target: DataFrame, target_class: str, target_pk: str, candidates: list[dict], ontology: str, grain: str = "instance") -> DataFrame:
    """(id, source, target, type, confidence, column): the relations of accepted candidates, exact matches before normalised ones.

    ``grain`` is instance (row to row) or concept (class to class).
    """
    out = None
    for c in candidates:
        pairs = exact_or_normal(source.select(source_pk, c["column"]), c["column"], target.select(target_pk), target_pk)
        s, t = row_id(F.lit(ontology), F.lit(source_class), F.concat(F.lit(f"{source_pk}:"), F.col(source_pk).cast("string"))), row_id(F.lit(ontology), F.lit(target_class), F.concat(F.lit(f"{target_pk}:"), F.col("target_key")))
        if grain == "concept":
            s, t = concept_id(F.lit(ontology), F.lit(source_class)), concept_id(F.lit(ontology), F.lit(target_class))
        p = pairs.select(s.alias("source"), t.alias("target")).distinct()
        r = p.select(relation_id(F.lit(ontology), F.col("source"), F.lit(c["relation"]), F.col("target"), F.lit("fk_inference")).alias("id"), "source", "target", F.lit(c["relation"]).alias("type"), F.lit(CONFIDENCE["fk"]).alias("confidence"), F.lit(c["column"]).alias("column"))
        out = r if out is None else out.unionByName(r)
    return out.dropDuplicates(["id"]) if out is not None else source.sparkSession.createDataFrame([], "id string, source string, target string, type string, confidence double, column string")


def discover_rules(mapping: dict, facts: dict[str, dict], states: dict[str, list[str]], relations: list[dict]) -> list[dict]:
    """Mapping, completeness, contract, state and inference rules, and one automation, from what profiling knows."""
    cls = mapping["entity_class"]
    out = [{"name": f"{cls} mapping", "logic_type": "mapping", "expression": {"target": cls}}]
    out += [{"name": f"{cls}.{c} required", "logic_type": "validation", "expression": {"column": c, "missing_count": f["rows"] - f["filled"]}} for c, f in facts.items() if f["rows"] > f["filled"]]
    out.append({"name": f"{cls} contract", "logic_type": "validation", "expression": {"properties": {c: t for c, (_, t) in mapping["properties"].items()}}})
    out += [{"name": f"{cls}.{c} states", "logic_type": "state", "expression": {"state_property": c, "states": s}} for c, s in states.items()]
    out += [{"name": f"{r['source']} {r['relation']} {r['target']}", "logic_type": "inference", "expression": {"src": r["source"], "rel_type": r["relation"], "tgt": r["target"]}} for r in relations]
    out.append({"name": f"{cls} refresh", "logic_type": "automation", "expression": {"trigger": "dataset_version", "effect": "apply_mapping"}})
    return out


def discover_actions(classes: list[str], states: dict[str, list[str]], timestamps: list[str], relations: list[dict], most: int | None = None) -> list[dict]:
    """Create and update for each class, state changes, timestamp updates, link and unlink, three generic ones.

    At ``most`` so many timestamp updates; the reference has three.
    """
    out = [{"name": f"{verb} {c}", "effect": e} for c in classes for verb, e in (("Create", "create_object"), ("Update", "set_property"))]
    out += [{"name": f"Change {s}", "effect": "set_property"} for s in states]
    out += [{"name": f"Set {t}", "effect": "set_property"} for t in timestamps[:most]]
    out += [{"name": f"{verb} {r['source']} {r['target']}", "effect": e} for r in relations for verb, e in (("Link", "merge_relationship"), ("Unlink", "delete_relationship"))]
    return out + [{"name": n, "effect": e} for n, e in (("Annotate", "set_property"), ("Approve", "set_property"), ("Archive", "set_property"))]


def insert_new(existing: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """``existing`` with those rows whose keys it does not have."""
    return existing.unionByName(rows.dropDuplicates(keys).join(existing.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def link_plan(matches: DataFrame, anchored: DataFrame, min_auto: float = 0.85, min_review: float = 0.60) -> DataFrame:
    """(orphan, anchor, action): merge into an anchor that is in the graph, promote where it is not, or review, or skip."""
    have = anchored.select(F.col("id").alias("anchor"), F.lit(True).alias("there"))
    go = F.when(F.col("there"), "merge").otherwise("promote")
    return matches.join(have, "anchor", "left").select("orphan", "anchor", "score", "method", F.when(F.col("score") >= min_auto, go).when(F.col("score") >= min_review, "review").otherwise("skip").alias("action"))


def apply_plan(vertices: DataFrame, edges: DataFrame, plan: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Merged orphans are gone, their edges go to the anchor, its blanks are filled; loops and repeated edges are dropped.

    Of repeated edges the one with the smallest id stays; an edge with a null end is neither loop nor repeat and stays.
    The plan is worked out once, here: four joins read it.
    """
    to = cut(plan.filter("action = 'merge'").select(F.col("orphan").alias("old"), F.col("anchor").alias("new")))
    e = edges
    for end in ("source_entity", "target_entity"):
        e = e.join(to.withColumnRenamed("old", end), end, "left").withColumn(end, F.coalesce("new", end)).drop("new")
    open_ = F.col("source_entity").isNull() | F.col("target_entity").isNull()
    e = e.filter(open_ | (F.col("source_entity") != F.col("target_entity"))).withColumn("__own", F.when(open_, F.col("id")))
    e = e.withColumn("__n", F.row_number().over(Window.partitionBy("source_entity", "target_entity", "type", "__own").orderBy("id"))).filter("__n = 1").select(*edges.columns)
    gone = vertices.join(to.select(F.col("old").alias("id"), "new"), "id")
    fill = gone.groupBy(F.col("new").alias("id")).agg(*[F.max_by(c, F.struct(F.col(c).isNotNull(), "id")).alias(f"__{c}") for c in ("name_en", "description")])
    v = vertices.join(to.select(F.col("old").alias("id")), "id", "left_anti").join(fill, "id", "left")
    return v.select(*[F.coalesce(F.nullif(F.col(c), F.lit("")), f"__{c}").alias(c) if c in ("name_en", "description") else F.col(c) for c in vertices.columns]), e


def verdict(names: DataFrame, name: str, known: DataFrame, known_name: str, known_id: str) -> DataFrame:
    """(name, verdict): MATCHED by one, AMBIGUOUS by several, UNMATCHED by none."""
    n = known.groupBy(F.col(known_name).alias("k")).agg(F.count_distinct(known_id).alias("n"))
    a = names.select(F.col(name).alias("name")).distinct()
    return a.join(n, a["name"] == n["k"], "left").select("name", F.when(F.col("n").isNull(), "UNMATCHED").when(F.col("n") == 1, "MATCHED").otherwise("AMBIGUOUS").alias("verdict"))


def target_violations(kind: Column, value: Column, low: Column, high: Column) -> Column:
    """What a target lacks for its type, as an array of texts: ranges need ordered bounds and no value, others a value and no bounds."""
    is_range = kind == "RANGE"
    out = [F.when(is_range & (low.isNull() | high.isNull()), "bounds required"), F.when(is_range & value.isNotNull(), "value forbidden"), F.when(is_range & (low > high), "bounds reversed"), F.when(~is_range & value.isNull(), "value required"), F.when(~is_range & (low.isNotNull() | high.isNotNull()), "bounds forbidden")]
    return F.filter(F.array(*out), lambda x: x.isNotNull())


def calculated(links: DataFrame, values: DataFrame) -> DataFrame:
    """(parent, value) of metrics made from others: signed sums of ADDEND and SUBTRAHEND, ratios of NUMERATOR and DENOMINATOR."""
    j = links.join(values, "child")
    part = lambda role: F.sum(F.when(F.col("role") == role, F.col("value")))
    a = j.groupBy("parent").agg(part("ADDEND").alias("a"), part("SUBTRAHEND").alias("s"), part("NUMERATOR").alias("n"), part("DENOMINATOR").alias("d"))
    total = F.coalesce("a", F.lit(0.0)) - F.coalesce("s", F.lit(0.0))
    return a.select("parent", F.when(F.col("d").isNotNull(), F.try_divide("n", "d")).otherwise(total).alias("value"))
