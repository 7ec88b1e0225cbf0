"""Sinks and exports: versions, upserts and ontology documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.text import cypher_key, cypher_string, html_escape, safe_token
from tributary.operators.graph import inner_edges, named_edges


def stringified(df: DataFrame, drop: tuple[str, ...] = ("content",)) -> DataFrame:
    """Every column as text for a CSV export: null is empty, nested values are JSON, bytes their size."""
    out = []
    for f in df.schema.fields:
        if f.name in drop:
            continue
        c, kind = F.col(f"`{f.name}`"), f.dataType.typeName()
        text = F.to_json(c) if kind in ("struct", "array", "map") else F.concat(F.lit("<"), F.octet_length(c).cast("string"), F.lit(" bytes>")) if kind == "binary" else c.cast("string")
        out.append(F.coalesce(text, F.lit("")).alias(f.name))
    return df.select(*out)


def union_of(parts: list[DataFrame]) -> DataFrame:
    """Tables with different columns below each other, columns in order of first appearance."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def next_version(versions: DataFrame, dataset: Column | str, content: Column, prefix: int | None = None) -> DataFrame:
    """(dataset, version_no, checksum): one more than the last version, and a short hash of the content.

    ``prefix``: only of so many characters; the reference has 1,024.
    """
    last = F.max(content)
    return versions.groupBy(dataset).agg((F.max("version_no") + 1).alias("version_no"), F.substring(F.sha2(F.substring(last, 1, prefix) if prefix else last, 256), 1, 16).alias("checksum"))


def write_version(df: DataFrame, path: str, version_no: int) -> None:
    """A new immutable version of a dataset: its own partition, written once."""
    df.withColumn("version_no", F.lit(version_no)).write.partitionBy("version_no").mode("append").parquet(path)


def write_tables(tables: dict[str, DataFrame], path: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def upsert(base: DataFrame, updates: DataFrame, key: str = "id", properties: str | None = "properties") -> DataFrame:
    """Rows of ``updates`` replace or join those of ``base``; null values leave what is there, maps are merged, the update wins.

    Of repeated updates of a key the caller keeps one.
    """
    u = updates.select(F.col(key), *[F.col(c).alias(f"__{c}") for c in updates.columns if c != key], F.lit(True).alias("__new"))
    j = base.join(u, key, "full")

    def value(c: str) -> Column:
        if f"__{c}" not in j.columns:
            return F.col(c)
        if c == properties:
            empty = F.create_map().cast("map<string,string>")
            old, new = F.coalesce(F.col(c), empty), F.coalesce(F.col(f"__{c}"), empty)
            return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)
        return F.coalesce(F.col(f"__{c}"), F.col(c))

    return j.select(*[F.col(key) if c == key else value(c).alias(c) for c in base.columns])


def upsert_edges(edges: DataFrame, updates: DataFrame, vertices: DataFrame) -> DataFrame:
    """Edges upserted where both ends exist."""
    return upsert(edges, inner_edges(vertices, updates), "id", None)


def delete_scope(vertices: DataFrame, edges: DataFrame, ontology_id: str) -> tuple[DataFrame, DataFrame]:
    """A graph without one ontology's vertices and without every edge at them."""
    gone = vertices.filter(F.col("ontology_id") == ontology_id).select("id")
    left = edges.join(gone.withColumnRenamed("id", "source_entity"), "source_entity", "left_anti").join(gone.withColumnRenamed("id", "target_entity"), "target_entity", "left_anti")
    return vertices.filter(~F.col("ontology_id").eqNullSafe(F.lit(ontology_id))), left.select(*edges.columns)


def graph_nodes(vertices: DataFrame) -> DataFrame:
    """Vertices as graph nodes: properties overlaid by the canonical fields, the label upper-cased with underscores."""
    canon = F.create_map(F.lit("id"), F.col("id"), F.lit("name_cn"), F.coalesce("name_cn", F.lit("")), F.lit("ontology_id"), F.col("ontology_id"))
    props = F.map_filter(F.coalesce("properties", F.create_map().cast("map<string,string>")), lambda k, _: ~k.isin("id", "name_cn", "ontology_id"))
    return vertices.select("id", F.upper(F.regexp_replace(F.coalesce("type", F.lit("Entity")), r"[\s\-]+", "_")).alias("label"), F.map_concat(props, canon).alias("properties"))


def embedding_text(properties: str = "properties") -> Column:
    """What a vector is made from: names, type, description and properties, blanks skipped."""
    fields = [F.nullif(F.col(c), F.lit("")) for c in ("name_cn", "name_en", "type", "description")]
    return F.concat_ws(" ", *fields, F.when(F.size(properties) > 0, F.to_json(properties)))


def ontology_json(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(ontology_id, kind, document): one JSON text a record, relations with the names of their ends."""
    e = vertices.select("ontology_id", F.lit("entity").alias("kind"), F.to_json(F.struct("id", "name_cn", "name_en", "type", "confidence"), {"ignoreNullFields": "false"}).alias("document"))
    named = named_edges(vertices, edges)
    r = named.select("ontology_id", F.lit("relation").alias("kind"), F.to_json(F.struct("id", F.col("source_entity").alias("source_id"), F.col("target_entity").alias("target_id"), F.coalesce("source_name_cn", F.lit("")).alias("source_cn"), F.coalesce("target_name_cn", F.lit("")).alias("target_cn"), "type"), {"ignoreNullFields": "false"}).alias("document"))
    return e.unionByName(r)


def yaml_records(docs: DataFrame) -> DataFrame:
    """The same records as block YAML: one key a line, values as JSON scalars."""
    fields = F.from_json("document", "map<string,string>")
    lines = F.transform(F.map_entries(fields), lambda x: F.concat(x["key"], F.lit(": "), F.coalesce(F.concat(F.lit('"'), F.replace(F.replace(x["value"], F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"')), F.lit("null"))))
    return docs.select("ontology_id", "kind", F.concat(F.lit("- "), F.array_join(lines, "\n  ")).alias("document"))


def unified_csv(vertices: DataFrame, edges: DataFrame, rules: DataFrame, actions: DataFrame) -> DataFrame:
    """One table of all records: record_type, id, names, description, confidence, and the ends and type of relations."""
    blank = F.lit("")
    text = lambda c: F.coalesce(F.col(c), F.lit(""))

    def plain(df: DataFrame, kind: str) -> DataFrame:
        return df.select(F.lit(kind).alias("record_type"), "id", text("name_cn").alias("name_cn"), text("name_en").alias("name_en"), text("description").alias("description"), "confidence", blank.alias("source_cn"), blank.alias("target_cn"), blank.alias("relation_type"))

    n = named_edges(vertices, edges)
    s, t = F.coalesce("source_name_cn", F.lit("")), F.coalesce("target_name_cn", F.lit(""))
    r = n.select(F.lit("relation").alias("record_type"), "id", blank.alias("name_cn"), blank.alias("name_en"), F.concat(s, F.lit(" -> "), t).alias("description"), "confidence", s.alias("source_cn"), t.alias("target_cn"), F.col("type").alias("relation_type"))
    return plain(vertices, "entity").unionByName(r).unionByName(plain(rules, "logic_rule")).unionByName(plain(actions, "action"))


def turtle(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(triple) lines: a class for each entity, an object property for each relation type, a triple for each edge with both ends."""
    esc = lambda c: F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit("\n"), F.lit("\\n"))
    ent = lambda c: F.concat(F.lit(":entity_"), safe_token(c))
    rel = F.concat(F.lit(":rel_"), safe_token(F.col("type")))
    line = lambda *x: F.concat(*x, F.lit(" ."))
    classes = vertices.select(line(ent(F.col("id")), F.lit(" a owl:Class")).alias("triple"))
    labels = vertices.filter("name_cn is not null").select(line(ent(F.col("id")), F.lit(' rdfs:label "'), esc(F.col("name_cn")), F.lit('"@zh')).alias("triple"))
    english = vertices.filter("name_en is not null and name_en <> ''").select(line(ent(F.col("id")), F.lit(' rdfs:label "'), esc(F.col("name_en")), F.lit('"@en')).alias("triple"))
    kinds = edges.select(line(rel, F.lit(" a owl:ObjectProperty")).alias("triple")).distinct()
    facts = inner_edges(vertices, edges).select(line(ent(F.col("source_entity")), F.lit(" "), rel, F.lit(" "), ent(F.col("target_entity"))).alias("triple"))
    return classes.unionAll(labels).unionAll(english).unionAll(kinds).unionAll(facts).distinct()


def cypher(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(ord, statement): MERGE statements of nodes, then of relationships."""
    prop = lambda k, v: F.concat(cypher_key(F.lit(k)), F.lit(": "), v)
    num = F.coalesce(F.col("confidence").cast("string"), F.lit("null"))
    base = F.concat_ws(", ", prop("id", cypher_string(F.col("id"))), prop("name_cn", cypher_string(F.coalesce("name_cn", F.lit("")))), prop("name_en", cypher_string(F.coalesce("name_en", F.lit("")))), prop("confidence", num))
    nodes = vertices.select(F.lit(1).alias("ord"), F.concat(F.lit("MERGE (n:"), F.regexp_replace(F.coalesce("type", F.lit("Entity")), r"(?U)[^\w]", "_"), F.lit(" {id: "), cypher_string(F.col("id")), F.lit("}) SET n += {"), base, F.lit("};")).alias("statement"))
    rels = edges.select(
        F.lit(2).alias("ord"),
        F.concat(F.lit("MATCH (a {id: "), cypher_string(F.col("source_entity")), F.lit("}), (b {id: "), cypher_string(F.col("target_entity")), F.lit("}) MERGE (a)-[r:"), F.upper(F.regexp_replace(F.coalesce("type", F.lit("RELATED_TO")), r"(?U)[^\w]", "_")), F.lit("]->(b) SET r += {confidence: "), num, F.lit("};")).alias("statement"),
    )
    return nodes.unionByName(rels)


def edge_label_pairs(vertices: DataFrame, edges: DataFrame) -> DataFrame:
    """(type, source_label, target_label): the first pair of labels of each edge type, for a bulk import's header."""
    n = named_edges(vertices, edges, ("id", "type")).filter("source_id is not null and target_id is not null")
    return n.groupBy("type").agg(F.min_by(F.struct("source_type", "target_type"), "id").alias("p")).select("type", F.col("p.source_type").alias("source_label"), F.col("p.target_type").alias("target_label"))


def bulk_import(vertices: DataFrame, edges: DataFrame, path: str) -> None:
    """One CSV folder for each vertex label and each edge type."""
    stringified(vertices.select("id", "name_cn", "name_en", "description", "confidence", F.coalesce("type", F.lit("Entity")).alias("label"))).write.partitionBy("label").mode("overwrite").option("header", True).csv(f"{path}/vertices")
    stringified(inner_edges(vertices, edges).select("id", "source_entity", "target_entity", "confidence", F.coalesce("type", F.lit("RELATED")).alias("label"))).write.partitionBy("label").mode("overwrite").option("header", True).csv(f"{path}/edges")


def html_rows(vertices: DataFrame) -> DataFrame:
    cells = [F.concat(F.lit("<td>"), html_escape(F.col(c).cast("string")), F.lit("</td>")) for c in ("id", "name_cn", "name_en", "type")]
    return vertices.select("id", F.concat(F.lit("<tr>"), *cells, F.lit("</tr>")).alias("html"))
