"""Joins that infer relations: foreign keys, same names, alternate keys, names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.functions.text import key_normal, name_normal, relation_id, shared_characters, split_cell, strip
from tributary.operators.near_names import best_partners

#: Confidence of a relation by how it was found.
CONFIDENCE = {"fk": 0.85, "same_name": 0.80, "alt_key": 0.75, "link": 0.90}


def exact_or_normal(source: DataFrame, fk: str, target: DataFrame, pk: str) -> DataFrame:
    """(source columns, target key, how): the exact match of a key, else the match of its normal form."""
    t = target.select(F.col(pk).cast("string").alias("__pk")).distinct()
    exact = t.select(F.col("__pk").alias("__exact"))
    normal = t.groupBy(key_normal(F.col("__pk")).alias("__n")).agg(F.min("__pk").alias("__near"))
    v = F.col(fk).cast("string")
    j = source.join(exact, v == F.col("__exact"), "left").join(normal, key_normal(v) == F.col("__n"), "left")
    found = F.coalesce("__exact", "__near")
    return j.filter(found.isNotNull()).select(*source.columns, found.alias("target_key"), F.when(F.col("__exact").isNotNull(), "exact").otherwise("normal").alias("how"))


#: Parts of a column name that make it look like a reference.
REFERENCE_NAMES = r"(?i)(^id$|_id$|id$|编号|编码|号|单号|订单)"


def same_name_columns(source: list[str], target: list[str]) -> list[str]:
    import re

    return [c for c in source if c in target and re.search(REFERENCE_NAMES, c)]


def same_name_join(source: DataFrame, source_id: str, target: DataFrame, target_id: str, column: str) -> DataFrame:
    """(source, target): rows that share a value of a column both have; the last target row of a value counts."""
    v = key_normal(F.col(column).cast("string"))
    t = target.filter(F.trim(F.col(column).cast("string")) != "").groupBy(v.alias("k")).agg(F.max(target_id).alias("target"))
    s = source.select(F.col(source_id).alias("source"), v.alias("k"))
    return s.join(t, "k").select("source", "target").distinct()


def alternate_key_join(source: DataFrame, source_id: str, column: str, target: DataFrame, target_id: str, key: str) -> DataFrame:
    """(source, target): parts of a cell that holds several values found among a near-unique text column."""
    parts = source.select(F.col(source_id).alias("source"), F.explode(split_cell(F.col(column))).alias("part")).select("source", key_normal(F.col("part")).alias("k")).filter(F.length("k") >= 3)
    t = target.groupBy(key_normal(F.col(key)).alias("k")).agg(F.max(target_id).alias("target"))
    return parts.join(t, "k").select("source", "target").distinct()


def broken_list_references(rows: DataFrame, key: str, lists: str, known: DataFrame) -> DataFrame:
    """(key, broken): members of a list that are not known, in order."""
    x = rows.select(key, F.posexplode(lists).alias("p", "ref")).filter("ref is not null")
    miss = x.join(known.select(F.col(known.columns[0]).alias("ref")).distinct(), "ref", "left_anti")
    return miss.groupBy(key).agg(F.transform(F.sort_array(F.collect_list(F.struct("p", "ref"))), lambda s: s["ref"]).alias("broken"))


def missing_relations(vertices: DataFrame, edges: DataFrame, patterns: list[tuple[str, str, str]], limit: int | None = None) -> DataFrame:
    """(source, target, type): pairs of one ontology whose types fit a pattern (source part, target part, type) and that no edge joins.

    Types are matched first, a handful of distinct values, so that only fitting vertices are joined by equality.
    ``limit``: only the first so many; the reference has 20.
    """
    spark = vertices.sparkSession
    pats = spark.createDataFrame(patterns, "source_part string, target_part string, relation string")
    kinds = vertices.select("type").distinct().filter("type is not null")
    s = kinds.join(pats, F.expr("contains(type, source_part)")).select(F.col("type").alias("source_type"), "target_part", "relation")
    fits = s.join(kinds.withColumnRenamed("type", "target_type"), F.expr("contains(target_type, target_part)")).select("source_type", "target_type", "relation")
    a = vertices.select(F.col("id").alias("source"), "ontology_id", F.col("type").alias("source_type")).join(fits, "source_type")
    b = vertices.select(F.col("id").alias("target"), "ontology_id", F.col("type").alias("target_type"))
    pairs = a.join(b, ["ontology_id", "target_type"]).filter("source <> target").select("source", "target", "relation")
    have = edges.select(F.col("source_entity").alias("source"), F.col("target_entity").alias("target"))
    open_ = pairs.join(have, ["source", "target"], "left_anti").distinct()
    return open_.orderBy("source", "target", "relation").limit(limit) if limit else open_


def name_grams(c: Column, n: int = 2) -> Column:
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(c) - (n - 1))), lambda i: F.substring(c, i, F.lit(n))))


def resolve_names(names: DataFrame, name: str, known: DataFrame, known_name: str, known_id: str) -> DataFrame:
    """(name, id): the exact name, else the known one that contains it or is contained, with most shared characters.

    A name that contains another shares all its two-character grams, so candidates come from an
    equality join on one rare gram each way instead of comparing all pairs.
    """
    asked = names.select(F.col(name).alias("name")).filter("name <> ''").distinct()
    have = known.select(F.col(known_name).alias("k"), F.col(known_id).alias("id")).filter("k <> ''").groupBy("k").agg(F.min("id").alias("id"))
    exact = asked.join(have, asked["name"] == have["k"]).select("name", "id", F.lit(1 << 30).alias("score"))
    rest = asked.join(have.select(F.col("k").alias("name")), "name", "left_anti")
    grams = lambda df, c: df.withColumn("g", F.explode(name_grams(F.col(c))))
    gh, gr = grams(have, "k"), grams(rest, "name")
    seldom = lambda g, by: g.join(g.groupBy("g").agg(F.count("*").alias("n")), "g").groupBy(*by).agg(F.min_by("g", F.struct("n", "g")).alias("g"))
    inside = seldom(gr, ["name"]).join(gh, "g").filter(F.contains(F.col("k"), F.col("name")))
    around = seldom(gh, ["k", "id"]).join(gr, "g").filter(F.contains(F.col("name"), F.col("k")))
    near = inside.select("name", "k", "id").unionByName(around.select("name", "k", "id")).distinct().select("name", "id", shared_characters(F.col("name"), F.col("k")).alias("score"), "k")
    best = near.groupBy("name").agg(F.max_by("id", F.struct(F.col("score"), F.col("k"))).alias("id"))
    return exact.select("name", "id").unionByName(best)


def anchor_matches(orphans: DataFrame, anchors: DataFrame, least_ratio: float = 0.85) -> DataFrame:
    """(orphan, anchor, method, score): the best of exact name, exact English name, substring and edit ratio.

    Orphans and anchors have id, name_cn, name_en, type; only equal types match. Of equal scores the first method and
    the smallest anchor count, so a name is looked up once among the anchors' distinct names, however many rows have it.
    """
    o = orphans.select(F.col("id").alias("orphan"), F.col("type").alias("group"), name_normal(F.col("name_cn")).alias("name"), name_normal(F.coalesce("name_en", F.lit(""))).alias("e"))
    a = anchors.select(F.col("id").alias("anchor"), F.col("type").alias("group"), name_normal(F.col("name_cn")).alias("name"), name_normal(F.coalesce("name_en", F.lit(""))).alias("e")).filter("group is not null")
    known = a.filter("name <> ''").groupBy("group", "name").agg(F.min("anchor").alias("partner"))
    cn = known.withColumnRenamed("partner", "cn")
    en = a.filter("e <> ''").groupBy("group", "e").agg(F.min("anchor").alias("en"))
    met = o.join(cn, ["group", "name"], "left").join(en, ["group", "e"], "left")
    rest = met.filter("cn is null and en is null and group is not null and name <> ''").select("group", "name").distinct()
    near = best_partners(rest, known, least_ratio).select("group", "name", "method", "score", F.col("partner").alias("near"))
    exact = F.when(F.col("cn").isNotNull(), F.lit("exact_name_cn")).when(F.col("en").isNotNull(), F.lit("exact_name_en"))
    score = F.when(F.col("cn").isNotNull(), 1.0).when(F.col("en").isNotNull(), 0.98).otherwise(F.col("score"))
    every = met.join(near, ["group", "name"], "left").select("orphan", F.coalesce("cn", "en", "near").alias("anchor"), F.coalesce(exact, "method").alias("method"), score.alias("score"))
    best = every.filter("anchor is not null").groupBy("orphan").agg(F.min(F.struct((-F.col("score")).alias("s"), "method", "anchor")).alias("x"))
    return best.select("orphan", "x.anchor", "x.method", (-F.col("x.s")).alias("score"))


def cardinality(pairs: DataFrame, source: str, target: str) -> DataFrame:
    """One row: how many partners the ends of a relation have."""
    a = pairs.agg(F.count("*").alias("n"), F.count_distinct(source).alias("s"), F.count_distinct(target).alias("t"))
    su, tu = F.col("s") == F.col("n"), F.col("t") == F.col("n")
    return a.select(F.when(F.col("n") == 0, "unknown").when(su & tu, "one_to_one").when(su, "many_to_one").when(tu, "one_to_many").otherwise("many_to_many").alias("cardinality"))


def relations(pairs: DataFrame, ontology: Column, kind: str, origin: str) -> DataFrame:
    """Pairs (source, target) as relations with stable ids and the confidence of their origin, without repeats."""
    p = pairs.select("source", "target").distinct()
    return p.select(relation_id(ontology, F.col("source").cast("string"), F.lit(kind), F.col("target").cast("string"), F.lit(origin)).alias("id"), "source", "target", F.lit(kind).alias("type"), F.lit(CONFIDENCE[origin]).alias("confidence"))


def link_check(source: DataFrame, src_key: str, target: DataFrame, tgt_key: str) -> DataFrame:
    """One row: source rows whose trimmed key is among the targets."""
    t = target.select(strip(F.col(tgt_key).cast("string")).alias("k")).distinct()
    return source.select(strip(F.col(src_key).cast("string")).alias("k")).join(t, "k", "left_semi").agg(F.count("*").alias("matches"))
