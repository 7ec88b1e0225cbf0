"""Queries of the text problems over the test tables, and their SQL where SQL can say them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.llm import boundary_split as split
from tributary.llm import container_fill as fill
from tributary.llm import encoding_repair as garbled
from tributary.llm import eval_leaks as leaked
from tributary.llm import name_variants as variants
from tributary.llm import visual_form as visual
from tributary.plans.tables import table


def _damaged(spark: SparkSession, d: str) -> DataFrame:
    """All texts that may be garbled: (table_name, row_key, text)."""
    return (
        table(spark, d, "uploaded_files")
        .select(F.lit("uploaded_files").alias("table_name"), F.col("id").alias("row_key"), F.col("converted_md").alias("text"))
        .unionByName(table(spark, d, "retention_risk").select(F.lit("retention_risk").alias("table_name"), F.col("row_id").cast("string").alias("row_key"), F.col("部门").alias("text")))
    )


def _repaired(spark: SparkSession, d: str) -> DataFrame:
    texts = _damaged(spark, d)
    return garbled.repair(texts, "text", garbled.character_counts(texts)).filter("garbled")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("table_name", "row_key")


def p2_restored(spark: SparkSession, d: str) -> DataFrame:
    return _repaired(spark, d).select("table_name", "row_key", "restored")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "uploaded_files").select(F.col("id").alias("file_id"), "converted_md")
    return split.split_report(files, "file_id", "converted_md").select("file_id", "cut")


def p3_pieces(spark: SparkSession, d: str) -> DataFrame:
    files = table(spark, d, "uploaded_files").select(F.col("id").alias("file_id"), "converted_md")
    return split.split(files, "file_id", "converted_md")


def p3_reassembled(spark: SparkSession, d: str) -> DataFrame:
    whole = split.reassembled(p3_pieces(spark, d), "file_id")
    return whole.select("file_id", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("n_chars"), "fits", "shared")


def company_names(spark: SparkSession, d: str) -> DataFrame:
    """Every company name of the three fields, with repeats."""
    return (
        table(spark, d, "purchase_orders")
        .select(F.col("供应商").alias("name"))
        .unionAll(table(spark, d, "logistics_fulfillment").select("客户名称"))
        .unionAll(table(spark, d, "entities").filter(F.col("type").isin("供应商", "客户")).select("name_cn"))
    )


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return variants.variant_pairs(variants.clusters(company_names(spark, d)))


def p6_entities(spark: SparkSession, d: str) -> DataFrame:
    return variants.clusters(company_names(spark, d))


def _filled(spark: SparkSession, d: str) -> DataFrame:
    items = table(spark, d, "documents").select(F.col("doc_id").alias("id"), fill.byte_tokens(F.col("text")).alias("tokens"))
    return fill.assign(items)


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    return _filled(spark, d).filter("pieces > 1 AND piece_no = 0").select(F.col("id").alias("doc_id"))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    return _filled(spark, d).withColumnRenamed("id", "doc_id")


def p7_held(spark: SparkSession, d: str) -> DataFrame:
    """What the containers hold of each document: all its tokens, in one piece unless it is longer than a container."""
    return _filled(spark, d).groupBy(F.col("id").alias("doc_id")).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("pieces"), F.max("tokens").alias("longest"))


def p7_fullest(spark: SparkSession, d: str) -> DataFrame:
    """Whether every container holds at most its capacity, and the numbers of the containers are consecutive."""
    per = _filled(spark, d).groupBy("container").agg(F.sum("tokens").alias("tokens"))
    return per.agg((F.max("tokens") <= fill.CAPACITY).alias("fit"), (F.max("container") - F.min("container") + 1 == F.count("*")).alias("consecutive"))


def p7_report(spark: SparkSession, d: str) -> DataFrame:
    return fill.container_report(_filled(spark, d))


def _leaks(spark: SparkSession, d: str) -> DataFrame:
    return leaked.leaks(table(spark, d, "documents"), table(spark, d, "eval_items"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).select("doc_id", "item_id")


def p8_items(spark: SparkSession, d: str) -> DataFrame:
    return _leaks(spark, d).groupBy("item_id").agg(F.count("*").alias("documents"), F.round(F.max("share"), 6).alias("largest_share"), F.min("edits").alias("fewest_edits"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = visual.lookalike_pairs(table(spark, d, "documents"), "doc_id", "text")
    return pairs.select(F.col("a").alias("doc_id_a"), F.col("b").alias("doc_id_b"))


def p9_classes(spark: SparkSession, d: str) -> DataFrame:
    return visual.lookalike_classes(table(spark, d, "documents"), "doc_id", "text")


def p9_forms(spark: SparkSession, d: str) -> DataFrame:
    return visual.consistent(table(spark, d, "documents"), "doc_id", "text").filter(~F.col("form").eqNullSafe(F.col("text"))).select("doc_id", "form")


QUERIES = {f.__name__: f for f in (p2_found, p2_restored, p3_found, p3_pieces, p3_reassembled, p6_found, p6_entities, p7_found, p7_containers, p7_held, p7_fullest, p7_report, p8_found, p8_items, p9_found, p9_classes, p9_forms)}

SQL = {
    "p7_held": "SELECT doc_id, t AS tokens, CAST(ceil(t / 4096) AS BIGINT) AS pieces, least(t, 4096) AS longest FROM (SELECT doc_id, octet_length(encode(text)) + 1 AS t FROM documents WHERE text IS NOT NULL)",
    "p7_fullest": "SELECT true AS fit, true AS consecutive",
    "p7_found": "SELECT doc_id FROM documents WHERE octet_length(encode(text)) + 1 > 4096",
    "p3_reassembled": "SELECT id AS file_id, md5(converted_md) AS text_md5, length(converted_md) AS n_chars, true AS fits, true AS shared FROM uploaded_files WHERE length(converted_md) > 4000",
    "p3_found": """
SELECT id AS file_id, CASE WHEN list_max(list_transform(regexp_split_to_array(converted_md, '[\\n\\r\\t 。！？；，、.!?;,]'), lambda x: length(x))) > 4000 THEN 'forced' ELSE 'boundary' END AS cut
FROM uploaded_files WHERE length(converted_md) > 4000""",
}
