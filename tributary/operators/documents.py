"""Markdown documents to typed rows: rules, tables, definitions, sections, and what a row's own text names."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.functions.text import organisations, strip, thresholds
from tributary.plans.ship import ship

HEADING = r"^(#{1,6})\s+(.+)$"
THEN_FORM, COMMA_FORM = r"(?i)IF\s+(.+?)\s+THEN\s+(.+?)$", r"(?i)^\s*IF\s+([^,，]+?)[,，]\s*(.+)$"
DEFINITION = r"^([A-Za-z一-龥][\w一-龥 /\-]{0,40}?)\s*[(（]([^)）]{1,40})[)）]\s*[:：]\s*(.+)$"
STEP = r"(?i)^(step|阶段|步骤)\s*[0-9]*$"


def lines(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, i, line) of every line, from 0 on."""
    return docs.select(key, F.posexplode(F.split(text, r"\r?\n")).alias("i", "line"))


def rules(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, rule_index, condition, action): IF ... THEN ... anywhere in a line first, then IF ..., ... lines."""
    ln = lines(docs, key, text)
    then = ln.filter(F.col("line").rlike(THEN_FORM)).select(key, F.lit(0).alias("form"), "i", strip(F.regexp_extract("line", THEN_FORM, 1)).alias("condition"), strip(F.regexp_extract("line", THEN_FORM, 2)).alias("action"))
    comma = ln.filter(F.col("line").rlike(COMMA_FORM) & ~F.col("line").rlike(r"(?i)\bTHEN\b")).select(key, F.lit(1).alias("form"), "i", strip(F.regexp_extract("line", COMMA_FORM, 1)).alias("condition"), strip(F.regexp_extract("line", COMMA_FORM, 2)).alias("action"))
    w = Window.partitionBy(key).orderBy("form", "i")
    return then.unionByName(comma).select(key, F.row_number().over(w).alias("rule_index"), "condition", "action")


def clipped(c: Column, longest: int | None) -> Column:
    return F.substring(c, 1, longest) if longest else c


def definitions(docs: DataFrame, key: str, text: str, limit: int | None = None, longest: int | None = None) -> DataFrame:
    """(key, definition_index, name, qualifier, definition) of lines ``Name (qualifier): text``; steps are none.

    ``limit`` definitions a document of ``longest`` characters; the reference has 20 and 500.
    """
    s = strip(F.col("line"))
    hit = lines(docs, key, text).filter(s.rlike(DEFINITION)).select(key, "i", *[strip(F.regexp_extract(s, DEFINITION, n)).alias(a) for n, a in ((1, "name"), (2, "qualifier"), (3, "definition"))])
    out = hit.filter(~F.col("name").rlike(STEP)).withColumn("definition_index", F.row_number().over(Window.partitionBy(key).orderBy("i")))
    out = out.filter(F.col("definition_index") <= limit) if limit else out
    return out.select(key, "definition_index", "name", "qualifier", clipped(F.col("definition"), longest).alias("definition"))


def sections(docs: DataFrame, key: str, text: str, limit: int | None = None, longest: int | None = None) -> DataFrame:
    """(key, section_index, section_title, section_text): the text from a heading to the next; bodies without text are left out.

    Documents without ``#`` headings are cut at numbered lines, others are one section. ``limit`` sections a
    document of ``longest`` characters; the reference has 2,000 characters.
    """
    ln = lines(docs, key, text)
    numbered = r"^\s*([0-9]+[\.、)])\s+(\S[^\n]{0,60}?)\s*$"
    sharp = F.col("line").rlike(HEADING)
    number = F.col("line").rlike(numbered) & ~F.col("line").rlike(r"(?i)^\s*[0-9]+[\.、)]\s+(IF|Step)\b")
    any_sharp = F.max(sharp).over(Window.partitionBy(key))
    x = ln.withColumn("head", F.when(any_sharp, sharp).otherwise(number))
    title = F.when(sharp, strip(F.regexp_extract("line", HEADING, 2))).otherwise(strip(F.regexp_extract("line", numbered, 2)))
    upto = Window.partitionBy(key).orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    x = x.withColumn("n", F.sum(F.col("head").cast("int")).over(upto)).withColumn("any", F.max("head").over(Window.partitionBy(key)))
    body = x.filter(~F.col("any") | (F.col("n") > 0)).groupBy(key, "n").agg(F.max(F.when(F.col("head"), title)).alias("section_title"), F.transform(F.sort_array(F.collect_list(F.struct("i", F.when(F.col("head"), F.lit(None).cast("string")).otherwise(F.col("line")).alias("line")))), lambda s: s["line"]).alias("parts"))
    out = body.select(key, F.greatest(F.col("n"), F.lit(1)).alias("section_index"), "section_title", strip(F.array_join("parts", "\n")).alias("section_text")).filter("section_text <> ''")
    out = out.filter(F.col("section_index") <= limit) if limit else out
    return out.select(key, "section_index", "section_title", clipped(F.col("section_text"), longest).alias("section_text"))


def _cells(line: str) -> list[str]:
    return [c.strip() for c in line.strip().strip("|").split("|")]


def table_rows(text: str) -> Iterator[tuple[int, int, str, list[tuple[str, str]]]]:
    """(table, row, section title, cells) of every pipe table whose second line is a rule."""
    rows, section, table, i = text.splitlines(), "", 0, 0
    while i < len(rows):
        head = re.match(HEADING, rows[i])
        if head:
            section = head[2].strip()
        elif rows[i].lstrip().startswith("|") and i + 1 < len(rows) and all(re.match(r"^:?-{3,}:?$", c) for c in _cells(rows[i + 1])):
            header, table, row = [c or f"col_{n + 1}" for n, c in enumerate(_cells(rows[i]))], table + 1, 0
            i += 2
            while i < len(rows) and rows[i].lstrip().startswith("|"):
                cells = _cells(rows[i])
                if len(cells) == len(header):
                    row += 1
                    yield table, row, section, list(dict(zip(header, cells, strict=True)).items())
                i += 1
            continue
        i += 1


def tables(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, table_index, table_row_index, section_title, cells map) of all Markdown tables."""
    ship(docs)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(k, *r) for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True) for r in table_rows(t)]
            kinds = [b.schema.field(0).type, pa.int32(), pa.int32(), pa.string(), pa.map_(pa.string(), pa.string())]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(kinds)], names=["key", "table_index", "table_row_index", "section_title", "cells"])

    has_table = docs.filter(F.col(text).contains("|")).select(key, text)
    return has_table.mapInArrow(run, f"key {kind}, table_index int, table_row_index int, section_title string, cells map<string,string>").withColumnRenamed("key", key)


def common(docs: DataFrame, key: str, text: str, titles_shown: int | None = None, longest: int | None = None) -> DataFrame:
    """(key, section_count, sections, doc_summary) of every document: all titles and the text in one line.

    ``titles_shown`` titles and a summary of ``longest`` characters; the reference has 6 and 200.
    """
    titles = F.regexp_extract_all(F.col(text), F.lit("(?m)" + HEADING), F.lit(2))
    return docs.select(key, F.size(titles).alias("section_count"), F.array_join(F.slice(titles, 1, titles_shown) if titles_shown else titles, ", ").alias("sections"), strip(F.replace(clipped(F.col(text), longest), F.lit("\n"), F.lit(" "))).alias("doc_summary"))


def enrich(rows: DataFrame, columns: list[str], most: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """Rows with the organisations and thresholds that their own text names; at ``most`` so many, the reference has 8 and 6."""
    own = F.concat_ws(" ", *columns)
    return rows.withColumns({"organizations": organisations(own, most[0]), "thresholds": thresholds(own, most[1])})


def extract(docs: DataFrame, key: str, text: str, longest: int | None = None, most: tuple[int | None, int | None] = (None, None)) -> DataFrame:
    """All rows of all documents: rules, table rows, definitions, sections; a document without any is one row.

    Bodies of sections and whole documents have ``longest`` characters, rows name at ``most`` so many
    organisations and thresholds; the reference has 2,000, and 8 and 6.
    """
    d = docs.filter(F.col(text).isNotNull() & (strip(F.col(text)) != "")).select(key, text)
    record = lambda kind, *n: F.concat_ws(":", F.col(key).cast("string"), F.lit(kind), *n)
    s = lambda c: F.col(c).cast("string")
    out = rules(d, key, text).select(key, record("rule", s("rule_index")).alias("record_id"), F.lit("rule").alias("row_type"), F.lit(None).cast("string").alias("title"), F.concat_ws(" => ", "condition", "action").alias("body"))
    out = out.unionByName(tables(d, key, text).select(key, record("table", s("table_index"), F.lit("row"), s("table_row_index")).alias("record_id"), F.lit("table_row").alias("row_type"), F.col("section_title").alias("title"), F.to_json("cells").alias("body")))
    out = out.unionByName(definitions(d, key, text).select(key, record("definition", s("definition_index")).alias("record_id"), F.lit("definition").alias("row_type"), F.col("name").alias("title"), F.col("definition").alias("body")))
    out = out.unionByName(sections(d, key, text, longest=longest).select(key, record("section", s("section_index")).alias("record_id"), F.lit("section").alias("row_type"), F.col("section_title").alias("title"), F.col("section_text").alias("body")))
    rest = d.join(out.select(key).distinct(), key, "left_anti").select(key, record("document", F.lit("1")).alias("record_id"), F.lit("document").alias("row_type"), F.lit(None).cast("string").alias("title"), clipped(F.col(text), longest).alias("body"))
    return enrich(out.unionByName(rest), ["title", "body"], most)


def structured_by(docs: DataFrame, key: str, text: str, extract_one: Callable[[list[str]], list[dict]] | None, auto: bool = False, batch: int = 20) -> DataFrame:
    """(key, fields map): an injected extractor in batches of 20 texts; its reply counts only if it has one item a text.

    Texts of a batch whose reply has another length have the one field ``extraction_error``, which says so. Without an extractor, or unless ``auto`` asks for it, the rules of ``extract`` apply.
    """
    if extract_one is None or not auto:
        return extract(docs, key, text).select(key, F.create_map(F.lit("record_id"), F.col("record_id"), F.lit("row_type"), F.col("row_type"), F.lit("body"), F.col("body")).alias("fields"))
    ship(docs)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, texts, fields = b.column(0).to_pylist(), b.column(1).to_pylist(), []
            for i in range(0, len(texts), batch):
                part = texts[i : i + batch]
                reply = extract_one(part)
                fields += [list((k, str(v)) for k, v in r.items()) for r in reply] if len(reply) == len(part) else [[("extraction_error", f"{len(reply)} replies for {len(part)} texts")] for _ in part]
            yield pa.RecordBatch.from_arrays([pa.array(keys, b.schema.field(0).type), pa.array(fields, pa.map_(pa.string(), pa.string()))], names=["key", "fields"])

    return docs.select(key, text).mapInArrow(run, f"key {kind}, fields map<string,string>").withColumnRenamed("key", key)


#: How the text of a failed conversion begins.
ERROR_MARKS = ("[ERROR", "[转换失败", "ERROR:")


def usable(text: Column) -> Column:
    bad = F.lit(False)
    for m in ERROR_MARKS:
        bad = bad | text.startswith(m)
    return text.isNotNull() & (strip(text) != "") & ~bad


def combined(docs: DataFrame, group: str, name: str, text: str) -> DataFrame:
    """(group, combined): the usable texts of a group in order of name, each under its name."""
    part = F.struct(name, F.concat(F.lit("=== "), F.col(name), F.lit(" ===\n"), F.col(text)).alias("t"))
    return docs.filter(usable(F.col(text))).groupBy(group).agg(F.array_join(F.transform(F.sort_array(F.collect_list(part)), lambda x: x["t"]), "\n\n").alias("combined"))
