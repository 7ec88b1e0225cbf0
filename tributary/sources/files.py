"""File sources: CSV, JSON, spreadsheets, XML, documents; and which route a file takes."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.plans.ship import ship


def csv(spark: SparkSession, path: str, columns: list[str], sep: str = ",", comment: str | None = None) -> DataFrame:
    """All columns as text; short rows are filled with null, long or broken ones kept in ``_corrupt``."""
    schema = ", ".join(f"`{c}` string" for c in [*columns, "_corrupt"])
    r = spark.read.schema(schema).option("header", True).option("sep", sep).option("multiLine", False).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("enforceSchema", True)
    return (r.option("comment", comment) if comment else r).csv(path)


def json(spark: SparkSession, path: str, schema: str | None = None, lines: bool = False) -> DataFrame:
    """An array or a single object a file, or one object a line."""
    r = spark.read.option("multiLine", not lines).option("mode", "PERMISSIVE")
    return (r.schema(schema) if schema else r).json(path)


def xml(spark: SparkSession, path: str, row_tag: str, schema: str | None = None) -> DataFrame:
    r = spark.read.format("xml").option("rowTag", row_tag).option("attributePrefix", "")
    return (r.schema(schema) if schema else r).load(path)


def documents(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(filename, content, storage_uri, size) of every file."""
    b = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path)
    return b.select(F.element_at(F.split("path", "/"), -1).alias("filename"), "content", F.col("path").alias("storage_uri"), F.col("length").alias("size"))


def listing(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, size) of files, contents unread."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(path).select("path", F.col("length").alias("size"))


def route(filename: Column) -> Column:
    """Structured files take route A, semi-structured B, all others C."""
    ext = F.lower(F.regexp_extract(filename, r"\.([^.]+)$", 1))
    return F.when(ext.isin("csv", "xlsx", "xls"), "A").when(ext.isin("json", "xml"), "B").otherwise("C")


_NS = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def sheet_rows(content: bytes) -> Iterator[list[str]]:
    """The rows of a workbook's first sheet as text; missing cells are empty."""
    z = zipfile.ZipFile(io.BytesIO(content))
    shared: list[str] = []
    if "xl/sharedStrings.xml" in z.namelist():
        shared = ["".join(t.text or "" for t in si.iter(f"{{{_NS['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).findall("m:si", _NS)]
    first = sorted(n for n in z.namelist() if n.startswith("xl/worksheets/sheet"))[0]
    for row in ElementTree.fromstring(z.read(first)).iter(f"{{{_NS['m']}}}row"):
        cells: dict[int, str] = {}
        for i, cell in enumerate(row.findall("m:c", _NS)):
            letters = "".join(x for x in cell.get("r", "") if x.isalpha())
            at = i
            if letters:
                at = 0
                for x in letters:
                    at = at * 26 + ord(x.upper()) - 64
                at -= 1
            kind, v = cell.get("t"), cell.find("m:v", _NS)
            if kind == "inlineStr":
                cells[at] = "".join(t.text or "" for t in cell.iter(f"{{{_NS['m']}}}t"))
            elif v is not None and v.text is not None:
                cells[at] = shared[int(v.text)] if kind == "s" else v.text
        yield [cells.get(i, "") for i in range(max(cells, default=-1) + 1)]


def xlsx(spark: SparkSession, path: str, pattern: str = "*.xlsx") -> DataFrame:
    """(filename, row_no, cells map) of the first sheet of each workbook; a blank header is ``col_i``."""
    ship(spark)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, content in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                rows = sheet_rows(content)
                header = [h.strip() or f"col_{i}" for i, h in enumerate(next(rows, []))]
                out = [[(h, (r + [""] * len(header))[i]) for i, h in enumerate(header)] for r in rows]
                kind = pa.map_(pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(out), pa.string()), pa.array(range(1, len(out) + 1), pa.int32()), pa.array(out, kind)], names=["filename", "row_no", "cells"])

    return documents(spark, path, pattern).select("filename", "content").mapInArrow(run, "filename string, row_no int, cells map<string,string>")


def to_markdown(docs: DataFrame, convert: Callable[[str, bytes], str] | None = None) -> DataFrame:
    """(filename, markdown_text, extraction_error): text formats decoded in the JVM, others by an injected converter.

    What cannot be converted has empty text and the error's message; existing text is passed through.
    """
    ext = F.lower(F.regexp_extract("filename", r"\.([^.]+)$", 1))
    plain = F.when(ext.isin("txt", "md", "markdown"), F.decode("content", "UTF-8")).when(ext == "csv", csv_to_markdown(F.decode("content", "UTF-8"))).when(ext.isin("html", "htm"), html_to_text(F.decode("content", "UTF-8")))
    if convert is None:
        return docs.select("filename", F.coalesce(plain, F.lit("")).alias("markdown_text"), F.when(plain.isNull(), "no converter for this format").alias("extraction_error"))
    ship(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for name, content, text in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                try:
                    out.append((name, text if text is not None else convert(name, content), None))
                except Exception as x:  # noqa: BLE001
                    out.append((name, "", str(x)))
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], pa.string()) for i in range(3)], names=["filename", "markdown_text", "extraction_error"])

    return docs.select("filename", "content", plain.alias("text")).mapInArrow(run, "filename string, markdown_text string, extraction_error string")


def csv_to_markdown(text: Column) -> Column:
    """A CSV text as a Markdown table: commas become cell borders."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: x != "")
    row = lambda x: F.concat(F.lit("| "), F.replace(x, F.lit(","), F.lit(" | ")), F.lit(" |"))
    rule = F.concat(F.lit("|"), F.repeat(F.lit("---|"), F.size(F.split(F.get(lines, F.lit(0)), ","))))
    body = F.transform(lines, row)
    return F.when(F.size(lines) > 0, F.array_join(F.concat(F.slice(body, 1, 1), F.array(rule), F.slice(body, 2, 1 << 30)), "\n")).otherwise("")


def html_to_text(text: Column) -> Column:
    plain = F.regexp_replace(text, r"(?is)<(script|style)\b.*?</\1>", " ")
    plain = F.regexp_replace(plain, r"(?i)<h([1-6])[^>]*>", "\n# ")
    plain = F.regexp_replace(plain, r"(?i)<(br|/p|/div|/li|/tr|/h[1-6])[^>]*>", "\n")
    plain = F.regexp_replace(plain, r"<[^>]+>", " ")
    for a, b in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&nbsp;", " "), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(a), F.lit(b))
    return F.btrim(F.regexp_replace(F.regexp_replace(plain, r"[ \t]+", " "), r"\n\s*\n+", "\n\n"))
