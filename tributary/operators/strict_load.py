"""Rows that fail to parse: strict load plus anti-join.

Every raw line keeps its offset (the id of the raw row). The strict load keeps only the records that
read as exactly the declared fields with valid values; the offsets it loaded are subtracted from the
raw offsets by an anti-join, and only that remainder is diagnosed. All of it is JVM expressions: the
separator of each row becomes part of a regular expression whose groups are possessive, so that
neither long nor hostile records backtrack or deepen the stack.

Defined results
* null and empty lines, header lines and lines beginning with ``#`` are no records;
* a null or empty separator means that the line is one single field;
* repeated rows are judged each for itself, also when they share an offset;
* an empty table gives empty results; further columns of the input are ignored;
* a line with text of any length is matched in one pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The columns of an order file, in order.
ORDER_FIELDS = [
    "订单号", "下单日期", "供应商", "供应商类别", "物料编码", "物料名称", "物料类别", "规格型号", "单位",
    "数量", "单价", "总金额", "要求交货期", "实际到货期", "状态", "质检结果", "采购员",
]

ORDER_NO = r"\APO-20[0-9]{2}(?:0[1-9]|1[0-2])-[0-9]{4,}\z"
NUMBER = r"\A-?(?:[0-9]{1,3}(?:,[0-9]{3})+|[0-9]+)(?:\.[0-9]+)?\z"
DATES = r"\A(?:([0-9]{4})-([0-9]{2})-([0-9]{2})|([0-9]{4})/([0-9]{1,2})/([0-9]{1,2})|([0-9]{4})([0-9]{2})([0-9]{2}))\z"

#: Field kinds of the order layout: what each value must be.
ORDER_KINDS = {"订单号": "order_no", "下单日期": "date", "要求交货期": "date_or_empty", "实际到货期": "date_or_empty", "数量": "number_or_empty", "单价": "number_or_empty", "总金额": "number_or_empty"}


def _date(v: Column) -> Column:
    plain = F.regexp_replace(v, DATES, "$1$4$7-$2$5$8-$3$6$9")
    return F.when(v.rlike(DATES) & ~v.startswith("0000"), plain.try_cast("date"))


def _valid(v: Column, kind: str) -> Column:
    empty_allowed = kind.endswith("_or_empty")
    if kind == "order_no":
        ok = v.rlike(ORDER_NO)
    elif kind.startswith("date"):
        ok = _date(v).isNotNull()
    elif kind.startswith("number"):
        ok = v.rlike(NUMBER)
    else:
        raise ValueError(f"unknown field kind {kind}")
    return (v == "") | ok if empty_allowed else ok


def records(raw: DataFrame, *, offset: str = "raw_id", line: str = "c0", sep: str = "sep", line_no: str | None = "line_no") -> DataFrame:
    """(offset, sep, line) of every line that is a record, without its line end."""
    text = F.regexp_replace(F.col(line), r"\r\z", "")
    out = raw.select(
        F.col(offset).alias("offset"),
        F.when(F.coalesce(F.col(sep), F.lit("")) == "", F.lit("\u0000")).otherwise(F.col(sep)).alias("sep"),
        text.alias("line"),
        (F.col(line_no) if line_no else F.lit(None).cast("int")).alias("line_no"),
    )
    return out.filter((F.col("line") != "") & ~F.col("line").startswith("#") & ~F.coalesce(F.col("line_no") == 0, F.lit(False))).drop("line_no")


#: Separators with patterns of their own, which are compiled once; any other is put into a pattern row by row.
SEPARATORS = [",", ";", "|", "\t"]


def _by_separator(make: Callable[[Column, Column], Column]) -> Column:
    """``make(separator, field)`` with the patterns of the row's separator."""
    s = F.concat(F.lit(r"\Q"), F.col("sep"), F.lit(r"\E"))
    out = make(s, F.concat(F.lit(r'(?:"[^"]*+(?:""[^"]*+)*+"|(?:(?!'), s, F.lit(r')[^"])*+)')))
    for sep in SEPARATORS:
        fast = make(F.lit("[" + sep + "]"), F.lit(r'(?:"[^"]*+(?:""[^"]*+)*+"|[^"' + sep + "]*+)"))
        out = F.when(F.col("sep") == sep, fast).otherwise(out)
    return out


def _matches(times: str) -> Column:
    """Whether separator + line is that many fields, each with the separator before it, and nothing else."""
    return _by_separator(lambda s, field: F.rlike(F.concat("sep", "line"), F.concat(F.lit(r"\A(?:"), s, field, F.lit(")" + times + r"\z"))))


def _fields() -> Column:
    """The fields of a record as an array: unquoted, without outer spaces."""
    raw = _by_separator(lambda s, field: F.regexp_extract_all(F.concat("sep", "line"), F.concat(F.lit(r"\G"), s, F.lit("("), field, F.lit(")")), F.lit(1)))
    return F.transform(raw, lambda x: F.trim(F.when(x.startswith('"'), F.replace(x.substr(F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)))


def _values_hold(values: Column, fields: list[str], kinds: dict[str, str]) -> Column:
    ok = F.lit(True)
    for name, kind in kinds.items():
        ok = ok & _valid(F.get(values, F.lit(fields.index(name))), kind)
    return ok


def _parsed(df: DataFrame, fields: list[str], kinds: dict[str, str], only_valid: bool) -> DataFrame:
    """``df`` with ``fields`` and ``valid``.

    The parse is bound to a lambda variable and leaves through a generator: else the optimizer copies
    it into every place that reads a field, and each copy parses the record again.
    """
    bound = F.transform(F.array(_fields()), lambda f: F.struct(f.alias("fields"), _values_hold(f, fields, kinds).alias("valid")))
    return df.select("*", F.inline(F.filter(bound, lambda x: x["valid"]) if only_valid else bound))


def strict_load(recs: DataFrame, fields: list[str] = ORDER_FIELDS, kinds: dict[str, str] = ORDER_KINDS) -> DataFrame:
    """Only the conforming records: (offset, sep, line, fields)."""
    return _parsed(recs.filter(_matches("{%d}+" % len(fields))), fields, kinds, True).drop("valid")


def typed_orders(raw: DataFrame, fields: list[str] = ORDER_FIELDS, kinds: dict[str, str] = ORDER_KINDS, **columns: str) -> DataFrame:
    """The loaded records as typed rows: dates, decimals, and null for an empty value."""
    loaded = strict_load(records(raw, **columns), fields, kinds)
    out = [F.col("offset").alias(columns.get("offset", "raw_id"))]
    for i, name in enumerate(fields):
        v, kind = F.get("fields", F.lit(i)), kinds.get(name, "")
        if kind.startswith("date"):
            v = _date(v)
        elif kind.startswith("number"):
            v = F.replace(v, F.lit(","), F.lit("")).try_cast("decimal(38,6)")
        else:
            v = F.nullif(v, F.lit(""))
        out.append(v.alias(name))
    return loaded.select(*out)


def _key(df: DataFrame) -> DataFrame:
    return df.withColumn("digest", F.xxhash64("sep", "line"))


def rejects(raw: DataFrame, fields: list[str] = ORDER_FIELDS, kinds: dict[str, str] = ORDER_KINDS, **columns: str) -> DataFrame:
    """(offset, reason, failed_field, line) of every record that the strict load did not take.

    The remainder is what the raw offsets hold beyond the loaded ones. Its reason is the first of
    ``quoting``, ``column_count`` and ``value`` that applies; ``failed_field`` is the first field with
    an invalid value where that is the reason, else null.
    """
    recs = _key(records(raw, **columns))
    loaded = _key(strict_load(recs.drop("digest"), fields, kinds)).select("offset", "digest")
    rest = recs.join(loaded, ["offset", "digest"], "left_anti")
    diagnosed = _parsed(rest, fields, kinds, False).withColumn(
        "reason",
        F.when(~_matches("++"), "quoting")
        .when(F.size("fields") != len(fields), "column_count")
        .when(~F.col("valid"), "value"),
    )
    failed = F.coalesce(*[F.when(~_valid(F.get("fields", F.lit(fields.index(name))), kind), name) for name, kind in kinds.items()])
    return diagnosed.filter(F.col("reason").isNotNull()).select(F.col("offset").alias(columns.get("offset", "raw_id")), "reason", F.when(F.col("reason") == "value", failed).alias("failed_field"), "line")
