"""Type inference, keys, quality reports and review edits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.functions.text import is_blank, strip

DATE_LIKE = r"^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|^[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4}|^[0-9]{8}$"
#: Inferred types in the order that breaks ties of the vote.
VOTES = ["timestamp", "integer", "float", "boolean", "string", "null"]
INTEGER, FLOAT = r"^[+-]?[0-9]+$", r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def vote_type(c: Column) -> Column:
    """The class of a value in the schema vote."""
    s = strip(c)
    plain = F.replace(s, F.lit(","), F.lit(""))
    low = F.lower(s)
    return (
        F.when((s == "") | low.isin("none", "null", "nan"), "null")
        .when(s.rlike(DATE_LIKE), "timestamp")
        .when(low.isin("true", "false", "yes", "no", "1", "0"), "boolean")
        .when(plain.rlike(INTEGER), "integer")
        .when(plain.rlike(FLOAT) | F.lower(plain).isin("inf", "-inf", "infinity", "-infinity"), "float")
        .otherwise("string")
    )


def long_form(df: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, column_name, value), all values as text."""
    return df.unpivot(keys, [F.col(f"`{c}`").cast("string").alias(c) for c in columns], "column_name", "value")


def schema_vote(df: DataFrame, columns: list[str], order: str | None = None, sample: int | None = None) -> DataFrame:
    """(column_name, type): most votes, ties by the fixed order, no votes is string; all rows unless sampled."""
    src = df.orderBy(order).limit(sample) if sample else df
    cells = long_form(src, [], columns).groupBy("column_name", "value").agg(F.count("*").alias("n")).filter(~is_blank(F.col("value")))
    votes = cells.groupBy("column_name", vote_type(F.col("value")).alias("type")).agg(F.sum("n").alias("n"))
    best = votes.withColumn("p", F.array_position(F.array(*[F.lit(v) for v in VOTES]), F.col("type"))).groupBy("column_name").agg(F.max_by("type", F.struct("n", -F.col("p"))).alias("type"))
    names = df.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    return names.join(best, "column_name", "left").select("column_name", F.coalesce("type", F.lit("string")).alias("type"))


def quality_type(kinds: Column) -> Column:
    """One type from the set of kinds of a column's values."""
    only = lambda *k: F.size(F.array_except(kinds, F.array(*[F.lit(x) for x in k]))) == 0
    return F.when(F.size(kinds) == 0, "null").when(F.size(kinds) == 1, F.element_at(kinds, 1)).when(only("integer", "float"), "float").otherwise("mixed")


def value_kind(c: Column) -> Column:
    s = strip(c)
    return F.when(s.rlike(INTEGER), "integer").when(s.rlike(FLOAT), "float").when(F.lower(s).isin("true", "false"), "boolean").otherwise("string")


def column_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, rows, null_count, null_pct, distinct_count, type, issue) over all rows."""
    cells = long_form(df, [], columns).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    blank = is_blank(F.col("value"))
    out = cells.groupBy("column_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(blank, F.col("n")).otherwise(0)).alias("null_count"),
        F.sum(F.when(blank, 0).otherwise(1)).alias("distinct_count"),
        F.collect_set(F.when(~blank, value_kind(F.col("value")))).alias("kinds"),
    )
    pct = F.round(F.col("null_count") * 100 / F.col("rows"), 2)
    return out.select("column_name", "rows", "null_count", pct.alias("null_pct"), "distinct_count", quality_type(F.col("kinds")).alias("type"), (pct > 50).alias("issue"))


def duplicate_count(df: DataFrame) -> DataFrame:
    """Rows beyond the first of equal ones."""
    return df.groupBy(*df.columns).agg(F.count("*").alias("n")).agg((F.coalesce(F.sum("n"), F.lit(0)) - F.count("*")).alias("duplicates"))


def quality_report(df: DataFrame, columns: list[str]) -> DataFrame:
    """One row: completeness, uniqueness, validity and their weighted overall score; 1.0 for no rows."""
    c = column_report(df, columns).agg(F.avg(F.col("null_count") * 100 / F.col("rows")).alias("p"), F.sum((F.col("type") == "mixed").cast("int")).alias("mixed"), F.max("rows").alias("rows"))
    d = duplicate_count(df.select(*[f"`{x}`" for x in columns]))
    x = c.crossJoin(F.broadcast(d))  # two single rows
    completeness, uniqueness, validity = 1 - F.coalesce(F.col("p"), F.lit(0.0)) / 100, F.coalesce(1 - F.col("duplicates") / F.col("rows"), F.lit(1.0)), 1 - F.coalesce(F.col("mixed"), F.lit(0)) / max(1, len(columns))
    overall = 0.4 * completeness + 0.4 * uniqueness + 0.2 * validity
    return x.select(*[F.round(v, 3).alias(k) for k, v in (("completeness", completeness), ("uniqueness", uniqueness), ("validity", validity), ("overall", overall))], "duplicates")


def key_facts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, rows, filled, distinct_count, numeric, long_share): what the choice of keys needs, in one pass."""
    cells = long_form(df, [], columns).withColumn("value", strip(F.col("value"))).groupBy("column_name", "value").agg(F.count("*").alias("n"))
    v = F.col("value")
    filled = v.isNotNull() & (v != "")
    weigh = lambda cond: F.coalesce(F.sum(F.when(filled & cond, F.col("n"))), F.lit(0))
    return cells.groupBy("column_name").agg(
        F.sum("n").alias("rows"), weigh(F.lit(True)).alias("filled"), F.coalesce(F.sum(filled.cast("int")), F.lit(0)).alias("distinct_count"), weigh(v.rlike(FLOAT)).alias("numeric"), weigh(F.length(v) >= 3).alias("long")
    )


#: Names that are keys where they are unique.
PREFERRED_KEYS = ["filename", "source_file", "source_dataset_id", "order_id", "订单号", "供应商ID"]


def choose_key(facts: dict[str, dict], columns: list[str]) -> str:
    """An id-like unique column, else a preferred one, else any unique column, else the row's hash."""
    unique = lambda c: facts[c]["rows"] > 0 and facts[c]["filled"] == facts[c]["rows"] == facts[c]["distinct_count"]
    for group in ([c for c in columns if "id" in c.lower()], [c for c in PREFERRED_KEYS if c in columns], columns):
        for c in group:
            if unique(c):
                return c
    return "__row_hash__"


def alternate_keys(facts: DataFrame) -> DataFrame:
    """Near-unique text columns: two values or more, not all numbers, 80 % of length 3, 90 % distinct."""
    f = F.col
    return facts.filter((f("distinct_count") >= 2) & (f("numeric") < f("filled")) & (f("long") >= 0.8 * f("filled")) & (f("distinct_count") >= 0.9 * f("filled"))).select("column_name")


def alternate_keys_of(facts: dict[str, dict], columns: list[str]) -> list[str]:
    """The same from facts that are at hand, in order of the columns."""
    f = lambda c: facts[c]
    return [c for c in columns if f(c)["distinct_count"] >= 2 and f(c)["numeric"] < f(c)["filled"] and f(c)["long"] >= 0.8 * f(c)["filled"] and f(c)["distinct_count"] >= 0.9 * f(c)["filled"]]


def first_type(df: DataFrame, columns: list[str], order: str, sample: int | None = None) -> DataFrame:
    """(column_name, type, example) by the first value in order that is not blank."""
    src = df.orderBy(order).limit(sample) if sample else df
    cells = long_form(src, [order], [c for c in columns if c != order])
    first = cells.filter(~is_blank(F.col("value"))).groupBy("column_name").agg(F.min_by("value", order).alias("example"))
    return first.select("column_name", value_kind(F.col("example")).alias("type"), "example")


#: Parts of names and the types they suggest, tried in order.
NAME_TYPES = [
    (("date", "time", "at", "created", "updated"), "datetime"), (("id", "count", "num", "age", "qty", "quantity"), "integer"),
    (("price", "amount", "score", "rate", "pct", "percent"), "float"), (("is_", "has_", "flag", "active", "enabled"), "boolean"),
]


def guess_type(name: str) -> str:
    return next((kind for parts, kind in NAME_TYPES if any(p in name.lower() for p in parts)), "string")


def latest_review(reviews: DataFrame, dataset: str, at: str) -> DataFrame:
    return reviews.withColumn("__n", F.row_number().over(Window.partitionBy(dataset).orderBy(F.desc(at)))).filter("__n = 1").drop("__n")


#: What an event does to a review's status.
REVIEW_STEPS = {"start": "in_review", "approve": "approved", "reject": "rejected"}


def review_status(event: Column) -> Column:
    out = F.lit("pending_review")
    for e, s in REVIEW_STEPS.items():
        out = F.when(event == e, s).otherwise(out)
    return out


def apply_edits(df: DataFrame, key: str, edits: DataFrame, fields: list[str]) -> DataFrame:
    """Cell edits (row_pk, field_name, new_value, seq): the last one of a cell wins, a null value empties it."""
    last = edits.groupBy("row_pk", "field_name").agg(F.max_by(F.struct("new_value"), "seq").alias("v"))
    wide = last.groupBy("row_pk").agg(*[F.first(F.when(F.col("field_name") == f, F.col("v")), ignorenulls=True).alias(f"__{f}") for f in fields])
    joined = df.join(wide, df[key].cast("string") == wide["row_pk"], "left")
    new = {f: F.when(F.col(f"__{f}").isNotNull(), F.col(f"__{f}.new_value").cast(df.schema[f].dataType)).otherwise(F.col(f"`{f}`")) for f in fields}
    return joined.select(*[new.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns])


def route_score(rows: DataFrame, columns: list[str], rows_before: int | None = None) -> DataFrame:
    """Retention x 0.4 + share of filled cells x 0.6 of a tabular result."""
    filled = sum(((~is_blank(F.col(f"`{c}`").cast("string"))).cast("int") for c in columns), F.lit(0))
    a = rows.agg(F.count("*").alias("n"), F.sum(filled).alias("f"))
    before = F.lit(rows_before) if rows_before else F.col("n")
    return a.select(F.when(F.col("n") == 0, 0.0).otherwise(F.round(F.col("n") / before * 0.4 + F.col("f") / (F.col("n") * len(columns)) * 0.6, 3)).alias("score"))
