"""Column-level data quality profile over the loads of a table.

The columns are turned into rows and pre-aggregated to one row for each different value, so that a
hot feed or a hot value is combined before it is shuffled. Values are generalised to character-class
masks (digit 9, capital A, small letter a, Han character 汉); the profile, the declared forms, the
dominant patterns, the rare-mask violations and the divergence between loads are all made from the
mask table, which is far smaller than the data.

Defined results
* blank means null or only spaces; an all-blank column has inferred_type ``null`` and no findings of
  type ``pattern`` or ``range``;
* a load without the load before it (load_no - 1 of the same feed) has no findings against it;
* repeated rows count; feed or load_no may be null and then form a load of their own;
* an empty table gives an empty profile; further columns are ignored; values may have any length;
* a largest number is compared with five times the former one as it is, also when that is not positive.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.plans.durable import cut

INTEGER, NUMERIC = r"\A[+-]?[0-9]+\z", r"\A[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)\z"

#: The business columns, and which of them are measured how.
COLUMNS = [
    "订单号", "下单日期", "供应商", "供应商类别", "物料编码", "物料名称", "物料类别", "规格型号", "单位",
    "数量", "单价", "总金额", "要求交货期", "实际到货期", "状态", "质检结果", "采购员",
]
RANGED = ["数量", "单价", "总金额"]
CATEGORIES = ["供应商类别", "物料类别", "单位", "状态", "质检结果"]
#: Declared forms as masks: 9 a digit, A a capital, other characters themselves, ``+`` after the last class: or more.
FORMS = {"订单号": ("PO-", "PO-999999-9999+"), "物料编码": ("", "AA-AA-999"), "下单日期": ("", "9999-99-99"), "要求交货期": ("", "9999-99-99"), "实际到货期": ("", "9999-99-99")}

_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def mask(value: Column) -> Column:
    """Each character's class in place of the character; other characters stay."""
    plain = F.translate(value, "0123456789" + _LETTERS.upper() + _LETTERS, "9" * 10 + "A" * 26 + "a" * 26)
    return F.regexp_replace(plain, r"\p{IsHan}", "汉")


def _mask_keeping(value: Column, name: Column, forms: dict[str, tuple[str, str]]) -> Column:
    """The mask, with the literal beginning of a declared form kept as it is."""
    out = mask(value)
    for column, (literal, _) in forms.items():
        if literal:
            out = F.when((name == column) & value.startswith(literal), F.concat(F.lit(literal), mask(value.substr(F.lit(len(literal) + 1), F.length(value))))).otherwise(out)
    return out


def _fits(masked: Column, name: Column, forms: dict[str, tuple[str, str]]) -> Column:
    """Whether a mask is of the declared form; null for columns without one."""
    out = F.lit(None).cast("boolean")
    for column, (_, form) in forms.items():
        out = F.when(name == column, masked.rlike("\\A" + form + "\\z")).otherwise(out)
    return out


def values(df: DataFrame, columns: list[str], load: list[str]) -> DataFrame:
    """(load..., column_name, value, n): each different value of each load and column."""
    return df.unpivot(load, [F.col(c).cast("string").alias(c) for c in columns], "column_name", "value").groupBy(*load, "column_name", "value").agg(F.count("*").alias("n"))


def mask_table(vals: DataFrame, load: list[str], forms: dict = FORMS) -> DataFrame:
    """One row a load, column and mask, with what the profile needs of its values."""
    text = F.trim("value")
    v = vals.withColumn("text", F.nullif(text, F.lit("")))
    number = F.when(F.col("text").rlike(NUMERIC), F.col("text").try_cast("double"))
    n = F.col("n")
    return (
        v.withColumn("mask", _mask_keeping(F.col("text"), F.col("column_name"), forms))
        .withColumn("number", number)
        .groupBy(*load, "column_name", "mask")
        .agg(
            F.sum("n").alias("n"),
            F.count("text").alias("distinct"),
            F.sum(F.when(F.col("text").rlike(INTEGER), n).otherwise(0)).alias("n_integer"),
            F.sum(F.when(F.col("text").rlike(NUMERIC), n).otherwise(0)).alias("n_number"),
            F.sum(F.when(F.lower("text").isin("true", "false"), n).otherwise(0)).alias("n_boolean"),
            F.min("number").alias("min_number"),
            F.max("number").alias("max_number"),
        )
        .withColumn("fits", _fits(F.col("mask"), F.col("column_name"), forms))
    )


def profile(masks: DataFrame, load: list[str]) -> DataFrame:
    """The profile of each load and column."""
    filled = F.col("mask").isNotNull()
    some = lambda c: F.sum(F.when(filled, F.col(c)).otherwise(0))
    agg = masks.groupBy(*load, "column_name").agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(~filled, F.col("n")).otherwise(0)).alias("null_count"),
        some("distinct").alias("distinct_count"),
        some("n_integer").alias("n_integer"),
        some("n_number").alias("n_number"),
        some("n_boolean").alias("n_boolean"),
        F.min("min_number").alias("min_number"),
        F.max("max_number").alias("max_number"),
        F.sum(F.when(F.col("fits") == F.lit(False), F.col("n")).otherwise(0)).alias("n_violations"),
    )
    full = F.col("rows") - F.col("null_count")
    kind = (
        F.when(full == 0, "null")
        .when(F.col("n_integer") == full, "integer")
        .when(F.col("n_number") == full, "float")
        .when(F.col("n_boolean") == full, "boolean")
        .when((F.col("n_number") == 0) & (F.col("n_boolean") == 0), "string")
        .otherwise("mixed")
    )
    return agg.withColumn("null_pct", F.col("null_count") * 100.0 / F.col("rows")).withColumn("inferred_type", kind).drop("n_integer", "n_number", "n_boolean")


def divergence(shares: DataFrame, feed: str, load_no: str, item: str) -> DataFrame:
    """(feed, load_no, column_name, divergence): half the sum of absolute share differences to the load before.

    ``shares`` has one row a feed, load, column and item with its count ``n``. Each load's shares are
    also sent to the next load, so that one aggregation compares them without a join on items.
    """
    totals = shares.groupBy(feed, load_no, "column_name").agg(F.sum("n").alias("total"))
    p = null_safe_join(shares, totals, [feed, load_no, "column_name"]).select(feed, load_no, "column_name", item, (F.col("n") / F.col("total")).alias("share"))
    both = F.explode(F.array(F.struct(F.col(load_no).alias("at"), F.col("share").alias("delta")), F.struct((F.col(load_no) + 1).alias("at"), (-F.col("share")).alias("delta")))).alias("x")
    moved = p.select(feed, "column_name", item, both).select(feed, "column_name", item, F.col("x.at").alias(load_no), F.col("x.delta").alias("delta"))
    change = moved.groupBy(feed, load_no, "column_name", item).agg(F.sum("delta").alias("delta"), F.max(F.col("delta") > 0).alias("now"), F.max(F.col("delta") < 0).alias("before"))
    return (
        change.groupBy(feed, load_no, "column_name")
        .agg((F.sum(F.abs("delta")) / 2).alias("divergence"), F.max("now").alias("now"), F.max("before").alias("before"))
        .filter("now and before")
        .drop("now", "before")
    )


EPS = 1e-9


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """``left`` with the other columns of ``right``, where a null key equals a null key."""
    other = right.select(*[F.col(k).alias(f"__{k}") for k in keys], *[c for c in right.columns if c not in keys])
    return left.join(other, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys], how).drop(*[f"__{k}" for k in keys])


def findings(vals: DataFrame, recorded: DataFrame, feed: str = "feed", load_no: str = "load_no", ranged: list[str] = RANGED, categories: list[str] = CATEGORIES, forms: dict = FORMS, of_categories: DataFrame | None = None) -> DataFrame:
    """(feed, load_no, column_name, finding) of every load and column.

    ``of_categories`` may give the values of the category columns from a scan of these alone, which
    reads far less than ``vals`` does.
    """
    load = [feed, load_no]
    of_categories = vals if of_categories is None else of_categories
    masks = mask_table(vals, load, forms)
    now = cut(profile(masks, load))  # one row a load and column, which is read twice below
    before = now.select(feed, (F.col(load_no) + 1).alias(load_no), "column_name", F.struct("null_pct", "inferred_type", "distinct_count", "min_number", "max_number").alias("b"))
    drift = divergence(
        of_categories.filter(F.col("column_name").isin(categories) & (F.trim("value") != "")).groupBy(*load, "column_name", F.trim("value").alias("value")).agg(F.sum("n").alias("n")), feed, load_no, "value"
    )
    record = recorded.select(F.col(feed), F.col(load_no), F.col("name").alias("column_name"), F.struct("null_count", "null_pct", "distinct_count", "inferred_type").alias("r"))
    keys = [feed, load_no, "column_name"]
    x = now
    for right in (before, drift, record):
        x = null_safe_join(x, right, keys, "left")
    c, b, r = F.col, (lambda f: F.col(f"b.{f}")), (lambda f: F.col(f"r.{f}"))
    full = c("rows") - c("null_count")
    differs = (
        ~r("null_count").eqNullSafe(c("null_count"))
        | ~r("distinct_count").eqNullSafe(c("distinct_count"))
        | ~r("inferred_type").eqNullSafe(c("inferred_type"))
        | F.coalesce(F.abs(r("null_pct") - c("null_pct")) > 0.01 + EPS, F.lit(True))
    )
    found = {
        "null_rate": F.abs(c("null_pct") - b("null_pct")) >= 10 - EPS,
        "type": c("inferred_type") != b("inferred_type"),
        "distinct": (c("distinct_count") * 2 < b("distinct_count")) | (c("distinct_count") > 2 * b("distinct_count")),
        "range": c("column_name").isin(ranged) & ((c("max_number") > 5 * b("max_number")) | ((c("min_number") < 0) & (b("min_number") >= 0))),
        "drift": c("divergence") >= 0.2 - EPS,
        "pattern": c("n_violations") * 20 > full,
        "recorded": c("r").isNotNull() & differs,
    }
    hits = F.filter(F.array(*[F.when(v, F.lit(k)) for k, v in found.items()]), lambda f: f.isNotNull())
    return x.select(*keys, F.explode(hits).alias("finding")).distinct()


def rare_masks(masks: DataFrame, load: list[str], dominant: float = 0.05) -> DataFrame:
    """``masks`` of non-blank values with ``total``, the number of those, and ``dominant``, whether the mask has its share of them."""
    filled = masks.filter(F.col("mask").isNotNull())
    totals = filled.groupBy(*load, "column_name").agg(F.sum("n").alias("total"))
    return null_safe_join(filled, totals, [*load, "column_name"]).withColumn("dominant", F.col("n") >= dominant * F.col("total"))


def rare_values(vals: DataFrame, load: list[str], dominant: float = 0.05, forms: dict = FORMS) -> DataFrame:
    """(load..., column_name, mask, value, n): the values behind the rare masks of each load and column.

    A rare mask has a value in fewer than ``dominant`` of the rows, so the values that are joined to the
    mask table are the few violations; the hot ones are all behind dominant masks.
    """
    keys = [*load, "column_name", "mask"]
    rare = rare_masks(mask_table(vals, load, forms), load, dominant).filter(~F.col("dominant")).select(*keys)
    text = F.nullif(F.trim("value"), F.lit(""))
    masked = vals.filter(text.isNotNull()).withColumn("mask", _mask_keeping(text, F.col("column_name"), forms))
    return null_safe_join(masked, rare, keys, "left_semi").select(*keys, "value", "n")


def pattern_report(vals: DataFrame, feed: str = "feed", load_no: str = "load_no", dominant: float = 0.05, forms: dict = FORMS) -> DataFrame:
    """Mined patterns: each load and column's dominant masks, its rare-mask values and its mask divergence.

    A mask is dominant where it has the share ``dominant`` of the non-blank values or more; all other
    masks are rare. ``divergence`` compares the mask distribution with that of the load before.
    """
    masks = cut(mask_table(vals, [feed, load_no], forms).filter(F.col("mask").isNotNull()))
    keys = [feed, load_no, "column_name"]
    j, big = rare_masks(masks, [feed, load_no], dominant), F.col("dominant")
    out = j.groupBy(*keys).agg(
        F.max("total").alias("filled"),
        F.count("*").alias("masks"),
        F.sum(F.when(big, 1).otherwise(0)).alias("dominant_masks"),
        F.max(F.struct("n", "mask")).alias("top"),
        F.sum(F.when(~big, F.col("n")).otherwise(0)).alias("rare_values"),
    )
    d = divergence(masks.select(*keys, "mask", "n"), feed, load_no, "mask")
    return null_safe_join(out, d, keys, "left").select(*keys, "filled", "masks", "dominant_masks", F.col("top.mask").alias("top_mask"), F.col("top.n").alias("top_count"), "rare_values", F.round("divergence", 6).alias("mask_divergence"))
