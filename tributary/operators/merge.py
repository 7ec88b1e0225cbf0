"""Merging repeated records and calibrating their confidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def richness(columns: list[str]) -> Column:
    """Characters of all attributes that have a value."""
    return sum((F.coalesce(F.length(F.col(c).cast("string")), F.lit(0)) for c in columns), F.lit(0))


def keep_richest(df: DataFrame, keys: list[str], columns: list[str], order: list[str]) -> DataFrame:
    """Of equal keys the row with most text; of equals the first in order."""
    ranked = df.groupBy(*keys).agg(F.min_by(F.struct(*df.columns), F.struct(-richness(columns), *[F.col(o) for o in order])).alias("x"))
    return ranked.select("x.*")


def fold_richer(df: DataFrame, key: str, columns: list[str], order: list[str]) -> DataFrame:
    """The first row of each key; a later row with more text than it fills its blanks, in order."""
    item = F.struct(*[F.col(o) for o in order], *[F.col(c).cast("string").alias(f"_{c}") for c in columns])
    rows = df.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("rows"))
    size = lambda x: sum((F.coalesce(F.length(x[f"_{c}"]), F.lit(0)) for c in columns), F.lit(0))
    pick = lambda a, x: F.struct(*[F.coalesce(F.nullif(a[f"_{c}"], F.lit("")), F.when(size(x) > size(a), x[f"_{c}"])).alias(f"_{c}") for c in columns])
    first = F.struct(*[F.element_at("rows", 1)[f"_{c}"].alias(f"_{c}") for c in columns])
    return rows.select(key, F.aggregate(F.slice("rows", 2, 1 << 30), first, pick).alias("m")).select(key, *[F.col(f"m._{c}").alias(c) for c in columns])


def calibrated(base: Column, adjust: Column, least: float = 0.30) -> Column:
    return F.round(F.greatest(F.lit(least), F.least(F.lit(0.98), F.coalesce(base, F.lit(0.85)) + adjust)), 3)


def bands(confidence: Column, high: float = 0.85, medium: float = 0.6) -> Column:
    return F.when(confidence >= high, "high").when(confidence >= medium, "medium").otherwise("low")
