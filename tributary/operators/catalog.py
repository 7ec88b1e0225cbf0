"""What surrounds the data: datasets, parents and children, reviews, versions and samples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def child_counts(parents: DataFrame, key: str, **children: DataFrame) -> DataFrame:
    """``parents`` with the number of each kind of child, 0 where there is none."""
    out = parents
    for name, child in children.items():
        out = out.join(child.groupBy(key).agg(F.count("*").alias(name)), key, "left")
    return out.fillna(0, list(children))


def latest(df: DataFrame, key: str, at: str, k: int) -> DataFrame:
    """(key, at) of the ``k`` groups with the latest ``at``; of equals the smaller key first."""
    return df.groupBy(key).agg(F.max(at).alias(at)).orderBy(F.desc(at), key).limit(k)


def page(df: DataFrame, order: list[str], size: int, number: int = 0) -> DataFrame:
    """One page of a list in order."""
    return df.orderBy(*order).offset(size * number).limit(size)


def collapsed(df: DataFrame, key: str, columns: list[str], order: list[str], count: str = "source_row_count") -> DataFrame:
    """One row a key: the columns of its first row in order, and how many rows it stands for; rows without a key are left out."""
    first = F.min_by(F.struct(*columns), F.struct(*order))
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(first.alias("__x"), F.count("*").alias(count)).select(key, "__x.*", count)


def keep_first(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row in order of each key, whole."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__x")).select(*keys, "__x.*")


def reconciled(left: DataFrame, right: DataFrame, key: str, names: tuple[str, str] = ("n_left", "n_right")) -> DataFrame:
    """(key, counts): the groups whose number of rows differs between two stores; null where a store has none."""
    ones = lambda df, a, b: df.select(key, F.lit(a).alias("__a"), F.lit(b).alias("__b"))
    both = ones(left, 1, 0).unionAll(ones(right, 0, 1)).groupBy(key).agg(F.sum("__a").alias("a"), F.sum("__b").alias("b"))
    return both.filter("a <> b").select(key, F.nullif("a", F.lit(0)).alias(names[0]), F.nullif("b", F.lit(0)).alias(names[1]))


def same_rows(left: DataFrame, right: DataFrame) -> DataFrame:
    """One row: whether two tables hold the same rows equally often."""
    signed = left.withColumn("__d", F.lit(1)).unionByName(right.withColumn("__d", F.lit(-1)))
    per = signed.groupBy(*left.columns).agg(F.sum("__d").alias("__d"))
    return per.agg(F.coalesce(F.max(F.abs("__d")) == 0, F.lit(True)).alias("equal"))


def samples(df: DataFrame, group: str, value: str, k: int) -> DataFrame:
    """(group, samples): the first ``k`` values of each group in order; no group is collected beyond them."""
    n = F.row_number().over(Window.partitionBy(group).orderBy(value))
    return df.select(group, value, n.alias("__n")).filter(F.col("__n") <= k).groupBy(group).agg(F.sort_array(F.collect_list(value)).alias("samples"))


def with_references(df: DataFrame, key: str, refs: str, known: DataFrame, known_id: str, found: str) -> DataFrame:
    """(key, ref, found): each reference of a list with the record it names; rows without a list and unknown references stay, with nulls."""
    x = df.select(key, F.explode_outer(refs).alias("ref"))
    return x.join(known.select(F.col(known_id).alias(found)).distinct(), F.col("ref") == F.col(found), "left").select(key, "ref", found)


def retained(df: DataFrame, key: str, refs: str, live: DataFrame, live_id: str) -> DataFrame:
    """Rows that refer to at least one live record, once each."""
    hit = df.select(key, F.explode(refs).alias("__r")).join(live.select(F.col(live_id).alias("__r")), "__r", "left_semi").select(key).distinct()
    return df.join(hit, key, "left_semi")


def without_live(df: DataFrame, key: str, live: DataFrame) -> DataFrame:
    """The keys of ``df`` that no live row has."""
    return df.select(key).distinct().join(live.select(key), key, "left_anti")


def ordered_pairs(names: list[str]) -> list[tuple[str, str]]:
    """Every dataset with every other one, both ways: names of configuration, not data."""
    return [(a, b) for a in names for b in names if a != b]


def reviewed(df: DataFrame, publish: Column, status: str = "status", enabled: str = "enabled") -> DataFrame:
    """Rules and actions after review: what ``publish`` holds for becomes active, what is retired is switched off."""
    return df.withColumns({status: F.when(publish, "active").otherwise(F.col(status)), enabled: F.when(F.col(status) == "retired", False).otherwise(F.col(enabled))})


def new_relations(edges: DataFrame, proposed: DataFrame, columns: tuple[str, ...] = ("source_entity", "target_entity", "type")) -> DataFrame:
    """Proposed edges with both ends that are not there yet, once each."""
    p = proposed.select(*columns).filter(" and ".join(f"{c} is not null" for c in columns[:2])).distinct()
    return p.join(edges, list(columns), "left_anti")


def synced(old: DataFrame | None, new: DataFrame, mode: str) -> DataFrame:
    """What a dataset holds after a load: ``append`` adds, ``snapshot`` replaces."""
    if mode not in ("append", "snapshot"):
        raise ValueError(f"unknown sync mode {mode!r}")
    return new if old is None or mode == "snapshot" else old.unionByName(new, allowMissingColumns=True)
