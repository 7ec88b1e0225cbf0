"""References to records that do not exist: range-partitioned keys and binary search.

Keys are placed in equal ranges of a 64-bit hash, so that the ranges need no sampling and hold about
the same number of parents whatever the keys look like. Each cell (range, salt) streams its parents
first, in order, which gives one sorted array; the references that follow are probed batch by batch
with a vectorised binary search and the key itself is compared. A task holds the parents of one range
and one batch of references, never all references of a key: the references of each range are counted
first, those of a range with more than a cell should have are spread over as many salts as they need,
and the parents of that range, which are pre-aggregated to one row a key, are repeated for each salt.

Defined results
* null references, and references that are empty without their outer white space, are no cases;
* a parent whose created_at is null counts as always there; a reference without created_at is never
  ``late`` and has a null period;
* of the versions of an entity the one with the latest updated_at counts (null is earliest; ties go to
  the greater version, created_at, deleted_at, name and ontology);
* repeated references come out once; without parents every reference is ``missing``;
* further columns are ignored; reference texts may have any length.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.plans.ship import ship

#: Parents of one range, and references of one cell, that a task is meant to hold or stream.
PARENTS_A_RANGE = 50_000
REFERENCES_A_CELL = 1_000_000

OUTER = r"(?U)^\s+|\s+$"
ALWAYS = "0001-01-01 00:00:00"


def clean(ref: Column) -> Column:
    return F.regexp_replace(ref, OUTER, "")


def identifier(ref: Column) -> Column:
    """An id as it is compared: outer white space and letter case do not matter."""
    return F.lower(clean(ref))


def latest_version(entities: DataFrame) -> DataFrame:
    """One row an entity: the version with the latest updated_at."""
    order = F.struct("updated_at", "version", "created_at", "deleted_at", "name_cn", "ontology_id")
    return entities.groupBy(identifier(F.col("id")).alias("id")).agg(F.max(order).alias("v")).select("id", "v.ontology_id", "v.name_cn", "v.created_at", "v.deleted_at")


def _full(space: str, key: Column, scope: Column | None = None) -> Column:
    return F.concat_ws("\u0001", F.lit(space), F.coalesce(scope, F.lit("")) if scope is not None else F.lit(""), key)


def parent_rows(rows: DataFrame, *names: tuple[str, Column, Column | None]) -> DataFrame:
    """(key, live) of every row under each of its names (space, key, scope): live is null where it is deleted."""
    live = F.when(F.col("deleted_at").isNull(), F.coalesce(F.col("created_at").cast("timestamp_ntz"), F.lit(ALWAYS).cast("timestamp_ntz")))
    keys = [F.when(key != "", _full(space, key, scope)) for space, key, scope in names]
    return rows.select(F.explode(F.array(*keys)).alias("key"), live.alias("live")).filter(F.col("key").isNotNull())


def parent_keys(rows: DataFrame) -> DataFrame:
    """(key, first_live): when the earliest undeleted match was created, null where all are deleted."""
    return rows.groupBy("key").agg(F.min("live").alias("first_live"))


def references(rows: DataFrame, table: str, field: str, space: str, key, scope: Column | None = None, many: bool = False) -> DataFrame:
    """(key, table_name, field_name, row_key, ref_key, created_at) of every reference that is not empty."""
    ref = F.explode(field) if many else F.col(field)
    scope = F.coalesce(scope, F.lit("")) if scope is not None else F.lit("")
    out = rows.select(F.col("id").alias("row_key"), ref.alias("ref_key"), F.col("created_at").cast("timestamp_ntz").alias("created_at"), scope.alias("scope"))
    return out.filter(clean(F.col("ref_key")) != "").select(
        F.concat_ws("\u0001", F.lit(space), F.col("scope"), key(F.col("ref_key"))).alias("key"), F.lit(table).alias("table_name"), F.lit(field).alias("field_name"), "row_key", "ref_key", "created_at"
    )


def _micros(column: pa.Array) -> np.ndarray:
    return pc.fill_null(column.cast(pa.timestamp("us")).cast(pa.int64()), np.iinfo(np.int64).min).to_numpy(zero_copy_only=False)


OUT = pa.schema([("table_name", pa.string()), ("field_name", pa.string()), ("row_key", pa.string()), ("ref_key", pa.string()), ("kind", pa.string()), ("period", pa.string())])


class _Cell:
    """The sorted parents of one range."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, pa.Array, np.ndarray]] = []
        self.ready: tuple[np.ndarray, pa.Array, np.ndarray] | None = None

    def add(self, h: np.ndarray, keys: pa.Array, live: np.ndarray) -> None:
        self.parts.append((h, keys, live))

    def arrays(self) -> tuple[np.ndarray, pa.Array, np.ndarray]:
        if self.ready is None:
            if self.parts:
                h = np.concatenate([p[0] for p in self.parts])
                self.ready = h, pa.concat_arrays([p[1].cast(pa.large_string()) for p in self.parts]), np.concatenate([p[2] for p in self.parts])
            else:
                self.ready = np.empty(0, np.int64), pa.array([], pa.large_string()), np.empty(0, np.int64)
            self.parts = []
        return self.ready

    def probe(self, h: np.ndarray, keys: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For each reference, whether its key exists and when its first undeleted match was created."""
        parents, names, live = self.arrays()
        found, at = np.zeros(len(h), bool), np.full(len(h), np.iinfo(np.int64).min)
        left = np.searchsorted(parents, h, "left")
        todo = np.arange(len(h))
        while len(todo):  # further rounds only where different keys share a hash
            here = left[todo]
            inside = here < len(parents)
            todo, here = todo[inside], here[inside]
            same = parents[here] == h[todo]
            todo, here = todo[same], here[same]
            if not len(todo):
                break
            equal = pc.equal(names.take(pa.array(here)), keys.take(pa.array(todo)).cast(pa.large_string())).to_numpy(zero_copy_only=False)
            found[todo[equal]], at[todo[equal]] = True, live[here[equal]]
            todo = todo[~equal]
            left[todo] += 1
        return found, at


def _probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    none = np.iinfo(np.int64).min
    cell, cell_id = _Cell(), None
    for b in batches:
        if not b.num_rows:
            continue
        ids = np.stack([b.column("cell").to_numpy(zero_copy_only=False), b.column("salt").to_numpy(zero_copy_only=False)], 1)
        kinds = b.column("is_ref").to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((np.diff(ids, axis=0) != 0).any(1) | (np.diff(kinds) != 0)) + 1
        for lo, hi in zip([0, *cuts], [*cuts, b.num_rows], strict=True):
            if cell_id != tuple(ids[lo]):
                cell, cell_id = _Cell(), tuple(ids[lo])
            part = b.slice(lo, hi - lo)
            h = part.column("h").to_numpy(zero_copy_only=False)
            if not kinds[lo]:
                cell.add(h, part.column("key"), _micros(part.column("at")))
                continue
            found, live = cell.probe(h, part.column("key"))
            own = _micros(part.column("at"))
            deleted = found & (live == none)
            late = found & ~deleted & (own != none) & (live > own)
            miss = np.flatnonzero(~found | deleted | late)
            if len(miss):
                take = pa.array(miss)
                kind = np.where(~found, "missing", np.where(deleted, "deleted", "late"))[miss]
                at = part.column("at").take(take)
                # a reference that is written as its key was not sent twice
                written = pc.coalesce(part.column("ref_key").take(take), pc.replace_substring_regex(part.column("key").take(take), pattern=r"(?s)^[^\x01]*\x01[^\x01]*\x01", replacement=""))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c).take(take).cast(pa.string()) for c in ("table_name", "field_name", "row_key")), written.cast(pa.string()), pa.array(kind, pa.string()), pc.strftime(at.cast(pa.timestamp("us")), format="%Y-%m").cast(pa.string())], schema=OUT
                )


def placed(parents: DataFrame, refs: DataFrame, n_parents: int, parents_a_range: int = PARENTS_A_RANGE, references_a_cell: int = REFERENCES_A_CELL) -> DataFrame:
    """Parents and references with the cell and salt they are to meet in, and nowhere twice."""
    bits = max(0, math.ceil(math.log2(max(1, n_parents / parents_a_range))))
    h = F.xxhash64("key")
    cell = F.shiftrightunsigned(h, 64 - bits).cast("int") if bits else F.lit(0)
    # at most one row for each references_a_cell references, whatever the data
    crowded = refs.groupBy(cell.alias("cell")).agg(F.count("*").alias("n")).filter(F.col("n") > references_a_cell).select("cell", F.ceil(F.col("n") / references_a_cell).cast("int").alias("salts")).collect()
    salts = F.lit(1)
    keyed_p, keyed_r = parents.withColumn("cell", cell), refs.withColumn("cell", cell)
    if crowded:
        few = F.broadcast(parents.sparkSession.createDataFrame([tuple(r) for r in crowded], "cell int, salts int"))
        keyed_p, keyed_r = keyed_p.join(few, "cell", "left"), keyed_r.join(few, "cell", "left")
        salts = F.coalesce("salts", F.lit(1))
    null = F.lit(None).cast("string")
    side_p = keyed_p.select(
        "cell", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), F.lit(0).alias("is_ref"), h.alias("h"), "key", F.col("first_live").alias("at"),
        null.alias("table_name"), null.alias("field_name"), null.alias("row_key"), null.alias("ref_key"),
    )
    side_r = keyed_r.select(
        "cell", F.pmod(F.xxhash64("row_key", "ref_key", "field_name"), salts).cast("int").alias("salt"), F.lit(1).alias("is_ref"), h.alias("h"), "key", F.col("created_at").alias("at"),
        "table_name", "field_name", "row_key", F.when(~F.endswith(F.col("key"), F.concat(F.lit("\u0001"), F.col("ref_key"))), F.col("ref_key")).alias("ref_key"),
    )
    both = side_p.unionByName(side_r)
    tasks = 2**bits + sum(r.salts - 1 for r in crowded)
    if tasks > int(parents.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        return both.repartition(tasks, "cell", "salt")
    return both.repartition("cell", "salt")


def orphans(parents: DataFrame, refs: DataFrame, n_parents: int | None = None, parents_a_range: int = PARENTS_A_RANGE, references_a_cell: int = REFERENCES_A_CELL) -> DataFrame:
    """(table_name, field_name, row_key, ref_key, kind, period) of every reference without a valid parent.

    The number of parents only sizes the ranges; give an upper bound where it is cheaper to have than a count.
    """
    ship(parents)
    n_parents = parents.count() if n_parents is None else n_parents
    both = placed(parents, refs, n_parents, parents_a_range, references_a_cell).sortWithinPartitions("cell", "salt", "is_ref", "h")
    schema = "table_name string, field_name string, row_key string, ref_key string, kind string, period string"
    return both.mapInArrow(_probe, schema).distinct()  # only the misses


def ontology_orphans(entities: DataFrame, rules: DataFrame, relations: DataFrame, actions: DataFrame, **sizes: int) -> DataFrame:
    """The orphans among all references of relations and actions."""
    latest = latest_version(entities)
    scope = lambda df: identifier(df["ontology_id"])
    named = ("name", clean(F.col("name_cn")), identifier(F.col("ontology_id")))
    parents = parent_keys(parent_rows(latest, ("entity", F.col("id"), None), named).unionByName(parent_rows(rules, ("rule", identifier(F.col("id")), None))))
    refs = (
        references(relations, "relations", "source_entity", "entity", identifier)
        .unionByName(references(relations, "relations", "target_entity", "entity", identifier))
        .unionByName(references(actions, "actions", "linked_entities", "name", clean, scope(actions), many=True))
        .unionByName(references(actions, "actions", "linked_logic_ids", "rule", identifier, many=True))
    )
    return orphans(parents, refs, 2 * entities.count() + rules.count(), **sizes)
