"""Filling fixed-capacity containers: dominance reduction on the size histogram, then best fit.

Only the number of items of each size matters for packing, and there are at most ``capacity`` sizes,
so the histogram (at most ``capacity`` rows, whatever the data) is packed on the driver. The reduction
of Martello and Toth fixes an item alone or with one partner wherever that set provably dominates every
other way to fill its container; the rest is packed by best fit, largest sizes first. Both work on
sizes with multiplicities: a container pattern is repeated as often as the counts allow.

The result assigns runs of ranks within a size to runs of containers. Items get their rank from a hash
bucket and a window inside it, so that one hot size is spread over many tasks; runs are looked up by a
vectorised binary search in a table whose size depends on ``capacity`` only.

Defined results
* an item over the capacity is split into full containers and one remainder, which is an item again;
* null text has no item; empty text has one end token; rows with equal ids are items of their own;
* an empty table gives no containers; further columns are ignored; a text may have any length.
"""

from __future__ import annotations

import math
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.plans.durable import cut
from tributary.plans.ship import ship

CAPACITY = 4096
ROWS_A_BUCKET = 500_000


def byte_tokens(text: Column) -> Column:
    """Tokens of a byte-level tokenizer: one a UTF-8 byte, and one end token."""
    return F.octet_length(text).cast("long") + 1


@dataclass
class Pattern:
    """``times`` containers that each hold ``content`` (size, how many)."""

    content: tuple[tuple[int, int], ...]
    times: int


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> tuple[list[Pattern], dict[int, int]]:
    """Patterns that some optimal packing contains, and what is left.

    For each item, largest first, with free space r beside it: where no other item fits, it stays
    alone; where only one fits, or the largest single partner is as large as every pair that fits and
    no three fit, the set with that partner dominates all others. Items that cannot be fixed stay
    partners for smaller ones.
    """
    left = {s: n for s, n in counts.items() if n > 0}
    sizes = sorted(left)
    fixed: list[Pattern] = []

    def smallest(k: int, without: int) -> list[int]:
        out: list[int] = []
        for s in sizes:
            free = left[s] - (s == without)
            out += [s] * min(free, k - len(out))
            if len(out) == k:
                break
        return out

    j = sizes[-1] if sizes else 0
    while j:
        r = capacity - j
        low = smallest(3, j)
        used = (j,)
        if not low or low[0] > r:
            fixed.append(Pattern(((j, 1),), left[j]))
            left[j] = 0
        else:
            at = bisect_left(sizes, r + 1) - 1
            if sizes[at] == j and left[j] < 2:
                at -= 1
            partner = sizes[at]
            dominated = partner == r or len(low) < 2 or low[0] + low[1] > r
            if not dominated and (len(low) < 3 or sum(low) > r):
                dominated = partner >= _best_pair(sizes, left, j, r)
            if dominated and partner == j:
                n = left[j] // 2
                fixed.append(Pattern(((j, 2),), n))
                left[j] -= 2 * n
            elif dominated:
                n = min(left[j], left[partner])
                fixed.append(Pattern(((j, 1), (partner, 1)), n))
                left[j] -= n
                left[partner] -= n
                used = (j, partner)
            else:
                n = 0
            if not n:
                at = bisect_left(sizes, j)
                j = sizes[at - 1] if at else 0
                continue
        for s in used:
            if not left[s]:
                left.pop(s)
                sizes.remove(s)
        if j not in left:
            at = bisect_left(sizes, j)
            j = sizes[at - 1] if at else 0
    return fixed, left


def _best_pair(sizes: list[int], left: dict[int, int], without: int, r: int) -> int:
    """The largest sum of two items that is at most r."""
    free = [s for s in sizes[: bisect_left(sizes, r + 1)] if left[s] > (s == without)]
    best, i, j = 0, 0, len(free) - 1
    while i <= j:
        s = free[i] + free[j]
        if s > r:
            j -= 1
            continue
        if i < j or left[free[i]] - (free[i] == without) > 1:
            best = max(best, s)
        i += 1
    return best


def best_fit(counts: dict[int, int], capacity: int, open_: list[Pattern] = ()) -> list[Pattern]:
    """Best fit, largest first, on sizes with multiplicities."""
    groups: dict[int, list[Pattern]] = defaultdict(list)
    spaces: list[int] = []

    def put(p: Pattern, space: int) -> None:
        if p.times:
            if not groups[space]:
                insort(spaces, space)
            groups[space].append(p)

    for p in open_:
        put(p, capacity - sum(s * n for s, n in p.content))
    for size in sorted(counts, reverse=True):
        n = counts[size]
        while n:
            at = bisect_left(spaces, size)
            if at == len(spaces):
                each = capacity // size
                full, rest = divmod(n, each)
                put(Pattern(((size, each),), full), capacity - each * size)
                put(Pattern(((size, rest),), 1 if rest else 0), capacity - rest * size)
                n = 0
                break
            space = spaces[at]
            p = groups[space].pop()
            if not groups[space]:
                spaces.pop(at)
            each = min(space // size, n)
            times = min(p.times, n // each)
            put(Pattern(p.content, p.times - times), space)
            put(Pattern((*p.content, (size, each)), times), space - each * size)
            n -= each * times
    return [p for ps in groups.values() for p in ps]


def pack(counts: dict[int, int], capacity: int = CAPACITY) -> list[Pattern]:
    """Patterns that hold every item once."""
    fixed, rest = reduce_by_dominance(counts, capacity)
    return _merge(fixed + best_fit(rest, capacity))


def _merge(patterns: list[Pattern]) -> list[Pattern]:
    times: dict[tuple, int] = defaultdict(int)
    for p in patterns:
        content: dict[int, int] = defaultdict(int)
        for s, n in p.content:
            content[s] += n
        times[tuple(sorted(content.items(), reverse=True))] += p.times
    return [Pattern(c, n) for c, n in sorted(times.items(), reverse=True) if n]


def runs(patterns: list[Pattern]) -> dict[str, np.ndarray]:
    """Of each run of ranks within a size: its first rank, how many of the size a container takes, its first container."""
    nexts: dict[int, int] = defaultdict(int)
    rows, container = [], 0
    for p in patterns:
        for size, each in p.content:
            rows.append((size, nexts[size], each, container))
            nexts[size] += each * p.times
        container += p.times
    a = np.array(sorted(rows), np.int64).reshape(-1, 4)
    return {"size": a[:, 0], "rank": a[:, 1], "each": a[:, 2], "container": a[:, 3]}


def assign(items: DataFrame, capacity: int = CAPACITY, rows_a_bucket: int = ROWS_A_BUCKET) -> DataFrame:
    """(id, tokens) -> (id, piece_no, pieces, tokens, container): every piece of every item in a container.

    ``container`` numbers are consecutive from 0; full pieces of split items come after the packed ones.
    """
    ship(items)
    sized = items.filter("tokens > 0").select("id", "tokens", ((F.col("tokens") - 1) % capacity + 1).cast("int").alias("size"))
    sized = cut(sized.withColumn("salt", F.xxhash64("id", "tokens")))
    total = sized.count()
    buckets = max(1, math.ceil(total / rows_a_bucket))
    keyed = sized.withColumn("bucket", F.pmod("salt", F.lit(buckets)).cast("int"))
    # one row a bucket and size: its histogram, and how many of the size there are in earlier buckets
    by = keyed.groupBy("bucket", "size").agg(F.count("*").alias("n"), F.sum(F.floor((F.col("tokens") - 1) / capacity)).alias("full"))
    by = cut(by)
    counts = {r["size"]: r.n for r in by.groupBy("size").agg(F.sum("n").alias("n")).collect()}
    patterns = pack(counts, capacity)
    table = items.sparkSession.sparkContext.broadcast(runs(patterns))
    packed = sum(p.times for p in patterns)
    before = Window.partitionBy("size").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    full_before = by.groupBy("bucket").agg(F.sum("full").alias("full")).withColumn("full_before", F.coalesce(F.sum("full").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    offsets = by.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).join(full_before.select("bucket", "full_before"), "bucket").select("bucket", "size", "before", "full_before")
    order = Window.partitionBy("bucket", "size").orderBy("id", "tokens")
    ranked = keyed.join(offsets, ["bucket", "size"]).withColumn("rank", F.col("before") + F.row_number().over(order) - 1)
    full = F.floor((F.col("tokens") - 1) / capacity)
    earlier = F.coalesce(F.sum(F.when(full > 0, full)).over(Window.partitionBy("bucket").orderBy("size", "rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    small = ranked.filter(full == 0).withColumn("first_full", F.lit(0).cast("long"))
    large = ranked.filter(full > 0).withColumn("first_full", packed + F.col("full_before") + earlier)
    kind = items.schema["id"].dataType.simpleString()

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t = table.value
        key = t["size"] << 45 | t["rank"]
        for b in batches:
            size, rank = (b.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("size", "rank"))
            run = np.searchsorted(key, size << 45 | rank, "right") - 1
            at = t["container"][run] + (rank - t["rank"][run]) // t["each"][run]
            yield pa.RecordBatch.from_arrays([b.column("id"), b.column("tokens"), b.column("first_full"), pa.array(at)], names=["id", "tokens", "first_full", "container"])

    placed = small.unionByName(large).select("id", "tokens", "size", "rank", "first_full").mapInArrow(place, f"id {kind}, tokens long, first_full long, container long")
    pieces = F.ceil(F.col("tokens") / capacity).cast("int")
    piece = F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece_no")
    return placed.withColumn("pieces", pieces).select("id", "tokens", "pieces", "first_full", "container", piece).select(
        "id",
        "piece_no",
        "pieces",
        F.when(F.col("piece_no") < F.col("pieces") - 1, F.lit(capacity)).otherwise((F.col("tokens") - 1) % capacity + 1).cast("int").alias("tokens"),
        F.when(F.col("piece_no") < F.col("pieces") - 1, F.col("first_full") + F.col("piece_no")).otherwise(F.col("container")).alias("container"),
    )


def container_report(assigned: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """One row: items, containers, the fewest containers that could hold all tokens, and the share filled."""
    per = assigned.groupBy("container").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("items"))
    out = per.agg(F.sum("items").alias("items"), F.count("*").alias("containers"), F.ceil(F.sum("tokens") / capacity).alias("at_least"), F.max("tokens").alias("fullest"), (F.sum("tokens") / (F.count("*") * capacity)).alias("filled"))
    return out
