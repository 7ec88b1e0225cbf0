"""The best partner of each name among the names of its group, by containment or by ratio of matching blocks, without comparing all pairs.

Candidates come from one equality join on keys that no pair within the limits can miss:

* Ratio. Names of T characters together that reach the ratio leave at most D of them unmatched. With the alphabet dealt
  into D + 1 classes, each unmatched character spoils one class, so in one class at least both names have the
  same characters in the same order.
* Containment. All parts of at least half a name are keys of the container; containers of more than ``SHORT`` characters have
  aligned blocks instead, of which each part of half their length covers one.

What is left after bounds on lengths and sets of characters is checked in batches: the longest common subsequence bounds the
ratio from above, and the exact ratio is worked out from the highest bound down until no bound can beat what was found.
"""

from __future__ import annotations

import difflib
import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

SHORT, SLICE = 32, 4096
RATIO, HOLDS, HELD = 0, 1, 2


def most_edits(total: int, least: float) -> int:
    """How many of ``total`` characters of two names may be unmatched at a ratio of ``least``; below 0: it cannot be reached."""
    same = math.ceil(total * least / 2)
    while same and 2.0 * (same - 1) / total >= least:
        same -= 1
    while same <= total and 2.0 * same / total < least:
        same += 1
    return total - 2 * same


def classes(edits: int) -> int:
    """One more than ``edits``, from 16 on rounded up by an eighth at most, so that long names have few numbers of classes."""
    step = 1 << max(0, (edits + 1).bit_length() - 4)
    return -(-(edits + 1) // step) * step


@cache
def windows(n: int, least: float) -> list[tuple[int, int, int, int]]:
    """(parity of the length together, classes, least and most length of the partner) for a name of ``n`` characters."""
    out: dict[tuple[int, int], list[int]] = {}
    for other in range(math.floor(n * least / (2 - least)), math.ceil(n * (2 - least) / least) + 1):
        edits = most_edits(n + other, least) if other else -1
        if edits > 0 and edits >= abs(n - other):
            w = out.setdefault(((n + other) % 2, classes(edits)), [other, other])
            w[1] = other
    return [(parity, p, lo, hi) for (parity, p), (lo, hi) in out.items()]


def ratio_keys(name: str, least: float) -> Iterator[tuple[str, int, int]]:
    for parity, p, lo, hi in windows(len(name), least):
        dealt: list[list[str]] = [[] for _ in range(p)]
        for ch in name:
            dealt[ord(ch) % p].append(ch)
        for j, part in enumerate(dealt):
            yield f"={parity},{p},{j},{''.join(part)}", lo, hi


def _width(n: int) -> int:
    return 1 << ((n // 4).bit_length() - 1)


def holder_keys(name: str) -> set[str]:
    """Keys of a name as the container of others."""
    n = len(name)
    if n <= SHORT:
        return {name[i : i + size] for size in range(max(2, (n + 1) // 2), n) for i in range(n - size + 1)}
    w = _width(n)
    return {name[i : i + w] for i in range(0, n - w + 1, w)}


def held_keys(name: str) -> set[str]:
    """Keys of a name as a part of others: itself, and what a long container's block may be."""
    n = len(name)
    widths = {_width(x) for x in range(max(SHORT, n) + 1, 2 * n + 1)}
    return ({name} if 2 <= n < SHORT else set()) | {name[i : i + w] for w in widths for i in range(n - w + 1)}


def _characters(name: str) -> int:
    bits = 0
    for ch in set(name):
        bits |= 1 << ((ord(ch) * 0x9E3779B1 >> 13) & 63)
    return bits - (1 << 64) if bits >> 63 else bits


def keyed(df: DataFrame, least: float, sought: bool) -> DataFrame:
    """Columns of ``df``, which has a column name, with h, way, lo, hi and bits: a row for each key. ``sought``: the side that looks for partners."""
    schema = StructType(list(df.schema.fields)).add("bits", "long").add("keys", ArrayType(StructType().add("key", "string").add("way", "integer").add("lo", "integer").add("hi", "integer")))
    holds, held = (">", "<") if sought else ("<", ">")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits, at, key, way, lo, hi = [], [0], [], [], [], []
            for name in batch.column("name").to_pylist():
                bits.append(_characters(name))
                mine = list(ratio_keys(name, least))
                big, small = holder_keys(name), held_keys(name)
                key += [k for k, _, _ in mine] + [holds + k for k in big] + [held + k for k in small]
                way += [RATIO] * len(mine) + [HOLDS] * len(big) + [HELD] * len(small)
                lo += [x for _, x, _ in mine] + [0] * (len(big) + len(small))
                hi += [x for _, _, x in mine] + [0] * (len(big) + len(small))
                at.append(len(key))
            rows = pa.StructArray.from_arrays([pa.array(key, pa.string()), pa.array(way, pa.int32()), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())], names=["key", "way", "lo", "hi"])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(bits, pa.int64()), pa.ListArray.from_arrays(pa.array(at, pa.int32()), rows)], names=[*batch.schema.names, "bits", "keys"])

    k = df.mapInArrow(keys, schema).select(*df.columns, "bits", F.explode("keys").alias("k"))
    return k.select(*df.columns, "bits", F.xxhash64("group", "k.key").alias("h"), "k.way", "k.lo", "k.hi")


def _points(texts: list[str], pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points, a row for each text, and the lengths."""
    size = np.array([len(t) for t in texts], np.int64)
    out = np.full((len(texts), max(1, int(size.max(initial=0)))), pad, np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return out, size


def common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Length of the longest common subsequence of each row of ``a`` and ``b``."""
    a, b = np.ascontiguousarray(a.T), np.ascontiguousarray(b.T)
    have = np.zeros((len(b) + 1, b.shape[1]), np.int16 if len(b) < 1 << 15 else np.int32)
    for x in a:
        have[1:] = np.maximum.accumulate(np.maximum(have[1:], have[:-1] + (b == x)), axis=0)
    return have[-1]


def _bounds(n_at: np.ndarray, names: list[str], m_at: np.ndarray, others: list[str]) -> np.ndarray:
    """The most that the ratio of each pair can be."""
    (a, la), (b, lb) = _points(names, 0xFFFFFFFF), _points(others, 0xFFFFFFFE)
    x, y = la[n_at], lb[m_at]
    same, order = np.zeros(len(n_at), np.int64), np.lexsort((y, x))
    for lo in range(0, len(order), SLICE):
        part = order[lo : lo + SLICE]
        same[part] = common(a[n_at[part], : x[part].max()], b[m_at[part], : y[part].max()])
    return 2.0 * same / (x + y)


def _coded(column: pa.Array) -> tuple[np.ndarray, list]:
    d = column.dictionary_encode()
    return d.indices.to_numpy(zero_copy_only=False).astype(np.int64), d.dictionary.to_pylist()


def _is_part(n: str, m: str) -> bool:
    short, long_ = sorted((len(n), len(m)))
    return short >= 2 and 2 * short >= long_ and (n in m or m in n)


def best_of(batch: pa.RecordBatch, least: float) -> Iterator[tuple]:
    """(group, name, method, score, partner): the best of each name among the pairs (group, name, other, partner, way) of a batch."""
    g_at, groups = _coded(batch.column("group"))
    n_at, names = _coded(batch.column("name"))
    m_at, others = _coded(batch.column("other"))
    p_at, partners = _coded(batch.column("partner"))
    rank = np.empty(len(partners), np.int64)
    rank[sorted(range(len(partners)), key=partners.__getitem__)] = np.arange(len(partners))
    by_ratio = batch.column("way").to_numpy() == RATIO
    la, lb = np.array([len(t) for t in names])[n_at], np.array([len(t) for t in others])[m_at]
    score = 0.80 + 0.08 * np.minimum(la, lb) / np.maximum(la, lb)
    score[by_ratio] = _bounds(n_at[by_ratio], names, m_at[by_ratio], others)
    keep = np.flatnonzero(~by_ratio | (score >= least))
    who = g_at * len(names) + n_at
    keep = keep[np.lexsort((rank[p_at[keep]], -score[keep], by_ratio[keep], who[keep]))]  # parts come before ratios
    starts = np.flatnonzero(np.diff(who[keep], prepend=-1))
    for lo, hi in zip(starts, [*starts[1:], len(keep)], strict=True):
        name, top, at, method = names[n_at[keep[lo]]], -1.0, -1, ""
        if not by_ratio[keep[lo]]:
            top, at, method = float(score[keep[lo]]), keep[lo], "substring"
        for i in keep[lo:hi]:
            if not by_ratio[i]:
                continue
            if score[i] < top or (score[i] == top and method == "ratio" and rank[p_at[i]] >= rank[p_at[at]]):
                break
            other = others[m_at[i]]
            if _is_part(name, other):
                continue
            s = difflib.SequenceMatcher(None, name, other).ratio()
            if s >= least and (s > top or (s == top and (method != "ratio" or rank[p_at[i]] < rank[p_at[at]]))):
                top, at, method = s, i, "ratio"
        if method:
            yield groups[g_at[at]], name, method, top, partners[p_at[at]]


def best_partners(names: DataFrame, others: DataFrame, least: float) -> DataFrame:
    """(group, name, method, score, partner) of the best partner: highest score, then method, then smallest partner.

    ``names`` has group and name, ``others`` group, name and partner, each name once in a group; a name that is
    among the others of its group has no place here.
    """
    n = keyed(names, least, True)
    m = keyed(others, least, False).select("h", F.col("group").alias("m_group"), F.col("name").alias("other"), F.col("bits").alias("m_bits"), "partner")
    a, b = F.length("name"), F.length("other")
    ratio = b.between(F.col("lo"), F.col("hi")) & (F.bit_count(F.col("bits").bitwiseXOR(F.col("m_bits"))) <= F.floor((a + b) * (1 - least) + 1e-6))
    holds = (2 * b >= a) & F.contains("name", "other")
    held = (2 * a >= b) & F.contains("other", "name")
    fits = F.when(F.col("way") == RATIO, ratio).when(F.col("way") == HOLDS, (b >= 2) & holds).otherwise((a >= 2) & held)
    pairs = n.join(m, (n["h"] == m["h"]) & (F.col("group") == F.col("m_group")) & fits).select("group", "name", "other", "partner", "way")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                rows = list(best_of(batch, least))
                types = [batch.schema.field("group").type, pa.string(), pa.string(), pa.float64(), batch.schema.field("partner").type]
                cols = zip(*rows, strict=True) if rows else [[]] * 5
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types, strict=True)], names=["group", "name", "method", "score", "partner"])

    schema = StructType([names.schema["group"]]).add("name", "string").add("method", "string").add("score", "double").add("partner", others.schema["partner"].dataType)
    top = pairs.mapInArrow(best, schema).groupBy("group", "name").agg(F.min(F.struct((-F.col("score")).alias("s"), "method", "partner")).alias("x"))
    return top.select("group", "name", "x.method", (-F.col("x.s")).alias("score"), "x.partner")
