"""Evaluation passages leaking into training text: pigeonhole pieces and Myers verification.

Passages and documents are reduced to their letters and digits (compatibility forms folded, letter
case and everything else dropped) by one table gather over a whole Arrow batch. A passage of n letters
that must keep the share s in unbroken stretches of L letters has an error budget k: with k edits at
most, the k + 1 unbroken parts lose no more than L - 1 letters each where they are too short, so as long
as n - k - (k + 1)(L - 1) >= s n the passage is leaked wherever those edits are. It is split into k + 1
pieces or more, of at most (L + 1) // 2 letters, so that by the pigeonhole principle a copy within the
budget holds a whole piece, and so does every unbroken stretch of L letters. One automaton finds exact
piece hits in all documents. A document in which fewer pieces hit than the share needs is dismissed by a
bound that loses none. For the others the Myers bit-parallel distance of the passage to the hit window
decides: within the budget it is a leak. Only beyond it, where parts of a passage may lie anywhere in
any order, are the stretches measured exactly.

The corpus is only scanned, never shuffled. The items are the small side: they are read in blocks of a
bounded number of pieces, and each block is one scan.

Defined results
* null and empty texts and passages leak nothing; passages shorter than L cannot leak;
* repeated documents and items each count; an item whose language is not ``zh`` has the longer L;
* an empty corpus or item table gives an empty result; further columns are ignored;
* a text may have any length: batches are worked off in slices of bounded size.
"""

from __future__ import annotations

import math
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrow_text import code_points, slices
from tributary.plans.ship import ship

SHARE = 0.4
STRETCH = {"zh": 25}
STRETCH_ELSE = 40
PIECES_A_BLOCK = 250_000


@lru_cache(1)
def _table() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, flat): the letters and digits that each code point stands for."""
    size = 0x110000
    start, length, flat = np.arange(size, dtype=np.int32), np.zeros(size, np.int32), []
    for cp in range(size):
        if 0x4E00 <= cp < 0xA000 or 0x20000 <= cp < 0x2F800:
            length[cp] = 1
            continue
        if 0x30000 <= cp < 0xE0000 or 0xD800 <= cp < 0xF900 or cp >= 0xE0000:
            continue
        c = chr(cp)
        e = "".join(x for x in unicodedata.normalize("NFKD", unicodedata.normalize("NFKC", c).casefold()) if unicodedata.category(x)[0] in "LN")
        length[cp] = len(e)
        if e and e != c:
            start[cp] = size + len(flat)
            flat += map(ord, e)
    return start, length, np.concatenate([np.arange(size, dtype=np.uint32), np.array(flat, np.uint32)])


def letters(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Letters and digits of texts laid end to end, and their offsets."""
    start, length, flat = _table()
    n = length[cps]
    ends = np.cumsum(n, dtype=np.int64)
    bounds = np.concatenate([[0], ends])[offsets]
    keep = n == 1
    if not (n > 1).any():
        return flat[start[cps[keep]]], bounds
    s = start[cps]
    return flat[np.repeat(s - (ends - n), n) + np.arange(int(ends[-1]))], bounds


def normal(text: str) -> str:
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    return letters(cps, np.array([0, len(cps)]))[0].tobytes().decode("utf-32-le")


def budget(n: int, least: int, share: float = SHARE) -> int:
    """The most edits after which ``share`` of n letters is still in unbroken stretches of ``least``; -1 if none may be."""
    return max(-1, int((n - share * n - least + 1) // least)) if n >= least else -1


def myers(pattern: str, text: str) -> int:
    """The least edit distance of ``pattern`` to any stretch of ``text``, bit-parallel."""
    m = len(pattern)
    peq: dict[str, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    mask, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score = mask, 0, m
    best = m
    for c in text:
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & mask
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph = (ph << 1) & mask
        mh = (mh << 1) & mask
        pv = mh | ~(xv | ph) & mask
        mv = ph & xv
        if score < best:
            best = score
    return best


class Items:
    """A block of evaluation items with the automaton of their pieces."""

    def __init__(self, rows: list[tuple[object, str, str]], share: float = SHARE) -> None:
        self.ids, self.text, self.codes, self.stretch, self.piece, self.need, self.budget = [], [], [], [], [], [], []
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for item, lang, passage in rows:
            p = normal(passage or "")
            least = STRETCH.get(lang, STRETCH_ELSE)
            if len(p) < least:
                continue
            k, edits = len(self.ids), budget(len(p), least, share)
            q = min((least + 1) // 2, len(p) // (edits + 1)) if edits >= 0 else (least + 1) // 2
            self.ids.append(item)
            self.text.append(p)
            self.codes.append(np.frombuffer(p.encode("utf-32-le"), np.uint32))
            self.stretch.append(least)
            self.piece.append(q)
            self.budget.append(edits)
            # a stretch of m letters holds (m - q + 1) // q pieces at least, so a piece stands for at most 3q - 2 covered letters
            self.need.append(max(1, min(math.ceil(share * len(p) / (3 * q - 2)), len(p) // q - max(edits, 0))))
            for i in range(len(p) // q):
                places[p[i * q : (i + 1) * q]].append((k, i))
        self.share = share
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        if places:
            self.automaton.make_automaton()

    def leaks(self, doc: np.ndarray, hits: list[tuple[int, list[tuple[int, int]]]]) -> Iterator[tuple[object, float, int, int]]:
        """(item, share covered, edits, pieces hit) of each item that leaks; hits are (position, places)."""
        by: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for at, where in hits:
            for k, i in where:
                by[k].append((i, at))
        for k, found in by.items():
            pieces = {i for i, _ in found}
            if len(pieces) < self.need[k]:
                continue
            p, n, least = self.codes[k], len(self.codes[k]), self.stretch[k]
            diagonals: dict[int, int] = defaultdict(int)
            for i, at in found:
                diagonals[at - i * self.piece[k]] += 1
            main = max(diagonals, key=lambda d: (diagonals[d], -d))
            reach = max(self.budget[k], n // self.piece[k])
            lo, hi = max(0, main - reach), min(len(doc), main + n + reach)
            edits = myers(self.text[k], doc[lo:hi].tobytes().decode("utf-32-le"))
            if edits <= self.budget[k]:
                yield self.ids[k], (n - edits) / n, edits, len(pieces)
                continue
            share = self.measured(k, doc, diagonals)
            if share >= self.share:
                yield self.ids[k], share, edits, len(pieces)

    def measured(self, k: int, doc: np.ndarray, diagonals: dict[int, int]) -> float:
        """The share of the passage that is in unbroken stretches, each of which lies on a diagonal that was hit."""
        p, n, least = self.codes[k], len(self.codes[k]), self.stretch[k]
        covered = np.zeros(n, bool)
        for d in diagonals:
            a, b = max(0, -d), min(n, len(doc) - d)
            same = np.concatenate([[False], p[a:b] == doc[a + d : b + d], [False]])
            edge = np.flatnonzero(np.diff(same.view(np.int8)))
            for s, e in zip(edge[::2], edge[1::2], strict=True):
                if e - s >= least:
                    covered[a + s : a + e] = True
        return float(covered.mean())


def leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", lang: str = "lang", passage: str = "passage", share: float = SHARE, pieces_a_block: int = PIECES_A_BLOCK) -> DataFrame:
    """(key, item, share, edits, pieces) of every document and the items it leaks."""
    ship(docs)
    spark = docs.sparkSession
    pieces = items.agg(F.sum(F.ceil(F.length(passage) / 13))).first()[0] or 0
    blocks = max(1, math.ceil(pieces / pieces_a_block))
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"id {kind}, item {item_kind}, share double, edits int, pieces int"
    out = None
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64(item), F.lit(blocks)) == block).select(item, lang, passage).collect()
        shared = spark.sparkContext.broadcast([tuple(r) for r in rows])

        def scan(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            known = Items(shared.value, share)
            for b in batches:
                if not known.ids:
                    continue
                for part in slices(b, 1):
                    found = list(_scan(part.column(1), known))
                    if found:
                        take = pa.array([f[0] for f in found])
                        yield pa.RecordBatch.from_arrays(
                            [part.column(0).take(take), pa.array([f[1] for f in found]), pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int32()), pa.array([f[4] for f in found], pa.int32())],
                            names=["id", "item", "share", "edits", "pieces"],
                        )

        part = docs.select(key, text).filter(F.col(text).isNotNull()).mapInArrow(scan, schema)
        out = part if out is None else out.unionByName(part)
    return out.withColumnsRenamed({"id": key, "item": item})


def _scan(column: pa.Array, known: Items) -> Iterator[tuple]:
    cps, bounds = letters(*code_points(column))
    whole = cps.tobytes().decode("utf-32-le")
    hits = [(e + 1 - n, n, where) for e, (n, where) in known.automaton.iter(whole)]
    if not hits:
        return
    at = np.array([h[0] for h in hits])
    doc = np.searchsorted(bounds, at, "right") - 1
    inside = at + np.array([h[1] for h in hits]) <= bounds[doc + 1]
    by: dict[int, list] = defaultdict(list)
    for i in np.flatnonzero(inside):
        by[int(doc[i])].append((int(at[i] - bounds[doc[i]]), hits[i][2]))
    for d, found in by.items():
        for leak in known.leaks(cps[bounds[d] : bounds[d + 1]], found):
            yield d, *leak
