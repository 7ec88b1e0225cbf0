"""Splitting oversized texts at natural boundaries.

Every position after which a text may be cut has a strength: before a heading, after a paragraph, a
line, a sentence, a clause or a space. The strengths are the keys of a sparse table that answers
range-maximum queries in constant time; a key holds strength and position, so that the maximum is the
strongest cut and, among equals, the rightmost. A piece ends at the strongest cut of its permissible
window, and the next one begins ``overlap`` code points before that cut. The same table says whether a
text has a run without any boundary that is longer than the limit: from boundary to boundary it is
asked for the window of one code point more than the limit, and such a run is where it has no answer.

Defined results
* texts of at most ``limit`` code points, null and empty ones have no pieces;
* the window is the last part of the limit (``fill``); a boundary before it is taken where that lets the
  next piece reach another boundary, else the cut is forced at the limit, so that no slivers arise;
* consecutive pieces share the overlap, so a run longer than the limit less the overlap has a forced cut,
  though the text counts as ``forced`` only for a run longer than the limit itself;
* a text of any length is worked off in blocks, so that the table stays small;
* repeated rows give repeated pieces; an empty table gives an empty result; the key may be of any type.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.plans.ship import ship

LIMIT, OVERLAP = 4000, 200
#: A piece that is cut is at least this share of the limit, where a boundary allows it.
FILL = 0.5
BLOCK = 1 << 20

FORCED, SPACE, CLAUSE, SENTENCE, LINE, PARAGRAPH, HEADING = range(7)
NAMES = ["forced", "space", "clause", "sentence", "line", "paragraph", "heading"]

#: The characters after which a text may be cut.
SENTENCE_ENDS, CLAUSE_ENDS, SPACES = "。！？；.!?;", "，、,", " \t"


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def strengths(cps: np.ndarray) -> np.ndarray:
    """For each position the strength of a cut after it (0: none)."""
    s = np.zeros(len(cps), np.int64)
    for chars, k in ((SPACES, SPACE), (CLAUSE_ENDS, CLAUSE), (SENTENCE_ENDS, SENTENCE)):
        s[np.isin(cps, code_points(chars))] = k
    brk = (cps == 10) | (cps == 13)
    brk[:-1] &= ~((cps[:-1] == 13) & (cps[1:] == 10))
    ends = np.flatnonzero(brk)
    s[ends] = LINE
    following = cps[np.minimum(ends + 1, len(cps) - 1)]
    before = cps[np.maximum(ends - 1, 0)]
    s[ends[(before == 10) & (ends > 0)]] = PARAGRAPH
    s[ends[(following == 35) & (ends + 1 < len(cps))]] = HEADING
    s[(cps == 13) & ~brk] = 0
    return s


class RangeMaximum:
    """Sparse table over the cuts of one block: the strongest, rightmost cut of any window."""

    def __init__(self, at: np.ndarray, strength: np.ndarray, span: int) -> None:
        self.at = at
        levels = [(strength << 40) | at]
        widest = int((np.searchsorted(at, at + span, "right") - np.arange(len(at))).max(initial=1))
        k = 1
        while 2 * k <= widest:
            prev = levels[-1]
            levels.append(np.maximum(prev[:-k], prev[k:]))
            k *= 2
        self.levels = levels

    def query(self, lo: int, hi: int) -> tuple[int, int] | None:
        """(position, strength) of the best cut at a position in [lo, hi)."""
        i, j = np.searchsorted(self.at, (lo, hi))
        if i >= j:
            return None
        k = int(j - i).bit_length() - 1
        key = int(max(self.levels[k][i], self.levels[k][j - (1 << k)]))
        return key & ((1 << 40) - 1), key >> 40


class Cuts:
    """The boundaries of one text, with the table of the block that is being worked off."""

    def __init__(self, cps: np.ndarray, limit: int) -> None:
        self.cps, self.limit, self.lo, self.hi = cps, limit, 0, -1

    def _load(self, lo: int, hi: int) -> None:
        """Tables are made for a block and never for less than two limits, which is the widest window."""
        if self.lo <= lo and min(hi, len(self.cps)) <= self.hi:
            return
        self.lo, self.hi = lo, min(len(self.cps), lo + BLOCK + 2 * self.limit)
        before = max(0, lo - 1)
        s = strengths(self.cps[before : self.hi + 1])[lo - before :][: self.hi - lo]
        at = np.flatnonzero(s)
        self.table = RangeMaximum(at + lo, s[at], self.limit + 1)

    def best(self, lo: int, hi: int) -> tuple[int, int] | None:
        """(position, strength) of the strongest, rightmost boundary at a position in [lo, hi)."""
        self._load(lo, hi)
        return self.table.query(lo, hi)

    def around(self, start: int, at: int) -> tuple[int | None, int]:
        """The last boundary in [start, at), and the first one from ``at`` on within two limits of ``start``, or the end."""
        self._load(start, start + 2 * self.limit)
        a = self.table.at
        i = int(np.searchsorted(a, at))
        before = int(a[i - 1]) if i and a[i - 1] >= start else None
        return before, int(a[i]) if i < len(a) else self.hi - 1

    def unbroken(self) -> bool:
        """Whether more than ``limit`` code points follow each other without a boundary."""
        start, n = 0, len(self.cps)
        while n - start > self.limit:
            hit = self.best(start, start + self.limit + 1)
            if hit:
                start = hit[0] + 1
                continue
            # a carriage return before a line feed is no place to cut but does end a run
            other = np.flatnonzero(np.isin(self.cps[start : start + self.limit + 1], _BOUNDARIES))
            if not len(other):
                return True
            start += int(other[-1]) + 1
        return False


_BOUNDARIES = code_points("\n\r\t " + SENTENCE_ENDS + CLAUSE_ENDS)


def pieces(text: str, limit: int = LIMIT, overlap: int = OVERLAP, fill: float = FILL) -> tuple[list[tuple[int, int, str]], bool]:
    """((start, end, kind of the cut at the end) of each piece in order, whether a run is longer than the limit)."""
    if not 0 <= overlap < limit:
        raise ValueError("the overlap must be less than the limit")
    cuts = Cuts(code_points(text), limit)
    n, start = len(cuts.cps), 0
    out: list[tuple[int, int, str]] = []
    while n - start > limit:
        best = cuts.best(max(start + overlap, start + int(limit * fill) - 1), start + limit)
        if best is None:
            last, following = cuts.around(start + overlap, start + limit)
            if last is not None and following < last + 1 - overlap + limit:
                best = cuts.best(last, last + 1)
        end, kind = (best[0] + 1, NAMES[best[1]]) if best else (start + limit, NAMES[FORCED])
        out.append((start, end, kind))
        start = end - overlap
    if n:
        out.append((start, n, "end"))
    return out, cuts.unbroken()


def _grouped(parts: Iterator[tuple], chars: int = 1 << 20) -> Iterator[list[tuple]]:
    """Rows whose last value is a text, in lists of about ``chars`` characters."""
    held, size = [], 0
    for p in parts:
        held.append(p)
        size += len(p[-1])
        if size >= chars:
            yield held
            held, size = [], 0
    if held:
        yield held


def _oversized(df: DataFrame, key: str, text: str, limit: int) -> DataFrame:
    return df.filter(F.length(text) > limit).select(key, text)


def split(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, piece_no, start, end, cut, piece): the pieces of every text over the limit, from 0 on."""
    ship(df)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            types = [b.schema.field(0).type, pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string()]
            rows = ((k.as_py(), i, lo, hi, cut, text[lo:hi]) for k, t in zip(b.column(0), b.column(1), strict=True) for text in [t.as_py()] for i, (lo, hi, cut) in enumerate(pieces(text, limit, overlap)[0]))
            for part in _grouped(rows):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*part, strict=True), types, strict=True)], names=["key", "piece_no", "start", "end", "cut", "piece"])

    out = _oversized(df, key, text, limit).mapInArrow(run, f"key {kind}, piece_no int, start long, end long, cut string, piece string")
    return out.withColumnRenamed("key", key)


def split_report(df: DataFrame, key: str, text: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, cut, pieces, forced_cuts) of every text over the limit; ``cut`` is ``forced`` where a run
    without any boundary is longer than the limit, else ``boundary``."""
    ship(df)
    kind = df.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            done = [pieces(t.as_py(), limit, overlap) for t in b.column(1)]
            cut = pa.array(["forced" if unbroken else "boundary" for _, unbroken in done], pa.string())
            forced = pa.array([sum(p[2] == NAMES[FORCED] for p in parts) for parts, _ in done], pa.int32())
            yield pa.RecordBatch.from_arrays([b.column(0), cut, pa.array([len(parts) for parts, _ in done], pa.int32()), forced], names=["key", "cut", "pieces", "forced_cuts"])

    return _oversized(df, key, text, limit).mapInArrow(run, f"key {kind}, cut string, pieces int, forced_cuts int").withColumnRenamed("key", key)


def reassembled(parts: DataFrame, key: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """(key, text, pieces, fits, shared): the texts put together again from their pieces, the proof that nothing is lost.

    ``fits``: no piece is over the limit; ``shared``: every two neighbours share exactly the overlap. The
    pieces of one text come together in one task, as the text itself was.
    """
    p = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("piece_no", "start", "end", "piece"))).alias("p"))
    text = F.array_join(F.transform("p", lambda x: F.when(x["piece_no"] == 0, x["piece"]).otherwise(x["piece"].substr(F.lit(overlap + 1), F.length(x["piece"])))), "")
    pairs = F.zip_with(F.slice("p", 1, F.size("p") - 1), F.slice("p", 2, F.size("p")), lambda a, b: a["end"] - b["start"] == overlap)
    return p.select(key, text.alias("text"), F.size("p").alias("pieces"), F.forall("p", lambda x: F.length(x["piece"]) <= limit).alias("fits"), F.forall(pairs, lambda ok: ok).alias("shared"))
