"""One consistent form for text that looks the same.

A batch of texts is copied from Arrow into one array of code points. A lookup table gathered over the
array gives each code point its replacement (a slice of a flat table: none, one or several code
points), expansion offsets place them, and combining marks are ordered and composed with array
operations; no text is handled by itself.

The table is a rule over the Unicode data: compatibility forms are expanded unless they look different
(raised and lowered figures, circled ones, fractions), invisible characters vanish, every space becomes
a plain space, hyphens that look alike become one, and letters of other scripts that look like Latin
ones become those. Mathematical and full-width letters and digits follow from the Unicode data; the
look-alike letters of Cyrillic, Greek, Armenian and Cherokee are a parameter of ``Tables``.

Defined results
* a null text stays null; texts without visible characters take part in no pair;
* line breaks, letter case, accents and digits stay; a text may have any length;
* equal texts are no pair; repeated ids count as rows of their own, but no id is paired with itself;
* an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.llm.arrow_text import code_points, slices
from tributary.plans.durable import cut
from tributary.plans.ship import ship

#: Letters that look like Latin ones, and the Latin ones.
LOOKALIKES = {
    "АВЕЅЗІЈКМНОРСТУХҮԌԚԜ": "ABESZIJKMHOPCTYXYGQW",
    "аеѕіјорсухһԁԛԝӏ": "aesijopcyxhdqwl",
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧϹϺϲϳο": "ABEZHIKMNOPTYXCMcjo",
    "ՍՏՕօսհոցզ": "USOouhngq",
    "ᎠᎡᎢᎪᎫᎬᎳᎷᎻᏀᏃᏏᏒᏙᏚᏞᏟᏢᏦᏧ": "DRTAJEWMHGZbRVSLCPKd",
    "ⅼ‐‑⁃﹣": "l----",
}
#: A look-alike that is not one in every typeface, and a different letter to readers of its script.
NOT_ALIKE = "З"
#: Compatibility decompositions that change what is seen.
DIFFERENT = ("<super>", "<sub>", "<circle>", "<fraction>")
INVISIBLE = {0x34F, 0x115F, 0x1160, 0x17B4, 0x17B5, 0x3164, 0xFFA0, *range(0x180B, 0x1810), *range(0xFE00, 0xFE10), *range(0xE0100, 0xE01F0)}
SIZE = 0x110000
#: Rows of one spelling that are paired in one task with as many of another.
BLOCK = 2_000


def _expand(cp: int) -> str:
    c = chr(cp)
    cat = unicodedata.category(c)
    if c in "\n\r":
        return c
    if cp in INVISIBLE or cat in ("Cf", "Cc") and c != "\t":
        return ""
    if cat == "Zs" or c == "\t":
        return " "
    if cat in ("Zl", "Zp"):
        return "\n"
    if 0xAC00 <= cp < 0xD7A4:
        return c
    alike = _alike().get(c)
    if alike:
        return alike
    parts = unicodedata.decomposition(c).split()
    if not parts:
        return c
    if parts[0][0] == "<":
        if parts[0] in DIFFERENT or parts[1] == "0020":
            return c
        parts = parts[1:]
    return "".join(_expand(int(p, 16)) for p in parts)


@lru_cache(1)
def _alike() -> dict[str, str]:
    return {a: b for left, right in LOOKALIKES.items() for a, b in zip(left, right, strict=True) if a not in NOT_ALIKE}


class Tables:
    """Replacement slices, combining classes and compositions of all code points."""

    def __init__(self) -> None:
        flat: list[int] = []
        self.start, self.length = np.arange(SIZE, dtype=np.int32), np.ones(SIZE, np.int32)
        for cp in range(SIZE):
            c = chr(cp)
            if 0x4E00 <= cp < 0xA000 or 0x20000 <= cp < 0x2F800 or 0x30000 <= cp < 0xE0000 or cp >= 0xE0200 or 0xD800 <= cp < 0xF900 or 0xAC00 <= cp < 0xD7A4:
                continue
            e = _expand(cp)
            if e != c:
                self.start[cp], self.length[cp] = SIZE + len(flat), len(e)
                flat += map(ord, e)
        self.flat = np.concatenate([np.arange(SIZE, dtype=np.uint32), np.array(flat, np.uint32)])
        self.classes = np.fromiter((unicodedata.combining(chr(c)) for c in range(SIZE)), np.uint8, SIZE)
        pairs = {}
        for cp in range(SIZE):
            parts = unicodedata.decomposition(chr(cp)).split() if not 0xAC00 <= cp < 0xD7A4 else []
            if len(parts) == 2 and parts[0][0] != "<" and unicodedata.normalize("NFC", chr(cp)) == chr(cp):
                pairs[int(parts[0], 16) << 21 | int(parts[1], 16)] = cp
        keys = sorted(pairs)
        self.pair, self.composed = np.array(keys, np.int64), np.array([pairs[k] for k in keys], np.uint32)
        second = np.zeros(SIZE, bool)
        second[self.pair & 0x1FFFFF] = True
        second[0x1161:0x1176] = second[0x11A8:0x11C3] = True
        self.second = second

    def compose(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The composition of each pair, 0 where there is none."""
        key = a.astype(np.int64) << 21 | b
        i = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        out = np.where(self.pair[i] == key, self.composed[i], 0)
        lv = (a >= 0x1100) & (a < 0x1113) & (b >= 0x1161) & (b < 0x1176)
        out = np.where(lv, 0xAC00 + ((a.astype(np.int64) - 0x1100) * 21 + b.astype(np.int64) - 0x1161) * 28, out)
        lvt = (a >= 0xAC00) & (a < 0xD7A4) & ((a.astype(np.int64) - 0xAC00) % 28 == 0) & (b >= 0x11A8) & (b < 0x11C3)
        return np.where(lvt, a.astype(np.int64) + b - 0x11A7, out)


@lru_cache(1)
def tables() -> Tables:
    return Tables()


def canonical(cps: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The consistent form of texts laid end to end; ``offsets`` has one more entry than there are texts."""
    t = tables()
    start, length = t.start[cps], t.length[cps]
    ends = np.cumsum(length, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    bounds = np.concatenate([[0], ends])[offsets]
    if total == len(cps) and (length == 1).all():
        out = t.flat[start]
    else:
        at = np.repeat(start - (ends - length), length) + np.arange(total)
        out = t.flat[at]
    if not len(out) or not t.second[out].any() and not t.classes[out].any():
        return out, bounds
    return _marks(out, bounds)


def _marks(cps: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Combining marks put into canonical order and composed with the character before them."""
    t = tables()
    cls = t.classes[cps].astype(np.int16)
    first = np.zeros(len(cps), bool)
    first[bounds[:-1][bounds[:-1] < len(cps)]] = True
    base = (cls == 0) | first
    run = np.cumsum(base)
    marks = np.flatnonzero(cls > 0)
    if len(marks):
        order = np.lexsort((marks, cls[marks], run[marks]))
        cps = cps.copy()
        cps[marks] = cps[marks[order]]
        cls[marks] = cls[marks[order]]
    bases = np.flatnonzero(base)
    owner = bases[run - 1]
    marks = marks[cls[owner[marks]] == 0]  # a text may begin with marks, which nothing owns
    alive = np.ones(len(cps), bool)
    out = cps.astype(np.int64)
    if len(marks):
        nth = marks - owner[marks]
        blocked = np.full(len(cps), -1, np.int16)
        by = np.argsort(nth, kind="stable")
        for group in np.split(marks[by], np.flatnonzero(np.diff(nth[by])) + 1):
            o = owner[group]
            made = t.compose(out[o], out[group])
            ok = (made > 0) & (blocked[o] < cls[group])
            out[o[ok]] = made[ok]
            alive[group[ok]] = False
            blocked[o[~ok]] = cls[group[~ok]]
    # characters of class 0 that compose with the one before: jamo and a few vowel signs. Those that follow
    # each other go one round after another; what absorbed a character takes its place.
    later = np.flatnonzero(t.second[cps] & (cls == 0) & ~first)
    if len(later):
        into = np.arange(len(cps))
        gone = marks[~alive[marks]] if len(marks) else marks
        into[gone] = owner[gone]
        starts = np.flatnonzero(np.diff(later, prepend=-2) != 1)
        nth = np.arange(len(later)) - np.repeat(starts, np.diff(starts, append=len(later)))
        by = np.argsort(nth, kind="stable")
        for group in np.split(later[by], np.flatnonzero(np.diff(nth[by])) + 1):
            j = into[group - 1]
            made = t.compose(out[j], out[group])
            ok = made > 0
            out[j[ok]], alive[group[ok]], into[group[ok]] = made[ok], False, j[ok]
    kept = np.concatenate([[0], np.cumsum(alive)])
    return out[alive].astype(np.uint32), kept[bounds]


def _strings(cps: np.ndarray, bounds: np.ndarray, nulls: pa.Array) -> pa.Array:
    width = 1 + (cps > 0x7F).astype(np.int64) + (cps > 0x7FF) + (cps > 0xFFFF)
    offsets = np.concatenate([[0], np.cumsum(width)])[bounds]
    data = cps.tobytes().decode("utf-32-le", "replace").encode()
    out = pa.LargeStringArray.from_buffers(len(bounds) - 1, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data))
    return pc.if_else(nulls, pa.scalar(None, pa.large_string()), out)


def canonical_column(column: pa.Array) -> pa.Array:
    cps, offsets = code_points(column)
    return _strings(*canonical(cps, offsets), column.is_null())


def _forms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for b in slices(whole, 1):
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.string()), canonical_column(b.column(1)).cast(pa.string())], names=["id", "text", "form"])


def consistent(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, text, form): each text in its consistent form."""
    ship(df)
    kind = df.schema[key].dataType.simpleString()
    return df.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(_forms, f"id {kind}, text string, form string").withColumnRenamed("id", key)


def _classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, form, raw) of every text with visible characters whose form has more than one spelling; form and raw are 128-bit hashes."""
    both = lambda c: F.struct(F.xxhash64(c).alias("h"), F.xxhash64(F.lit(1), c).alias("g"))
    docs = consistent(df, key, text).filter(F.col("form").rlike(r"\S")).select(F.col(key).alias("id"), both(F.col("form")).alias("form"), both(F.col("text")).alias("raw"))
    docs = cut(docs)
    # copies are combined to one row a spelling before spellings are counted
    varied = docs.groupBy("form", "raw").agg(F.lit(1).alias("one")).groupBy("form").agg(F.count("*").alias("n")).filter("n > 1").select("form")
    return docs.join(varied, "form", "left_semi")


def lookalike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, look, spelling): rows that have look-alikes, with the class of their look and that of their exact text.

    Two rows look the same if they share ``look``, and are equal if they share ``spelling``. The numbers
    are the least key of each class, so this is one row a row, however many copies there are.
    """
    members = _classes(df, key, text).filter(F.col("id").isNotNull())
    spellings = members.groupBy("form", "raw").agg(F.min("id").alias("spelling"))
    looks = spellings.groupBy("form").agg(F.min("spelling").alias("look"))
    return members.join(spellings, ["form", "raw"]).join(looks, "form").select(F.col("id").alias(key), "look", "spelling")


def lookalike_pairs(df: DataFrame, key: str, text: str, block: int = BLOCK) -> DataFrame:
    """(a, b), a < b: rows whose texts look the same yet are not equal.

    Texts are compared by 128-bit hashes of the consistent form and of the text. Spellings of a form are
    paired in blocks of at most about ``block`` rows each, and only then rows are attached, so that the
    pairs of a spelling with many copies are made by many tasks. ``lookalike_classes`` says the same in
    one row a text.
    """
    members = _classes(df, key, text)
    blocks = members.groupBy("form", "raw").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    placed = members.join(blocks, ["form", "raw"]).withColumn("i", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")).select("form", "raw", "i", "id")
    kinds = blocks.select("form", "raw", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"))
    side = lambda x: [F.col("raw").alias(f"r{x}"), F.col("i").alias(f"i{x}")]
    pairs = kinds.select("form", *side("a")).join(kinds.select("form", *side("b")), "form").filter("ra < rb")
    pair = ["form", "ra", "ia", "rb", "ib"]
    left = pairs.join(placed.select("form", *side("a"), F.col("id").alias("x")), ["form", "ra", "ia"]).select(*pair, "x")
    right = pairs.join(placed.select("form", *side("b"), F.col("id").alias("y")), ["form", "rb", "ib"]).select(*pair, "y")
    found = left.join(right, pair).filter("x <> y")
    return found.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()
