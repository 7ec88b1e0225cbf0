"""Garbled text from wrong character encoding.

For every pair (encoding that was meant, encoding that was used) the garbled sequences of an alphabet
are computed once and put into multi-pattern automata; only matched spans are replaced, all other text
stays as it is. Three families of pairs differ in what a match proves:

* UTF-8 read as a single-byte encoding: a match is replaced by itself; doubly garbled text is undone
  level by level;
* GB 18030 read as a single-byte encoding: two accented letters can be sound, so hanzi need two
  neighbouring matches, symbols and four-byte forms one;
* UTF-8 read as GB 18030: a match is the start of a span that is decoded as far as it is valid.

Further pairs come from the list ``encoding_pairs.PAIRS``. GBK read as Big5 gives one ordinary hanzi for each hanzi, so there the span is found by the likelihood
of the characters before and after, from the character counts of the distinct texts (at most one row a
code point). Replacement characters, and the traces they leave when they are read as GBK, are garbled
without a way back: such text is reported and left as it is around what can be restored.

Defined results
* null and empty texts are not garbled and stay as they are; texts may have any length;
* copies of a text have equal results and do not count as evidence, however often it is repeated;
* an empty table gives an empty result; row keys may be of any type and are not interpreted.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import ahocorasick
import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.llm.encoding_pairs import PAIRS, prior, reads, restore, uniform
from tributary.plans.ship import ship

SINGLE_BYTE = ("latin-1", "cp1252", "mac_roman")
LOST = "�"
MAX_LEVELS = 4
#: Characters that are evidence enough.
EVIDENCE = 10_000_000
#: A run behind a replacement character; a run that has traces of replacement characters read as GBK.
SURVIVOR = re.compile(f"{LOST}([^\\x00-\\x7f{LOST}]+)")
MARKED = re.compile("([^\\x00-\\x7f]*[锟拷][^\\x00-\\x7f]*)")


def single(raw: bytes, encoding: str) -> str:
    """Bytes read as a single-byte encoding; bytes that it leaves undefined become control characters."""
    return "".join(bytes([b]).decode(encoding, "ignore") or chr(b) for b in raw)


def gb_hanzi(first: int = 0xB0, last: int = 0xF7) -> str:
    rows = (bytes([a, b]).decode("gb2312", "ignore") for a in range(first, last + 1) for b in range(0xA1, 0xFF))
    return "".join(rows)


@lru_cache(1)
def alphabet() -> str:
    """What garbled text is expected to have been: by ranges of code points."""
    ranges = [(0x80, 0x180), (0x370, 0x400), (0x400, 0x460), (0x2010, 0x2045), (0x2070, 0x20B0), (0x2100, 0x2300), (0x2460, 0x2600), (0x3000, 0x3100), (0x3380, 0x33E0), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0xFF01, 0xFF66), (0xFFE0, 0xFFE7), (0xFFFD, 0xFFFE), (0x1F300, 0x1F700)]
    plain = "".join(chr(c) for a, b in ranges for c in range(a, b) if unicodedata.category(chr(c)) != "Cn")
    return plain + "".join(sorted({c for e in SINGLE_BYTE for c in single(bytes(range(0x80, 0x100)), e)} - set(plain)))


def _automaton(patterns: dict[str, tuple]) -> ahocorasick.Automaton:
    out = ahocorasick.Automaton()
    for k, v in patterns.items():
        out.add_word(k, (len(k), *v))
    out.make_automaton()
    return out


def _is_letter(c: str) -> bool:
    return c.isalpha() and c not in "ªº"


@lru_cache(2)
def utf8_as_single(encodings: tuple[str, ...] = SINGLE_BYTE[:2]) -> ahocorasick.Automaton:
    """garbled -> (length, original, whether the match alone is proof, weight in a run of matches)."""
    found: dict[str, tuple] = {}
    for encoding in encodings:
        for c in alphabet():
            g = single(c.encode(), encoding)
            if g in found or len(g) < 2:
                continue
            certain = len(g) > 2 or not (_is_letter(g[1]) or g[1] in "‘’“”–—…• ") or g[0] in "√¬ƒ≈"
            found[g] = (c, certain, 1)
    return _automaton(found)


@lru_cache(1)
def gb_as_single() -> ahocorasick.Automaton:
    found: dict[str, tuple] = {}
    for encoding in SINGLE_BYTE[:2]:
        for c in alphabet():
            try:
                raw = c.encode("gb18030")
            except UnicodeEncodeError:
                continue
            g = single(raw, encoding)
            if len(raw) < 2 or g.isascii():
                continue
            certain = len(raw) == 4 or (raw[0] in (0xA1, 0xA3, 0xA8) and not _is_letter(g[0]))
            found.setdefault(g, (c, certain, int(len(raw) == 2 and min(raw) >= 0xA1)))
    return _automaton(found)


#: What the first two bytes of typographic dashes and quotes in UTF-8 give: a character that stands for nothing else.
DASHES = "鈥"


@lru_cache(1)
def utf8_as_gb() -> ahocorasick.Automaton:
    """The first two characters that a character of three bytes gives, for each following lead byte."""
    chars = gb_hanzi() + "".join(c for c in alphabet() if 0x2010 <= ord(c) < 0x2045 or 0x3000 <= ord(c) < 0x3020 or ord(c) >= 0xFF01 and ord(c) < 0xFF66)
    nexts = [bytes([b]) for b in (0xE2, *range(0xE3, 0xEA), 0xEF)]
    found: dict[str, tuple] = {DASHES: ()}
    for c in chars:
        raw = c.encode()
        head = raw[:2].decode("gb18030", "ignore")
        if len(head) != 1:
            continue
        found[head + LOST] = ()
        for n in nexts:
            tail = (raw[2:] + n).decode("gb18030", "ignore")
            if len(tail) == 1:
                found[head + tail] = ()
    return _automaton(found)


@lru_cache(1)
def lost_as_gb() -> ahocorasick.Automaton:
    """Replacement characters in UTF-8, read as GBK: the lone first half, and the second half with what precedes it."""
    found: dict[str, tuple] = {"锟" + LOST: (True,)}
    for b in range(0x40, 0xFF):
        y = bytes([0xBD, b]).decode("gbk", "ignore")
        if len(y) == 1:
            found["锟" + y] = (True,)
    for a in range(0x81, 0xFF):
        x = bytes([a, 0xEF]).decode("gbk", "ignore")
        if len(x) == 1:
            found.setdefault(x + "拷", (x + "拷" == "斤拷",))
    return _automaton(found)


@lru_cache(1)
def gb_as_big5() -> tuple[np.ndarray, np.ndarray]:
    """For each code point: what it was if it is GB 2312 read as Big5 (0: nothing), and how common it is a priori."""
    back, prior = np.zeros(0x110000, np.uint32), np.zeros(0x110000, np.float32)
    for a in range(0xA1, 0xF8):
        for b in range(0xA1, 0xFF):
            c = bytes([a, b]).decode("gb2312", "ignore")
            if len(c) != 1:
                continue
            prior[ord(c)] = 3 if a < 0xD8 else 1
            for wrong in ("big5", "cp950"):
                g = bytes([a, b]).decode(wrong, "ignore")
                if len(g) == 1 and not back[ord(g)]:
                    back[ord(g)] = ord(c)
    return back, prior


GB_SET_FIRST = 0xA1


@lru_cache(1)
def _gb_set() -> frozenset[str]:
    return frozenset(gb_hanzi(GB_SET_FIRST))


def _latin(ch: str, before: str, after: str) -> bool:
    """Whether a two-byte character is believable between its neighbours in a restored span."""
    if 0xC0 <= ord(ch) < 0x180:
        return (before.isascii() and before.isalpha()) or (after.isascii() and after.isalpha())
    return ch in "°²³µμ×±·" and before.isascii() and before.isalnum()


def _decode_gb_span(text: str, start: int) -> tuple[int, str, int, int]:
    """(end, restored, characters restored, characters lost) of UTF-8 read as GB 18030 from ``start`` on.

    A replacement character stands for the byte 0x80 where a sound pair follows, and else for an
    unknown byte before an ASCII character; then the character it was part of is lost.
    """
    out: list[str] = []
    pending: list[int] = []
    need = good = lost = kept = kept_good = kept_lost = 0
    end = i = start
    while i < len(text):
        c = text[i]
        after = text[i + 1] if i + 1 < len(text) else ""
        if c == "\n" and need:
            break
        if c == LOST:
            raw = b"\x80" if after and after != LOST and ord(after) > 0x7F else b"\x00"
            if not need:
                break
        else:
            try:
                raw = c.encode("gb18030")
            except UnicodeEncodeError:
                break
        bad = False
        for b in raw:
            if need:
                if not 0x80 <= b < 0xC0 and c != LOST:
                    bad = True
                    break
                pending.append(b)
                need -= 1
                if need:
                    continue
                if 0 in pending:
                    out.append(LOST)
                    lost += 1
                else:
                    ch = bytes(pending).decode("utf-8", "ignore")
                    if not ch or (0x4E00 <= ord(ch) < 0xA000 and good < 2 and ch not in _gb_set()) or (len(pending) == 2 and not _latin(ch, out[-1] if out else "", after)):
                        bad = True
                        break
                    out.append(ch)
                    good += 1
                pending = []
            elif b < 0x80:
                out.append(chr(b))
            elif 0xC2 <= b < 0xF5:
                pending, need = [b], 1 if b < 0xE0 else 2 if b < 0xF0 else 3
            else:
                bad = True
                break
        if bad:
            break
        i += 1
        if not need and c != "\n" and not c.isascii():
            end, kept, kept_good, kept_lost = i, len(out), good, lost
    return end, "".join(out[:kept]), kept_good, kept_lost


class Repair:
    """Finds and restores garbled spans; ``counts`` are the occurrences of each code point in distinct texts.

    The counts of a corpus beyond ``EVIDENCE`` characters are scaled down to that many, so that a verdict
    does not depend on the size of the corpus.
    """

    def __init__(self, counts: dict[int, int] | None = None, pairs: tuple[tuple[str, str], ...] = PAIRS) -> None:
        self.back, self.prior = gb_as_big5()
        self.common, self.pairs, self.common_of_all = self.prior.copy(), pairs, prior().copy()
        scale = min(1.0, EVIDENCE / max(1, sum((counts or {}).values())))
        for c, n in (counts or {}).items():
            self.common[c] += np.log1p(n * scale)
            self.common_of_all[c] += 0.2 * np.log1p(n * scale) if self.common_of_all[c] else 0
        self.cache: dict[str, tuple[bool, str]] = {}

    def _single(self, text: str) -> str:
        """One level of text read as a single-byte encoding undone, by the family that explains more of it."""
        families = []
        for automaton in (utf8_as_single(), utf8_as_single(SINGLE_BYTE[2:])):
            utf8 = _hits(automaton, text)
            if any(h[3] or (h[0] and text[h[0] - 1].islower()) or text[h[1] : h[1] + 1].islower() for h in utf8):
                families.append(utf8)
        gb, runs = [], _hits(gb_as_single(), text)
        i = 0
        while i < len(runs):
            j = i + 1
            while j < len(runs) and runs[j][0] == runs[j - 1][1]:
                j += 1
            if sum(h[4] for h in runs[i:j]) > 1 or any(h[3] for h in runs[i:j]):
                gb += runs[i:j]
            i = j
        best = max([*families, gb], key=lambda hits: sum(h[1] - h[0] for h in hits))
        if best and best is gb:  # another pair of encodings may explain the same bytes better
            now, other = _replace(text, best), restore(text, self.common_of_all, self.pairs)
            return other if other != text and self._better(text, other, now) else now
        return _replace(text, best) if best else text

    def _gb(self, text: str) -> tuple[str, bool]:
        out, at, any_ = [], 0, False
        for e, v in utf8_as_gb().iter(text):
            start = e + 1 - v[0]
            if start < at:
                continue
            tries = [(start - k, *_decode_gb_span(text, start - k)) for k in (2, 1) if start - k >= at and text[start - k] > "\x7f"]
            tries = [t for t in tries if t[1] > start + 1 and t[3] >= 2] or [(start, *_decode_gb_span(text, start))]
            start, end, restored, good, lost = tries[0]
            if end <= start or not (good + lost >= 2 or text[start] == DASHES) or not (good or lost > 1):
                continue
            span = text[start:end]
            if self._mean(restored.replace(LOST, "")) <= self._mean(span.replace(LOST, "")) and text[start] != DASHES:
                continue
            out += [text[at:start], restored]
            at, any_ = end, True
        return "".join([*out, text[at:]]) if any_ else text, any_

    def _mean(self, s: str) -> float:
        cps = [ord(c) for c in s if ord(c) > 0x7F]
        return float(self.common[cps].mean()) if cps else 0.0

    def _big5(self, text: str) -> str:
        cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
        was = self.back[cps]
        mapped = was > 0
        if mapped.sum() < 2:
            return text
        wide = cps > 0x7F
        score = np.where(mapped, self.common[was] - self.common[cps], np.where(wide & (cps != 0xFFFD), -6.0, 0.0))
        if score.max() <= 0 or np.sort(score)[-2:].sum() < BIG5_SUM:
            return text
        spans, lo, total, best, best_at = [], 0, 0.0, 0.0, 0
        for i, s in enumerate(score.tolist()):
            if total <= 0:
                if best >= BIG5_SUM:
                    spans.append((lo, best_at))
                lo, total, best, best_at = i, 0.0, 0.0, i
            total += s
            if total > best:
                best, best_at = total, i + 1
            elif total < best - 18:
                if best >= BIG5_SUM:
                    spans.append((lo, best_at))
                lo, total, best, best_at = i + 1, 0.0, 0.0, i + 1
        if best >= BIG5_SUM:
            spans.append((lo, best_at))
        new = cps.copy()
        done = False
        for lo, hi in spans:
            m = mapped[lo:hi]
            whole = (mapped | ~wide | (cps == 0xFFFD)).all() and m.sum() == mapped.sum()
            gain = score[lo:hi]
            strange = (m & (self.prior[cps[lo:hi]] == 0) & (gain > BIG5_STRANGE)).any()  # far rarer than what it would have been
            enough = whole and m.sum() > 1 or m.sum() >= BIG5_RUN and gain.sum() >= BIG5_RUN_SUM or strange and gain.sum() >= BIG5_STRANGE_SUM
            if gain[m].mean() < BIG5_MEAN or not enough:
                continue
            a, b = lo, hi
            while a and mapped[a - 1]:
                a -= 1
            while b < len(cps) and mapped[b]:
                b += 1
            if (a == 0 or not wide[a - 1]) and (b == len(cps) or not wide[b]):
                lo, hi, m = a, b, mapped[a:b]  # nothing sound adjoins: the run as a whole
            new[lo:hi] = np.where(m, was[lo:hi], cps[lo:hi])
            done = True
        return new.tobytes().decode("utf-32-le", "replace") if done else text

    def __call__(self, text: str | None) -> tuple[bool, str | None]:
        if not text or text.isascii():
            return False, text
        if len(text) > 200:
            return self._judge(text)
        if text not in self.cache:
            if len(self.cache) > 50_000:
                self.cache.clear()
            self.cache[text] = self._judge(text)
        return self.cache[text]

    def _better(self, text: str, a: str, b: str) -> bool:
        """Whether the changed part of ``a`` reads better than that of ``b``."""
        start = len(commonprefix([text, a, b]))
        end = min(len(commonprefix([text[start:][::-1], x[start:][::-1]])) for x in (a, b))
        a, b = a[start : len(a) - end], b[start : len(b) - end]
        return reads(a, self.common_of_all) > reads(b, self.common_of_all) + (0.2 if uniform(a) else 1.0)

    def _survived(self, text: str) -> str:
        """GB 18030 read as UTF-8: hanzi whose two bytes survived behind a replacement character.

        A run counts if it has a character of two bytes and gives common hanzi only. Its bytes pair up by the
        number of bytes before it, or by its end where no replacement character follows. A replacement character may
        stand for several bytes, so the other way is tried where the first gives no common hanzi.
        """

        def fix(m: re.Match) -> str:
            run = m[1]
            last = max((i for i, c in enumerate(run) if "\x80" <= c < "\u0800"), default=-1)
            if last < 0:
                return m[0]
            upto = len(run) if len(run) - last <= 3 else last + 1
            raw, begin = run[:upto].encode("utf-8", "ignore"), m.start()
            while begin and not text[begin - 1].isascii():
                begin -= 1
            begin = text.index(LOST, begin)
            at = len(text[begin : m.start(1)].replace(LOST, "?").encode("utf-8", "ignore")) % 2
            if upto == len(run) and text[m.end() : m.end() + 1] != LOST:
                at = len(raw) % 2
            for shift in (at, 1 - at):
                pairs = [raw[k : k + 2].decode("gb2312", "ignore") for k in range(shift, len(raw) - 1, 2)]
                half = (len(raw) - shift) % 2
                if not pairs or half and (upto < len(run) or text[m.end() : m.end() + 1] != LOST):
                    break
                got = "".join(pairs)
                if all(len(c) == 1 and self.prior[ord(c)] == 3 for c in pairs) and self._mean(got) > self._mean(run[: last + 1]):
                    return LOST + got + LOST * half + run[upto:]
            return m[0]

        return SURVIVOR.sub(fix, text)

    def _marked(self, run: str) -> str:
        """A run with traces of replacement characters read as GBK: undone if that restores characters."""
        if LOST in run:
            return run  # how many bytes are gone is not known
        undone = run.encode("gb18030", "ignore").decode("utf-8", "replace")
        now = self._survived(undone)
        return now if now != undone else run

    def _judge(self, text: str) -> tuple[bool, str]:
        garbled = LOST in text
        marks = [v[1] for _, v in lost_as_gb().iter(text)] if "锟" in text or "拷" in text else []
        garbled |= any(marks) or len(marks) > 1
        now = text
        for _ in range(MAX_LEVELS):
            before = now
            now = self._single(now)
            if now == before:
                break
        lost = any(marks) or len(marks) > 1
        parts = MARKED.split(now) if lost else [now]
        for i in range(0, len(parts), 2):
            parts[i], changed = self._gb(parts[i])
            garbled |= changed
            former = parts[i]
            parts[i] = self._big5(former)
            if not changed and parts[i] == former and former == text and not former.isascii():
                parts[i] = restore(former, self.common_of_all, self.pairs)
        parts[1::2] = map(self._marked, parts[1::2])
        now = "".join(parts)
        if LOST in text:
            now = self._survived(now)
        return garbled or now != text, now


#: Least likelihood gain of a whole text and per character; least length and gain of a passage.
BIG5_SUM, BIG5_MEAN, BIG5_RUN, BIG5_RUN_SUM = 7.0, 1.5, 4, 18.0
#: A character outside GB 2312 with this gain is strange; a passage that has one may be shorter.
BIG5_STRANGE, BIG5_STRANGE_SUM = 8.0, 14.0


def _hits(automaton: ahocorasick.Automaton, text: str) -> list[tuple]:
    """(start, end, original, certain, weight) of the leftmost longest matches."""
    return [(e + 1 - v[0], e + 1, *v[1:]) for e, v in automaton.iter_long(text)]


def _replace(text: str, hits: list[tuple]) -> str:
    out, at = [], 0
    for lo, hi, c, *_ in hits:
        out += [text[at:lo], c]
        at = hi
    return "".join([*out, text[at:]])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(0x110000, np.int64)
    for b in batches:
        for t in b.column(0).to_pylist():
            if t:
                cps = np.frombuffer(t.encode("utf-32-le", "replace"), np.uint32)
                c, n = np.unique(cps, return_counts=True)
                total[c] += n
    at = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["cp", "n"])


def character_counts(texts: DataFrame, text: str = "text") -> dict[int, int]:
    """Occurrences of each code point in the distinct texts: at most 1,114,112 rows, whatever the data.

    Each text counts once, so that copies of a garbled one do not make its wrong characters look common.
    """
    ship(texts)
    rows = texts.select(text).distinct().mapInArrow(_count, "cp int, n long").groupBy("cp").agg(F.sum("n").alias("n")).collect()
    return {r.cp: r.n for r in rows}


def repair(df: DataFrame, text: str | Column = "text", counts: dict[int, int] | None = None, pairs: tuple[tuple[str, str], ...] = PAIRS) -> DataFrame:
    """``df`` with ``garbled`` and ``restored`` for the column ``text``; columns of these names are replaced."""
    ship(df)
    df = df.drop("garbled", "restored", "__fix")
    shared = df.sparkSession.sparkContext.broadcast(counts or {})

    @F.pandas_udf("garbled boolean, restored string")
    def fix(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        repairer = Repair(shared.value, pairs)
        for s in batches:
            done = [repairer(t) for t in s]
            yield pd.DataFrame({"garbled": [d[0] for d in done], "restored": pd.Series([d[1] for d in done], dtype=object)})

    return df.withColumn("__fix", fix(F.col(text) if isinstance(text, str) else text)).select("*", "__fix.garbled", "__fix.restored").drop("__fix")
