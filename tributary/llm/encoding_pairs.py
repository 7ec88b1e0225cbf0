"""Pairs of encodings beyond the three families of ``encoding_repair``, from a parameter list.

For each pair (meant, used) the garbled sequences that only this mistake gives are computed once and put
into one automaton for all pairs. A match proposes a place and a pair; there the text is turned back
into bytes and decoded as far as it is valid, and the result replaces the span if it reads better: its
characters must be common ones of a script, and clearly commoner than those of the span.

Pairs that give one ordinary letter for each letter (a Cyrillic encoding read as another, or as a Latin
one) are told by what no text has: a row of accented letters, or words whose case is inverted.
"""

from __future__ import annotations

import re
from functools import lru_cache

import ahocorasick
import numpy as np

#: (meant, used): the mistakes that are looked for.
PAIRS = (
    *(("utf-8", used) for used in ("cp1250", "cp1251", "cp437", "koi8-r", "shift_jis", "big5", "euc-kr")),
    *((meant, used) for meant in ("shift_jis", "big5", "euc-kr") for used in ("latin-1", "cp1252", "mac_roman")),
    ("gb18030", "mac_roman"), ("shift_jis", "gb18030"), ("big5", "gb18030"), ("cp1251", "latin-1"), ("cp1251", "cp1252"), ("koi8-r", "cp1251"), ("cp1251", "koi8-r"),
)
MULTI = ("utf-8", "shift_jis", "big5", "euc-kr", "gb18030")
#: Least gain in commonness per character, and least characters restored.
GAIN, LEAST = 1.0, 2
#: Text is turned back in pieces of this length; what follows a piece is looked at again.
REACH = 4096
GLANCE = 40
_NEIGHBOURS = re.compile("[^\\x00-\\x7f]{2}")

_KANA = "".join(map(chr, [*range(0x3041, 0x3094), *range(0x30A1, 0x30F7), 0x30FC]))
_CYRILLIC = "".join(map(chr, [*range(0x410, 0x450), 0x401, 0x451]))
#: The commonest letters of Russian.
_OFTEN = "оеаинтсрвлкмдпу"
_LATIN = "".join(chr(c) for c in range(0xC0, 0x180) if chr(c).isalpha())


def _rows(encoding: str, first: int, last: int, trails: tuple[range, ...]) -> str:
    read = (bytes([a, b]).decode(encoding, "ignore") for a in range(first, last + 1) for t in trails for b in t)
    return "".join(c for c in read if len(c) == 1 and not c.isascii())


@lru_cache(1)
def prior() -> np.ndarray:
    """How common each code point is a priori: the first level of each national set, kana, Cyrillic."""
    out = np.zeros(0x110000, np.float32)
    hi, lo = range(0xA1, 0xFF), range(0x40, 0x7F)
    for value, chars in (
        (1.0, _rows("gb2312", 0xD8, 0xF7, (hi,))), (1.5, _LATIN), (2.0, _rows("big5", 0xA4, 0xC6, (lo, hi))), (2.5, _rows("euc-kr", 0xB0, 0xC8, (hi,))), (2.0, _rows("shift_jis", 0x88, 0x98, (lo, range(0x80, 0xFD)))),
        (3.0, _rows("gb2312", 0xB0, 0xD7, (hi,))), (3.0, _KANA), (2.2, _CYRILLIC), (2.7, _OFTEN), (2.0, "，。、；：？！（）《》“”‘’—…「」"),
    ):
        out[[ord(c) for c in chars]] = value
    return out


def _alphabet(meant: str) -> str:
    if meant in ("cp1251", "koi8-r"):
        return _CYRILLIC
    hi, lo = range(0xA1, 0xFF), range(0x40, 0x7F)
    if meant == "shift_jis":
        return _KANA + _rows("shift_jis", 0x88, 0x98, (lo, range(0x80, 0xFD)))
    if meant == "big5":
        return _rows("big5", 0xA4, 0xC6, (lo, hi))
    if meant == "euc-kr":
        return _rows("euc-kr", 0xB0, 0xC8, (hi,))
    hanzi = _rows("gb2312", 0xB0, 0xF7, (hi,))
    if meant == "gb18030":
        return hanzi
    return hanzi + _KANA + _CYRILLIC + _LATIN + _rows("euc-kr", 0xB0, 0xC8, (hi,)) + _rows("shift_jis", 0x88, 0x98, (lo, range(0x80, 0xFD)))


@lru_cache(64)
def _byte_chars(used: str) -> tuple[str, ...]:
    """What each byte is read as; bytes that the encoding leaves undefined become control characters."""
    return tuple(bytes([b]).decode(used, "ignore") or chr(b) for b in range(256))


@lru_cache(64)
def _char_bytes(used: str) -> dict[str, int]:
    return {c: b for b, c in reversed(list(enumerate(_byte_chars(used))))}


def read_as(raw: bytes, used: str) -> str:
    if used in MULTI:
        return raw.decode(used, "replace")
    table = _byte_chars(used)
    return "".join(table[b] for b in raw)


def _sequences(meant: str, used: str) -> set[str]:
    """Garbled sequences that start a span of this pair; each is proof of nothing more than the place."""
    chars = _alphabet(meant)
    if meant == "shift_jis" and used == "gb18030":
        kana = [c.encode(meant) for c in _KANA]
        return {g for a in kana for b in kana if len(g := read_as(a + b, used)) == 2}
    if meant == "big5" and used == "gb18030":
        sound = set(_rows("gb2312", 0xA1, 0xF7, (range(0xA1, 0xFF),)))
        return {g for c in chars if len(g := read_as(c.encode(meant), used)) == 1 and g not in sound and 0x4E00 <= ord(g) < 0xA000}
    if meant in ("cp1251", "koi8-r"):
        pairs = [(a, b) for a in chars for b in chars if meant != "koi8-r" and used not in MULTI and used != "koi8-r" or a.isupper() and b.islower()]
        return {read_as((a + b).encode(meant), used) for a, b in pairs}
    if meant == "utf-8" and used not in MULTI:  # the first two bytes say enough, the rest is decoded
        return {read_as(c.encode()[:2], used) for c in chars}
    if used in MULTI:  # two bytes of one character, and the third with the first of the next
        out, leads = set(), [bytes([b]) for b in (*range(0xE3, 0xEA), 0xEF, 0x20)]
        for c in chars:
            raw = c.encode(meant)
            if len(raw) == 2:
                out |= {g for g in [raw.decode(used, "ignore")] if len(g) == 2}
            else:
                out |= {g for n in leads if 2 <= len(g := raw.decode(used, "ignore") if n < b"\x80" else (raw + n).decode(used, "ignore")) <= 4 and not g.isascii()}
        return {g for g in out if not g[0].isascii()}
    return {g for c in chars if len(g := read_as(c.encode(meant), used)) > 1 and not g[0].isascii()}


@lru_cache(4)
def automaton(pairs: tuple[tuple[str, str], ...] = PAIRS) -> tuple[ahocorasick.Automaton, np.ndarray, np.ndarray, int]:
    """garbled -> (length, numbers of the pairs that give it); which code points are first, second (or alone) in one; the longest."""
    found: dict[str, tuple[int, ...]] = {}
    for k, pair in enumerate(pairs):
        for g in _sequences(*pair):
            found[g] = (*found.get(g, ()), k)
    out = ahocorasick.Automaton()
    for g, ks in found.items():
        out.add_word(g, (len(g), ks))
    out.make_automaton()
    first, second = np.zeros(0x110000, bool), np.zeros(0x110000, bool)
    first[[ord(g[0]) for g in found]] = True
    second[[ord(g[1]) for g in found if len(g) > 1]] = True
    alone = np.zeros(0x110000, bool)
    alone[[ord(g) for g in found if len(g) == 1]] = True
    return out, first, np.stack([second, alone]), max(map(len, found), default=1)


def _windows(text: str, first: np.ndarray, second: np.ndarray, longest: int) -> list[tuple[int, int]]:
    """The parts of a text where a sequence can begin, told by whole-array lookups before the automaton runs."""
    cps = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    begins = first[cps]
    begins[:-1] &= second[0][cps[1:]] | second[1][cps[:-1]]
    begins[-1:] &= second[1][cps[-1:]]
    at = np.flatnonzero(begins)
    if not len(at):
        return []
    breaks = np.flatnonzero(np.diff(at) > longest)
    starts, ends = at[np.concatenate([[0], breaks + 1])], at[np.concatenate([breaks, [len(at) - 1]])] + longest
    return list(zip(starts.tolist(), np.minimum(ends, len(cps)).tolist(), strict=True))


def _to_bytes(seg: str, used: str) -> tuple[bytes, str]:
    """The bytes that a text was read from, as far as there are any, and the part of the text they are."""
    try:
        return seg.encode(used), seg
    except UnicodeEncodeError as e:
        if used in MULTI or seg[e.start] not in _char_bytes(used):
            return seg[: e.start].encode(used), seg[: e.start]
    table, raw = _char_bytes(used), bytearray()
    for c in seg:
        if c not in table:
            break
        raw.append(table[c])
    return bytes(raw), seg[: len(raw)]


def undo(text: str, start: int, meant: str, used: str, reach: int = REACH) -> tuple[int, str]:
    """(end, restored) of what is valid from ``start`` on, up to the last restored character that is not ASCII."""
    line = text.find("\n", start, start + reach)
    raw, seg = _to_bytes(text[start : line if line >= 0 else start + reach], used)
    try:
        got = raw.decode(meant)
    except UnicodeDecodeError as e:
        got = raw[: e.start].decode(meant)
    got = got[: next((i for i in range(len(got), 0, -1) if got[i - 1] > "\x7f"), 0)]
    if not got:
        return start, ""
    size = len(got.encode(meant))
    if used not in MULTI:
        return start + size, got
    held = 0
    for i, c in enumerate(seg):  # the last character may also hold a byte of what did not decode
        held += len(c.encode(used))
        if held >= size:
            return start + i + 1, got
    return start + len(seg), got


def reads(s: str, common: np.ndarray) -> float:
    """Mean commonness of what is not ASCII; rows of accented letters and inverted case are no writing."""
    wide = [c for c in s if ord(c) > 0x7F]
    if not wide:
        return 0.0
    score = common[[ord(c) for c in wide]]
    if sum(not (c.isalnum() or common[ord(c)]) for c in wide) * 3 > len(wide):
        score = score - 1.5
    if len(wide) > 2 and all(0xAC00 <= ord(c) < 0xD7A4 for c in wide):
        score = score + 0.5  # bytes of another set would give other signs between
    latin = sum(0xC0 <= ord(c) < 0x250 for c in wide)
    if latin > 2 and latin * 2 > len(s):
        score = score - 3
    elif sum(0x400 <= ord(c) < 0x460 for c in wide) * 2 > len(s) and any(a.islower() and b.isupper() for a, b in zip(s, s[1:], strict=False)):
        score = score - 2
    return float(score.mean())


def uniform(s: str) -> bool:
    """Whether what is not ASCII is of one script: hangul, Cyrillic, or Japanese with kana."""
    wide = [ord(c) for c in s if ord(c) > 0x7F and c.isalpha()]
    kana = sum(0x3041 <= c < 0x3100 for c in wide)
    return bool(wide) and (all(0xAC00 <= c < 0xD7A4 for c in wide) or all(0x400 <= c < 0x460 for c in wide) or kana * 4 > len(wide) and all(c >= 0x3041 for c in wide))


def restore(text: str, common: np.ndarray, pairs: tuple[tuple[str, str], ...] = PAIRS) -> str:
    """``text`` with every span undone that one of the pairs explains."""
    out, at = [], 0
    known, first, second, longest = automaton(pairs)
    for e, (n, ks) in (hit for a, b in _windows(text, first, second, longest) for hit in known.iter(text, a, b)):
        lo = e + 1 - n
        if lo < at:
            continue
        best = None
        for k in ks:
            meant, used = pairs[k]
            for start in range(lo, max(at, lo - 2 if used in MULTI else lo) - 1, -1):
                if text[start].isascii():
                    break
                # what does not even begin well is given up at once, so that a wrong pair costs no more than a look
                for far in (GLANCE, REACH):
                    end, got = undo(text, start, meant, used, far)
                    wide = [ord(c) for c in got if c > "\x7f"]
                    # UTF-8 hardly ever decodes by accident; two bytes of the others do, so these need neighbours
                    if len(wide) < LEAST or end <= e or meant != "utf-8" and not _NEIGHBOURS.search(got) or not common[wide].all():
                        break
                    gain = reads(got, common) - reads(text[start:end], common)
                    if gain < GAIN:
                        break
                else:
                    if best is None or (len(wide), gain) > best[0]:
                        best = (len(wide), gain), start, end, got
        if best:
            _, start, end, got = best
            out += [text[at:start], got]
            at = end
    return "".join([*out, text[at:]]) if out else text
