import random
import unicodedata

import pyarrow as pa
import pytest

from tributary.llm.visual_form import LOOKALIKES, _expand, canonical_column, lookalike_classes, lookalike_pairs


def brute(t):
    return unicodedata.normalize("NFC", "".join(map(_expand, map(ord, t))))


ALPHABET = "aeoñȩ́́̈̃̇̀ еоАВ中⼈率Ａ１，　​­﻿ ㎏㎜℃°Cﬁ²①Ⅱμµ\n\r\tｶﾞ각각😀ΩΩ"


@pytest.mark.parametrize("seed", range(20))
def test_equals_per_character_rule(seed):
    r = random.Random(seed)
    texts = ["".join(r.choices(ALPHABET, k=r.randint(0, 60))) for _ in range(40)] + [None, "", "́a"]
    got = canonical_column(pa.array(texts)).to_pylist()
    assert got == [None if t is None else brute(t) for t in texts]
    assert canonical_column(pa.array(texts).slice(5, 9)).to_pylist() == got[5:14]


SAME = [("m２", "m2"), ("café", "café"), ("a​b", "ab"), ("a b　c", "a b c"), ("раo", "pao"), ("⼈工", "人工"), ("5㎏", "5kg"), ("ﬁx", "fix"), ("37℃", "37°C"), ("µm", "μm"), ("ｶﾞ", "ガ"), ("a‑b", "a-b")]
DIFFERENT = [("m²", "m2"), ("cafe", "café"), ("A", "a"), ("a\nb", "a b"), ("①", "1"), ("10", "1O"), ("a b", "ab")]


@pytest.mark.parametrize("a,b", SAME)
def test_same(a, b):
    x, y = canonical_column(pa.array([a, b])).to_pylist()
    assert x == y


@pytest.mark.parametrize("a,b", DIFFERENT)
def test_different(a, b):
    x, y = canonical_column(pa.array([a, b])).to_pylist()
    assert x != y


def test_pairs(spark):
    rows = [(1, "ａb"), (2, "ab"), (3, "ab"), (4, "AB"), (5, None), (6, ""), (7, "​"), (8, " "), (9, "x" * 100_000), (10, "x" * 99_999 + "ｘ"), (None, "ab")]
    df = spark.createDataFrame([(k, t, "clash") for k, t in rows], "doc_id long, text string, form string")
    got = {(r.a, r.b) for r in lookalike_pairs(df, "doc_id", "text").collect()}
    assert got == {(1, 2), (1, 3), (9, 10)}
    assert lookalike_pairs(df.limit(0), "doc_id", "text").count() == 0


def test_long_run_of_marks():
    t = "a" + "̣́" * 5000
    assert canonical_column(pa.array([t])).to_pylist() == [brute(t)]


def test_jamo_and_vowel_signs_in_rounds():
    r = random.Random(9)
    for alphabet in ("각가ᄀ각ᅡᆨ", "각ᅡᆨ́a", "কেোোৗ"):
        texts = ["".join(r.choices(alphabet, k=r.randint(1, 30))) for _ in range(200)]
        assert canonical_column(pa.array(texts)).to_pylist() == [brute(t) for t in texts]


def test_scripts_that_look_alike():
    assert all(len(a) == len(b) for a, b in LOOKALIKES.items())
    same = [("\U0001d400\U0001d7d7", "A9"), ("ᎪᏢᏢ", "APP"), ("ՍՏ", "US"), ("ΡΑΥ", "PAY")]
    assert all(len(set(canonical_column(pa.array(p)).to_pylist())) == 1 for p in same)


def test_classes_and_blocks(spark):
    r = random.Random(2)
    rows = [(i, r.choice(["ab", "ａb", "aｂ", "cd", "x y", "x　y", " ", None])) for i in range(120)] + [(200, "cd"), (3, "ab")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {(min(a, b), max(a, b)) for a, s in rows for b, t in rows if a != b and s and t and s.strip() and s != t and brute(s) == brute(t)}
    assert {(x.a, x.b) for x in lookalike_pairs(df, "doc_id", "text", block=7).collect()} == want
    got = lookalike_classes(df, "doc_id", "text").collect()
    assert {(min(p.doc_id, q.doc_id), max(p.doc_id, q.doc_id)) for p in got for q in got if p.look == q.look and p.spelling != q.spelling and p.doc_id != q.doc_id} == want
    assert lookalike_classes(df.limit(0), "doc_id", "text").count() == 0
