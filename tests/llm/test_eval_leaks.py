import random

import numpy as np
import pytest

from tributary.llm.eval_leaks import Items, budget, leaks, myers, normal


def distance(p, t):
    row = [0] * (len(t) + 1)
    for i, a in enumerate(p, 1):
        prev, row[0] = row[0], i
        for j, b in enumerate(t, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (a != b))
    return min(row)


@pytest.mark.parametrize("seed", range(40))
def test_myers(seed):
    r = random.Random(seed)
    p, t = ("".join(r.choices("abc", k=r.randint(1, n))) for n in (90, 120))
    assert myers(p, t) == distance(p, t)


def brute(p, d, least):
    covered = [False] * len(p)
    for i in range(len(p) - least + 1):
        if p[i : i + least] in d:
            covered[i : i + least] = [True] * least
    return sum(covered) / len(p) if p else 0


def test_normal():
    assert normal("ＡＢ c，é　1​2\n½ﬁ中") == "abce1212fi中"


@pytest.mark.parametrize("seed", range(6))
def test_equals_brute_force(spark, seed):
    r = random.Random(seed)
    han = "采购部与质量管理对单位能耗的口径不同差额已列入清单项目经理发现物料主数据里有处空值"
    word = lambda n: "".join(r.choices(han if n % 2 else "abcdefgh 12", k=n))
    items = [(i, r.choice(["zh", "en", None]), word(r.choice([24, 60, 201, 300]))) for i in range(12)] + [(90, "zh", None), (91, "zh", "")]
    docs = [(0, None), (1, ""), (None, "无关")]
    for i in range(2, 80):
        _, _, p = r.choice(items[:12])
        cut, size = r.randint(0, len(p)), r.randint(0, len(p))
        parts = [p[cut : cut + size], p[: r.randint(0, 50)], p[-r.randint(1, 60) :]]
        text = word(9).join(parts).upper() if i % 3 else "，".join(x + "\n" for x in parts)
        docs.append((i, word(r.randint(0, 80)) + text + word(30)))
    want = {(d, i) for d, t in docs if t for i, lang, p in items if p and brute(normal(p), normal(t), 25 if lang == "zh" else 40) >= 0.4}
    df, it = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, lang string, passage string")
    got = [(x.doc_id, x.item_id) for x in leaks(df, it, pieces_a_block=60).collect()]
    assert len(got) == len(set(got)) and set(got) == want and want


def test_empty(spark):
    df, it = spark.createDataFrame([(1, "x" * 100, "c")], "doc_id long, text string, share string"), spark.createDataFrame([(1, "en", "x" * 100)], "item_id long, lang string, passage string")
    assert leaks(df, it).count() == 1
    assert leaks(df.limit(0), it).count() == 0
    assert leaks(df, it.limit(0)).count() == 0
    assert not Items([]).ids


@pytest.mark.parametrize("n,least", [(24, 25), (25, 25), (60, 25), (100, 25), (300, 25), (400, 40)])
def test_budget_is_the_most_edits_that_prove_a_leak(n, least):
    k = budget(n, least)
    proven = lambda e: n - e - (e + 1) * (least - 1) >= 0.4 * n
    assert (k < 0 or proven(k)) and not proven(k + 1)


def test_myers_decides_within_the_budget(monkeypatch):
    r = random.Random(5)
    p = "".join(r.choices("甲乙丙丁戊己庚辛壬癸子丑寅卯", k=300))
    items = Items([(1, "zh", p)])
    k = items.budget[0]
    assert k >= 5 and len(p) // items.piece[0] > k
    at = sorted(r.sample(range(300), k))
    typed = "".join("#" if i in at else c for i, c in enumerate(p)).replace("#", "换")

    def hits(doc):
        return [(e + 1 - n, where) for e, (n, where) in items.automaton.iter(doc)]

    monkeypatch.setattr(Items, "measured", lambda *a: 0.0)
    codes = lambda t: np.frombuffer(t.encode("utf-32-le"), np.uint32)
    assert [x[:1] + x[2:3] for x in items.leaks(codes("前文" + typed), hits("前文" + typed))] == [(1, k)]
    assert not list(items.leaks(codes(p[:150]), hits(p[:150])))


def test_bound_loses_no_copy_within_the_budget():
    r = random.Random(6)
    for _ in range(200):
        p = "".join(r.choices("abcdefghijklmnop", k=r.randint(25, 400)))
        items = Items([(1, "zh", p)])
        if items.budget[0] < 0:
            continue
        typed = list(p)
        for i in r.sample(range(len(p)), items.budget[0]):
            typed[i] = "z"
        typed = "".join(typed)
        hits = [(e + 1 - n, where) for e, (n, where) in items.automaton.iter(typed)]
        assert [x[0] for x in items.leaks(np.frombuffer(typed.encode("utf-32-le"), np.uint32), hits)] == [1]
