import itertools
import random
from collections import Counter

import pytest

from tributary.llm.container_fill import assign, best_fit, byte_tokens, container_report, pack, reduce_by_dominance


def optimum(sizes, cap):
    best = len(sizes)

    def go(rest, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if not rest:
            best = len(bins)
            return
        s, seen = rest[0], set()
        for i, b in enumerate(bins):
            if b + s <= cap and b not in seen:
                seen.add(b)
                bins[i] += s
                go(rest[1:], bins)
                bins[i] -= s
        go(rest[1:], [*bins, s])

    go(sorted(sizes, reverse=True), [])
    return best


def held(patterns):
    c = Counter()
    for p in patterns:
        for s, n in p.content:
            c[s] += n * p.times
    return c


@pytest.mark.parametrize("seed", range(150))
def test_reduction_keeps_an_optimum(seed):
    r = random.Random(seed)
    cap = r.choice([10, 17, 30])
    sizes = [r.randint(1, cap) for _ in range(r.randint(1, 9))]
    fixed, rest = reduce_by_dominance(Counter(sizes), cap)
    assert held(fixed) + Counter(rest) == Counter(sizes)
    left = list(Counter(rest).elements())
    assert sum(p.times for p in fixed) + (optimum(left, cap) if left else 0) == optimum(sizes, cap)


@pytest.mark.parametrize("seed", range(30))
def test_pack_holds_everything_once(seed):
    r = random.Random(seed)
    counts = Counter(r.choices(range(1, 101), k=r.randint(0, 5000)))
    p = pack(counts, 100)
    assert held(p) == counts and all(sum(s * n for s, n in x.content) <= 100 for x in p)
    lower = -(-sum(s * n for s, n in counts.items()) // 100)
    assert sum(x.times for x in p) <= max(lower * 1.23 + 1, sum(x.times for x in best_fit(counts, 100)) * 1.05 + 1)


def test_assign(spark):
    r = random.Random(1)
    rows = [(i, r.choice([0, 3, 7, 10, 250, 251, 99, 100])) for i in range(700)] + [(0, 7), (None, 5), (1, None)]
    df = spark.createDataFrame(rows, "id long, tokens long")
    out = assign(df, 100, rows_a_bucket=60).collect()
    per = Counter()
    for x in out:
        per[x.container] += x.tokens
    assert max(per.values()) <= 100 and set(per) == set(range(len(per)))
    assert Counter((x.id, x.pieces) for x in out if x.piece_no == 0) == Counter((i, -(-t // 100)) for i, t in rows if t)
    assert sum(per.values()) == sum(t for _, t in rows if t)
    report = container_report(assign(df, 100, rows_a_bucket=60), 100).first()
    assert report.containers == len(per) and report.filled > 0.9
    assert assign(df.limit(0), 100).count() == 0


def test_tokens(spark):
    df = spark.createDataFrame([("",), (None,), ("中a",)], "t string")
    assert [x[0] for x in df.select(byte_tokens(df.t)).collect()] == [1, None, 5]


def test_small_exhaustive():
    for sizes in itertools.combinations_with_replacement(range(1, 8), 5):
        fixed, rest = reduce_by_dominance(Counter(sizes), 7)
        left = list(Counter(rest).elements())
        assert sum(p.times for p in fixed) + (optimum(left, 7) if left else 0) == optimum(list(sizes), 7)
