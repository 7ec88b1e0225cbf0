import random
import re

import pytest

from tributary.llm.boundary_split import BLOCK, NAMES, code_points, pieces, reassembled, split, split_report, strengths


def brute(text, limit, overlap):
    s, out, start = strengths(code_points(text)), [], 0
    while len(text) - start > limit:
        at = [i for i in range(max(start + overlap, start + limit // 2 - 1), start + limit) if s[i]]
        best = max(at, key=lambda i: (s[i], i), default=None)
        early = [i for i in range(start + overlap, start + limit) if s[i]]
        if best is None and early:
            reach = early[-1] + 1 - overlap + limit
            if any(s[i] for i in range(start + limit, min(reach, len(text)))) or len(text) <= reach:
                best = early[-1]
        end = start + limit if best is None else best + 1
        out.append((start, end, NAMES[0 if best is None else s[best]]))
        start = end - overlap
    return [*out, (start, len(text), "end")] if text else []


def longest(text):
    return max((len(x) for x in re.split("[\n\r\t 。！？；，、.!?;,]", text)), default=0)


@pytest.mark.parametrize("seed", range(30))
def test_equals_brute_force(seed):
    r = random.Random(seed)
    text = "".join(r.choices("字a。，.\n# \r😀", [30, 30, 1, 1, 1, 1, 1, 2, 1, 1], k=r.randint(0, 900)))
    assert pieces(text, 60, 7)[0] == brute(text, 60, 7)


@pytest.mark.parametrize("text", ["", "a" * 4000, "a" * 4001, "字。" * 5000, "x" * 9000 + "\n" + "y" * 50, "\n" * 9000, "😀 " * 4000])
def test_limit_overlap_and_cover(text):
    parts, unbroken = pieces(text)
    assert all(e - s <= 4000 for s, e, _ in parts)
    assert all(b[0] == a[1] - 200 for a, b in zip(parts, parts[1:]))
    assert (parts[0][0], parts[-1][1]) == (0, len(text)) if text else parts == []
    assert unbroken == (longest(text) > 4000)


def test_blocks_do_not_show():
    text = ("一句话。" * 50 + "\n\n## 标题\n") * (2 * BLOCK // 208)
    parts = pieces(text)[0]
    assert {p[2] for p in parts[:-1]} == {"heading"}


@pytest.mark.parametrize("seed", range(40))
def test_unbroken_is_told_by_the_table(seed):
    r = random.Random(seed)
    text = "".join(r.choices(["字" * r.choice([5, 19, 20, 21]), "a" * 20, "\r\n", "\r", "\n# ", "。", " ", "b"], k=r.randint(0, 60)))
    assert pieces(text, 20, 3)[1] == (longest(text) > 20)


def test_no_slivers():
    text = ("字" * 3850 + "。") * 3
    parts, unbroken = pieces(text)
    assert not unbroken and min(e - s for s, e, _ in parts[:-1]) >= 2000


def test_pieces_of_a_table(spark):
    texts = {"a": "一句话。" * 3000, "b": None, "c": "", "d": "x" * 9001, "e": "x" * 4000, "f": "😀 " * 4000}
    df = spark.createDataFrame([(k, t, "clash", 1) for k, t in texts.items()] + [("a", texts["a"], "clash", 2)], "file_id string, t string, piece string, piece_no int")
    got = reassembled(split(df.filter("piece_no = 1"), "file_id", "t"), "file_id").collect()
    assert {r.file_id: r.text for r in got} == {k: texts[k] for k in "adf"} and all(r.fits and r.shared for r in got)
    assert split(df, "file_id", "t").count() == sum(len(pieces(texts[k])[0]) for k in "aadf")
    assert {r.file_id: r.cut for r in split_report(df, "file_id", "t").collect()} == {"a": "boundary", "d": "forced", "f": "boundary"}
    assert split(df.limit(0), "file_id", "t").count() == 0
