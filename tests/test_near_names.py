"""The best anchor of each name equals brute force, and crowded names do not multiply rows."""

import difflib
import random
import threading

import pytest
from pyspark.sql import functions as F

from tributary.operators import links, near_names
from tributary.queries import flows


def crowd(spark, n):
    """n names that share one English name, so that all pairs of theirs would be n times n."""
    return spark.range(n).select(F.concat(F.lit("v"), "id").alias("id"), F.concat(F.lit("名"), F.col("id") * 7919).alias("name_cn"), F.lit("Material").alias("name_en"), F.lit("物料").alias("type"))


@pytest.fixture
def hurry(spark):
    """Jobs that run for more than a minute are cancelled, so that a test fails instead of never ending."""
    timer = threading.Timer(60, spark.sparkContext.cancelAllJobs)
    timer.start()
    yield
    timer.cancel()


def test_a_shared_english_name_does_not_pair_all_rows(spark, hurry):
    v = crowd(spark, 40_000)
    got = links.anchor_matches(v.withColumn("id", F.concat(F.lit("o"), "id")).withColumn("name_cn", F.concat(F.lit("另"), "name_cn")), v)
    assert [tuple(r) for r in got.groupBy("method", "anchor", "score").count().collect()] == [("exact_name_en", "v0", 0.98, 40_000)]


def test_the_plan_of_crowded_names_has_one_row_an_orphan(spark, tmp_path, hurry):
    v = crowd(spark, 30_000)
    both = v.withColumn("ontology_id", F.lit("o-sup-00000")).unionByName(v.withColumns({"id": F.concat(F.lit("o"), "id"), "name_cn": F.concat(F.lit("另"), "name_cn"), "ontology_id": F.lit("o-1")}))
    both.withColumns({"confidence": F.lit(0.9), "updated_at": F.current_timestamp()}).write.parquet(f"{tmp_path}/entities.parquet")
    got = flows.q.queries["mpg_19_link_plan"](spark, str(tmp_path))
    assert [tuple(r) for r in got.groupBy("anchor", "method", "action").count().collect()] == [("v0", "exact_name_en", "merge", 30_000)]


def brute(names, others, least):
    out = {}
    for g, n in names:
        found = []
        for g2, m, p in others:
            short, long_ = sorted((len(n), len(m)))
            if g != g2:
                continue
            if (n in m or m in n) and short >= 2 and short / long_ >= 0.5:
                found.append((-(0.80 + 0.08 * short / long_), "substring", p))
            elif (s := difflib.SequenceMatcher(None, n, m).ratio()) >= least:
                found.append((-s, "ratio", p))
        if found:
            out[g, n] = min(found)
    return out


@pytest.mark.parametrize("least", [0.7, 0.85, 0.95])
def test_the_best_partner_is_that_of_brute_force(spark, least):
    rnd = random.Random(5)
    stems = ["".join(rnd.choices("甲乙丙丁戊己庚辛a", k=k)) for k in (1, 2, 3, 5, 7, 9, 11, 14, 20, 31, 33, 40, 66, 90, 210) for _ in range(3)]

    def changed(s):
        for _ in range(rnd.choice([0, 1, 1, 2, 3, len(s) // 7])):
            at = rnd.randrange(len(s) + 1)
            s = s[:at] + rnd.choice(["", "甲", "乙b", "9", "😀"]) + s[at + rnd.randrange(2) :]
        return s[rnd.randrange(len(s) // 2 + 1) :] if rnd.random() < 0.3 else s

    sides = [{(rnd.choice("xy"), t) for _ in range(150) if (t := changed(rnd.choice(stems)))} for _ in range(2)]
    names, others = sides[0] - sides[1], [(g, t, f"p{i:04}") for i, (g, t) in enumerate(sorted(sides[1], key=lambda x: rnd.random()))]
    want = brute(names, others, least)
    got = near_names.best_partners(spark.createDataFrame(sorted(names), "group string, name string"), spark.createDataFrame(others, "group string, name string, partner string"), least).collect()
    assert {(r.group, r.name): (-r.score, r.method, r.partner) for r in got} == want and len(got) == len(want)
    assert {m for _, m, _ in want.values()} == {"ratio", "substring"} and max(len(n) for _, n in want) > 64


def test_nothing_matches_null_or_empty_names(spark):
    rows = [("1", None, None, "t"), ("2", "", "", "t"), ("3", "甲乙丙丁", "x", None), ("4", "甲乙丙丁", None, "t")]
    schema = "id string, name_cn string, name_en string, type string"
    got = links.anchor_matches(spark.createDataFrame(rows, schema), spark.createDataFrame(rows[:3] + [("5", "甲乙丙丁戊", "", "t")], schema)).collect()
    assert [(r.orphan, r.anchor, r.method) for r in got] == [("4", "5", "substring")]
