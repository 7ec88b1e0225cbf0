import random

from tributary.operators.column_profile import findings, mask_table, pattern_report, profile, values

LOAD = ["feed", "load_no"]
COLS = ["订单号", "数量", "状态"]
SCHEMA = "feed string, load_no int, `订单号` string, `数量` string, `状态` string, column_name string, value string"


def rows(load, n, **cells):
    base = {"订单号": lambda i: f"PO-202501-{i:04d}", "数量": lambda i: str(i + 1), "状态": lambda i: "开" if i % 2 else "关"}
    make = base | cells
    return [("f", load, *(make[c](i) for c in COLS), "x", "y") for i in range(n)]


RECORDED = "feed string, load_no int, name string, null_count long, null_pct double, distinct_count long, inferred_type string, n long"


def run(spark, data, recorded=()):
    v = values(spark.createDataFrame(data, SCHEMA), COLS, LOAD)
    rec = spark.createDataFrame(list(recorded), RECORDED)
    return {(r.load_no, r.column_name, r.finding) for r in findings(v, rec).collect()}


def test_profile(spark):
    data = [("f", 1, x, x, x, "", "") for x in [None, "", "  ", "1", " 1", "-2", "x"]] + [(None, None, "1", "1", "1", "", "")]
    p = {(r.feed, r.column_name): r for r in profile(mask_table(values(spark.createDataFrame(data, SCHEMA), COLS, LOAD), LOAD), LOAD).collect()}
    r = p["f", "数量"]
    assert (r.null_count, r.distinct_count, r.inferred_type, r.min_number, r.max_number) == (3, 4, "mixed", -2, 1) and abs(r.null_pct - 300 / 7) < 1e-9
    assert p[None, "数量"].inferred_type == "integer"


def test_types(spark):
    for cells, want in ((["1", "+2"], "integer"), (["1", "2.5"], "float"), (["true", "False"], "boolean"), (["a", "1,000"], "string"), ([None, " "], "null"), (["1", "a"], "mixed"), (["true", "x"], "mixed"), ([".5", "5."], "float")):
        data = [("f", 1, x, x, x, "", "") for x in cells]
        assert {r.inferred_type for r in profile(mask_table(values(spark.createDataFrame(data, SCHEMA), COLS, LOAD), LOAD), LOAD).collect()} == {want}


def test_findings(spark):
    assert run(spark, rows(1, 100) + rows(2, 100)) == set()
    assert run(spark, rows(1, 100) + rows(3, 10, 状态=lambda i: "x")) == set()
    assert (2, "状态", "null_rate") in run(spark, rows(1, 100) + rows(2, 100, 状态=lambda i: None if i < 10 else "开" if i % 2 else "关"))
    assert run(spark, rows(1, 100) + rows(2, 100, 数量=lambda i: str(i + 1) if i else "-1")) == {(2, "数量", "range")}
    assert (2, "数量", "range") in run(spark, rows(1, 100) + rows(2, 100, 数量=lambda i: str((i + 1) * 6)))
    assert run(spark, rows(1, 100) + rows(2, 100, 状态=lambda i: "开" if i < 70 else "关")) == {(2, "状态", "drift")}
    assert run(spark, rows(1, 100) + rows(2, 100, 状态=lambda i: "开" if i < 69 else "关")) == set()
    assert run(spark, rows(1, 100, 订单号=lambda i: "po" if i < 6 else f"PO-202501-{i:05d}")) == {(1, "订单号", "pattern")}
    assert run(spark, rows(1, 100, 订单号=lambda i: "po" if i < 5 else f"PO-202501-{i:05d}")) == set()
    assert (2, "订单号", "distinct") in run(spark, rows(1, 100) + rows(2, 49))
    assert (2, "数量", "type") in run(spark, rows(1, 100) + rows(2, 100, 数量=lambda i: f"{i}.5"))


def test_recorded(spark):
    good, off = ("f", 1, "数量", 0, 0.0, 100, "integer", 1), ("f", 1, "数量", 0, 0.02, 100, "integer", 1)
    assert run(spark, rows(1, 100), [good]) == set()
    for bad in (off, ("f", 1, "数量", 1, 0.0, 100, "integer", 1), ("f", 1, "数量", 0, 0.0, 99, "integer", 1), ("f", 1, "数量", 0, 0.0, 100, "float", 1), ("f", 1, "数量", None, None, None, None, 1)):
        assert run(spark, rows(1, 100), [bad]) == {(1, "数量", "recorded")}


def test_patterns_and_edges(spark):
    r = random.Random(0)
    data = rows(1, 100) + rows(2, 100, 订单号=lambda i: "短" if i < 3 else f"PO-202501-{r.randint(0, 9999):04d}")
    v = values(spark.createDataFrame(data, SCHEMA), COLS, LOAD)
    got = {(x.load_no, x.column_name): x for x in pattern_report(v).collect()}
    assert (got[2, "订单号"].masks, got[2, "订单号"].rare_values, got[2, "订单号"].top_mask) == (2, 3, "PO-999999-9999") and abs(got[2, "订单号"].mask_divergence - 0.03) < 1e-6
    assert got[1, "订单号"].mask_divergence is None
    assert run(spark, []) == set()
    assert run(spark, rows(1, 3, 状态=lambda i: "长" * 50_000)) == set()
