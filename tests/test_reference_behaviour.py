"""Literal rows: what each step must make of them."""

import datetime
import json
import threading
import uuid
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tributary.functions import text as t
from tributary.operators import cleansing as k
from tributary.operators import documents as d
from tributary.operators import graph as g
from tributary.operators import links, mapping, merge, profiling, rules
from tributary.plans import pipeline
from tributary.sources import connectors, exports, files
from tributary.streaming import incremental

PEOPLE = [("1", "Alice", "30", "9.5", "true"), ("2", "  Bob  ", "25", "8.0", "false"), ("3", "", None, "7.0", "true"), ("2", "Bob", "25", "8.0", "false")]
SCHEMA = "id string, name string, age string, score string, active string"


def test_cleansing(spark):
    seen = Observation("cleanse")
    rows = k.cleanse(spark.createDataFrame(PEOPLE, SCHEMA), observation=seen).collect()
    assert len(rows) == 3 and sum(r.id == "2" for r in rows) == 1
    assert seen.get == {"rows_before": 4, "null_cells_handled": 2}
    types = {r.column_name: r.type for r in profiling.schema_vote(spark.createDataFrame(PEOPLE, SCHEMA), ["id", "age", "score", "active"]).collect()}
    assert types == {"id": "integer", "age": "integer", "score": "float", "active": "boolean"}
    assert k.drop_nulls(spark.createDataFrame(PEOPLE, SCHEMA)).count() == 3
    assert k.mark_nulls(spark.createDataFrame(PEOPLE, SCHEMA)).filter("__null_age__ = '1'").count() == 1


@pytest.mark.parametrize("text,plain,compat", [("2024/1/5", "2024-01-05", "2024-01-05"), ("15/01/2024", "15/01/2024", "2024-15-01"), ("20240115", "2024-01-15", "2024-1-15"), ("2024-02-30", "2024-02-30", "2024-02-30"), ("x", "x", "x")])
def test_dates(spark, text, plain, compat):
    r = spark.range(1).select(k.iso_date(F.lit(text)).alias("a"), k.iso_date(F.lit(text), compat=True).alias("b"), k.iso_date(F.lit(text), day_first=True).alias("c")).first()
    assert (r.a, r.b) == (plain, compat) and (r.c == "2024-01-15" if text.startswith("15/") else True)


def test_quality(spark):
    dirty = [("1", "Alice", "30", "Beijing"), ("2", "", None, "Shanghai"), ("3", "Carol", "abc", ""), ("1", "Alice", "30", "Beijing")]
    r = profiling.quality_report(spark.createDataFrame(dirty, "id string, name string, age string, city string"), ["id", "name", "age", "city"]).first()
    assert (r.completeness, r.uniqueness, r.validity, r.overall, r.duplicates) == (0.813, 0.75, 0.75, 0.775, 1)
    clean = [("1", "Alice", "30"), ("2", "Bob", "25")]
    assert profiling.quality_report(spark.createDataFrame(clean, "id string, name string, age string"), ["id", "name", "age"]).first().overall == 1.0


def test_nested(spark):
    rows = [("o1", ("c1", ("X", "Y")), [("s1", 1), ("s2", 2)]), ("o2", ("c2", ("Z", "W")), [("s3", 3)]), ("o3", ("c3", ("Z", "W")), [])]
    df = spark.createDataFrame(rows, "order_id string, customer struct<id:string,address:struct<city:string,country:string>>, items array<struct<sku:string,qty:int>>")
    out = k.explode_array(k.flatten(df))
    assert out.count() == 4 and {"customer.id", "customer.address.city", "items.sku"} <= set(out.columns)
    assert out.filter("items = '[]'").count() == 1
    assert k.flatten(df, max_depth=1).schema["customer.address"].dataType.typeName() == "string"


def test_xml(spark):
    df = spark.createDataFrame([(1, "<l><a id='1'><t>x</t></a><a id='2'><t/></a></l>"), (2, "<broken xml"), (3, None)], "k int, doc string")
    rows = k.xml_records(df, "doc", "a", "id string, t string", ["k"]).collect()
    assert sorted((r.k, r.id) for r in rows if r.id) == [(1, "1"), (1, "2")] and {r.k for r in rows} == {1, 2, 3}


TEXT = """1. Purpose
Lateness and cost.
2. Rules
IF delay > 5 days, notify buyer
- IF x, y
if cost > 1,000 THEN escalate
3. Terms
Lead Time (days): time from order to receipt
Step 1 (a): not one
## not
| supplier_id | | score |
|---|---|---|
| SUP-001 | a | 9 |
| short |
| SUP-002 | b | 8 |
"""


def test_documents(spark):
    df = spark.createDataFrame([("f", TEXT), ("g", "## A\n\n## B\ntext"), ("h", "plain"), ("e", ""), ("n", None)], "id string, md string")
    assert [(r.condition, r.action) for r in d.rules(df, "id", "md").orderBy("rule_index").collect()] == [("cost > 1,000", "escalate"), ("delay > 5 days", "notify buyer")]
    assert [(r.name, r.qualifier) for r in d.definitions(df, "id", "md").collect()] == [("Lead Time", "days")]
    rows = d.tables(df, "id", "md").orderBy("table_row_index").collect()
    assert [r.cells for r in rows] == [{"supplier_id": "SUP-001", "col_2": "a", "score": "9"}, {"supplier_id": "SUP-002", "col_2": "b", "score": "8"}] and rows[0].section_title == "not"
    s = {(r.id, r.section_index): r.section_title for r in d.sections(df, "id", "md").collect()}
    assert ("g", 1) not in s and s["g", 2] == "B" and ("h", 1) in s
    kinds = {(r.id, r.row_type) for r in d.extract(df, "id", "md").collect()}
    assert {("f", "rule"), ("f", "table_row"), ("f", "definition"), ("f", "section"), ("h", "section")} <= kinds and not any(i in ("e", "n") for i, _ in kinds)


def test_graph(spark):
    v = spark.createDataFrame([("a", "o", "N"), ("b", "o", "N"), ("c", "o", "M")], "id string, ontology_id string, name_cn string")
    e = spark.createDataFrame([("1", "o", "a", "b", "R")], "id string, ontology_id string, source_entity string, target_entity string, type string")
    q = g.quality(v, e).first()
    assert (q.isolated, q.duplicate_names, q.quality, q.density) == (1, 2, 0.7, 0.3333)
    assert g.quality(v.limit(0), e.limit(0)).first().quality == 1.0
    chain = spark.createDataFrame([(str(i), "o", f"n{i}", f"n{i + 1}", "R") for i in range(6)], e.schema)
    assert g.shortest_path(chain, "n0", "n4") == ["n0", "n1", "n2", "n3", "n4"] and g.shortest_path(chain, "n0", "zz") is None
    assert {r.id: r.hops for r in g.neighbourhood(chain, spark.createDataFrame([("n2",)], "id string"), 2).collect()} == {"n2": 0, "n1": 1, "n3": 1, "n0": 2, "n4": 2}


def test_identifiers(spark):
    for name in ("o1:Customer:id:1", "o1:供应商:编号:甲"):
        assert spark.range(1).select(t.uuid5(F.lit(name))).first()[0] == str(uuid.uuid5(uuid.NAMESPACE_URL, name))


def test_edits(spark):
    df = spark.createDataFrame([(1, "Alice", 30), (2, "Bob", 25)], "id int, name string, age int")
    edits = spark.createDataFrame([("1", "name", "Alice Smith", 1), ("2", "age", None, 2), ("1", "name", "A. Smith", 3)], "row_pk string, field_name string, new_value string, seq int")
    assert [tuple(r) for r in profiling.apply_edits(df, "id", edits, ["name", "age"]).orderBy("id").collect()] == [(1, "A. Smith", 30), (2, "Bob", None)]


def test_mapping(spark):
    orders = spark.createDataFrame([("o1", "SUP-001", "x"), ("o2", "SUP-002", "y"), ("o3", "SUP-009", "z")], "order_id string, supplier_id string, note string")
    sup = spark.createDataFrame([("SUP001", "甲"), ("SUP002", "乙")], "supplier_id string, name string")
    cand = mapping.fk_candidates(orders, "orders", sup, "suppliers", "supplier_id", "order_id")
    assert [c["column"] for c in cand] == ["supplier_id"]
    once = mapping.infer_relations(orders, "Order", "order_id", sup, "Supplier", "supplier_id", cand, "o1")
    assert once.count() == 2 and once.unionByName(once).dropDuplicates(["id"]).count() == 2
    assert mapping.infer_relations(orders, "Order", "order_id", sup, "Supplier", "supplier_id", cand, "o1", "concept").count() == 1
    docs = spark.createDataFrame([("d1", "甲公司，乙公司"), ("d2", "丙公司;乙公司")], "id string, orgs string")
    comp = spark.createDataFrame([("s1", "甲公司"), ("s2", "乙公司")], "id string, name string")
    assert {tuple(r) for r in links.alternate_key_join(docs, "id", "orgs", comp, "id", "name").collect()} == {("d1", "s1"), ("d1", "s2"), ("d2", "s2")}


def test_names(spark):
    known = spark.createDataFrame([("供应商A", "1"), ("供应商管理办法", "2"), ("仓库", "3")], "n string, id string")
    asked = spark.createDataFrame([("供应商",), ("仓库",), ("大仓库区",), ("无",), ("",), (None,)], "q string")
    got = {r.name: r.id for r in links.resolve_names(asked, "q", known, "n", "id").collect()}
    assert got["仓库"] == "3" and got["大仓库区"] == "3" and got["供应商"] in ("1", "2") and "无" not in got


def test_rules_and_actions(spark):
    df = spark.createDataFrame([(1, "7"), (2, "x"), (3, None)], "id int, v string")
    got = {(r.id, r.rule): (r.status, r.passed) for r in rules.evaluate(df, "id", [{"name": "gt", "expression": {"op": "gt", "field": "v", "value": "5"}}, {"name": "none", "expression": {"op": "eq", "field": "nope", "value": "None"}}]).collect()}
    assert got[1, "gt"] == ("completed", True) and got[2, "gt"] == ("failed", False) and got[3, "gt"] == ("failed", False) and got[1, "none"] == ("completed", True)
    assert [r[0] for r in spark.createDataFrame([("x = 1",), ("x =",), (None,)], "c string").select(rules.valid_code(F.col("c"))).collect()] == [True, False, None]
    v = spark.createDataFrame([("a", "o", "A", {"s": "1"}), ("b", "o", "B", None)], "id string, ontology_id string, name_cn string, properties map<string,string>")
    e = spark.createDataFrame([("1", "o", "a", "b", "R")], "id string, ontology_id string, source_entity string, target_entity string, type string")
    runs = [("r1", 1, True, True, "set_property", "a", "o", "s", "2", None, None), ("r2", 2, True, True, "set_property", "a", "o", "s", "3", None, None), ("r3", 3, True, False, "set_property", "b", "o", "s", "9", None, None), ("r4", 4, True, True, "create_object", "c", "o", None, "C", None, None), ("r5", 5, True, True, "merge_relationship", "c", "o", None, None, "a", "R"), ("r6", 6, True, True, "delete_relationship", "b", "o", None, None, "a", "R"), ("r7", 7, True, True, "fly", "b", "o", None, None, None, None)]
    nv, ne, log = rules.run_actions(v, e, spark.createDataFrame(runs, "id string, seq int, published boolean, enabled boolean, effect string, target_id string, ontology_id string, field string, value string, source string, relation string"))
    assert {r.id: (r.properties or {}).get("s") for r in nv.collect()} == {"a": "3", "b": None, "c": None}
    assert [(r.source_entity, r.target_entity) for r in ne.collect()] == [("a", "c")]
    assert {r.id: r.status for r in log.collect()} == {"r1": "completed", "r2": "completed", "r3": "refused", "r4": "completed", "r5": "completed", "r6": "completed", "r7": "skipped"}


def test_merge(spark):
    df = spark.createDataFrame([("n", None, "ab", 1), ("n", "x", "abcdef", 2), ("n", "y", "z", 3)], "k string, a string, b string, o int")
    assert tuple(merge.fold_richer(df, "k", ["a", "b"], ["o"]).first()) == ("n", "x", "ab")
    assert merge.keep_richest(df, ["k"], ["a", "b"], ["o"]).first().o == 2


def test_pipeline(spark):
    with pytest.raises(ValueError, match="may not feed"):
        pipeline.compile_pipeline({"nodes": [{"id": "a", "type": "connector"}, {"id": "o", "type": "output"}], "edges": [{"source": "a", "target": "o"}]}, {})
    assert pipeline.topological(["b", "a", "x", "y"], [("a", "b"), ("x", "y"), ("y", "x")]) == ["a", "b", "x", "y"]
    with pytest.raises(ValueError):
        g.guarded_query(spark, "DROP TABLE x -- ontology_id", {})


class _Pages(BaseHTTPRequestHandler):
    def do_GET(self):  # noqa: N802
        from urllib.parse import parse_qs, urlparse

        q = {a: b[0] for a, b in parse_qs(urlparse(self.path).query).items()}
        lo, size = (int(q.get("page", 1)) - 1) * int(q.get("size", 100)), int(q.get("size", 100))
        body = {"items": [{"n": i} for i in range(lo, min(25, lo + size))]} if "since" not in q else [{"n": int(q["since"]) + 1}]
        self.send_response(200)
        self.end_headers()
        self.wfile.write(json.dumps(body).encode())

    def log_message(self, *a):
        pass


def test_rest_over_http(spark):
    server = HTTPServer(("127.0.0.1", 0), _Pages)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        con = connectors.connector(spark, "rest", size=10, pages=4, pages_a_partition=4)
        url = f"http://127.0.0.1:{server.server_port}"
        assert sorted(json.loads(r.record)["n"] for r in con.pull_full(url).collect()) == list(range(25))
        assert json.loads(con.pull_delta(url, since="7").first().record)["n"] == 8
        assert con.pull_sample(url, 3).count() == 3
    finally:
        server.shutdown()
    with pytest.raises(ValueError):
        connectors.connector(spark, "ftp")
    with pytest.raises(ValueError):
        connectors.identifier("a; drop")


def test_files(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("﻿id,name\n1,x\n2\n3,y,z\n".encode())
    rows = files.csv(spark, str(tmp_path / "a.csv"), ["id", "name"]).collect()
    assert [(r.id, r.name) for r in rows] == [("1", "x"), ("2", None), ("3", "y")] and rows[2]._corrupt is not None
    (tmp_path / "b.html").write_text("<h1>T</h1><p>a &amp; b</p><script>x</script>")
    (tmp_path / "c.pdf").write_bytes(b"x")
    docs = files.documents(spark, str(tmp_path))
    got = {r.filename: r for r in files.to_markdown(docs, lambda n, c: n.upper() if n == "c.pdf" else 1 / 0).collect()}
    assert got["b.html"].markdown_text.split() == ["#", "T", "a", "&", "b"] and got["c.pdf"].markdown_text == "C.PDF"
    assert files.to_markdown(docs).filter("filename = 'c.pdf'").first().extraction_error


def test_upsert_and_stream(spark, tmp_path):
    v = spark.createDataFrame([("a", "x", {"p": "1", "q": "2"})], "id string, n string, properties map<string,string>")
    u = spark.createDataFrame([("a", None, {"q": "3"}), ("b", "y", None)], v.schema)
    once = exports.upsert(v, u)
    assert {r.id: (r.n, r.properties) for r in once.collect()} == {"a": ("x", {"p": "1", "q": "3"}), "b": ("y", {})}
    assert {r.id: (r.n, r.properties) for r in exports.upsert(once, u).collect()} == {r.id: (r.n, r.properties) for r in once.collect()}
    df = spark.createDataFrame([(i, " x ", datetime.datetime(2025, 1, 1 + i % 3)) for i in range(30)], "id int, t string, ts timestamp")
    df.write.parquet(str(tmp_path / "s"))
    s = spark.readStream.schema(df.schema).parquet(str(tmp_path / "s"))
    assert incremental.run_available(k.trim_strings(s)).exceptAll(k.trim_strings(df)).isEmpty()
    assert incremental.run_available(incremental.windowed_counts(s, "ts", "t"), "complete").agg(F.sum("n")).first()[0] == 30


def test_build_all(spark):
    from tributary.operators.ontology import Dataset, build_all

    orders = spark.createDataFrame([("o1", "SUP-001", "甲公司，乙公司", "W1"), ("o2", "SUP-002", "乙公司", "W2"), ("o3", "SUP-003", "丙", "W2")], "order_id string, supplier_id string, mentions string, `库位编号` string")
    sup = spark.createDataFrame([("SUP001", "甲公司"), ("SUP002", "乙公司")], "supplier_id string, name string")
    ware = spark.createDataFrame([("w-a", "W1"), ("w-b", "W2"), ("w-c", "W3")], "wid string, `库位编号` string")
    sets = [Dataset("orders", orders, {"entity_class": "Order", "primary_key": "order_id"}), Dataset("suppliers", sup, {"entity_class": "Supplier", "primary_key": "supplier_id"}), Dataset("warehouses", ware, {"entity_class": "Warehouse", "primary_key": "wid"})]
    link = {"source": "suppliers", "target": "orders", "src_key": "name", "tgt_key": "mentions", "relation": "NAMED_IN"}
    out = build_all(spark, "o1", sets, [link, {**link, "status": "suggested", "relation": "NOT"}])
    got = {(r.type, r.origin): r.n for r in out["relations"].groupBy("type", "origin").agg(F.count("*").alias("n")).collect()}
    assert got[("HAS_SUPPLIER", "fk")] == 2
    assert got[("HAS_SUPPLIER", "alt_key")] == 3 and got[("HAS_WAREHOUSE", "same_name")] == 3 and got[("NAMED_IN", "link")] == 1 and not any(k == "NOT" for k, _ in got)
    counts = {r.part: r.n for r in out["summary"].collect()}
    assert (counts["concepts"], counts["instances"]) == (3, 8)
    again = build_all(spark, "o1", sets, [link])
    assert out["relations"].select("id").exceptAll(again["relations"].select("id")).isEmpty() and out["instances"].select("id").exceptAll(again["instances"].select("id")).isEmpty()
