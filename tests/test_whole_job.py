"""Queries on small tables that hold what a cut would lose."""

import pytest

from tributary.operators import documents, graph
from tributary.queries import flows, joins
from tributary.queries.registry import view
from tributary.sources import connectors

FOLDER = "/root/testdata/sf0.001"


def test_names_resolve_against_entities_of_all_types(spark):
    known: dict[str, str] = {}
    for r in view(spark, FOLDER, "v").collect():
        if r.name_cn:
            known[r.name_cn] = min(r.id, known.get(r.name_cn, r.id))
    asked = {n for r in view(spark, FOLDER, "a").collect() for n in r.linked_entities or [] if n}
    want = {}
    for n in asked:
        near = [(len(set(n) & set(k)), k) for k in known if k in n or n in k]
        if n in known or near:
            want[n] = known[n if n in known else max(near)[1]]
    got = joins.q.queries["joi_13_fuzzy_names"](spark, FOLDER).collect()
    assert {r["name"]: r["id"] for r in got} == want and len(got) == len(want)
    types = {r.name_cn: r.type for r in view(spark, FOLDER, "v").collect()}
    assert {types.get(n) for n in want} - {"指标", "概念", None}, "names of all types are asked for"


def test_orphans_of_all_types_meet_anchors_of_their_type(spark, tmp_path):
    kinds = ["指标", "概念", "物料", "单据", "供应商", "客户"]
    rows = [{"id": f"{end}{i}", "ontology_id": onto, "name_cn": f"甲乙丙{i}", "type": t, "confidence": 0.9} for i, t in enumerate(kinds) for end, onto in (("orphan", "o-1"), ("anchor", "o-sup-00000"))]
    rows.append({"id": "other", "ontology_id": "o-1", "name_cn": "甲乙丙0", "type": "客户", "confidence": 0.9})
    at = spark.read.parquet(f"{FOLDER}/entities.parquet").agg({"updated_at": "max"}).first()[0]
    rows = [r | {"updated_at": at} for r in rows]
    for name, some in (("entities", rows), ("relations", [])):
        schema = spark.read.parquet(f"{FOLDER}/{name}.parquet").schema
        spark.createDataFrame([tuple(r.get(c) for c in schema.names) for r in some], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    want = {(f"orphan{i}", f"anchor{i}") for i in range(len(kinds))}
    got = joins.q.queries["joi_14_anchor_matching"](spark, str(tmp_path)).collect()
    assert {(r.orphan, r.anchor) for r in got if r.method == "exact_name_cn"} == want
    plan = flows.q.queries["mpg_19_link_plan"](spark, str(tmp_path)).collect()
    assert {(r.orphan, r.anchor) for r in plan if r.action == "merge"} == want
    kept = {r.id for r in flows.q.queries["mpg_20_apply_plan"](spark, str(tmp_path)).collect()}
    assert kept == {f"anchor{i}" for i in range(len(kinds))} | {"other"}


def test_long_documents_come_out_whole(spark):
    body = "\n".join([f"Term{i} (unit): " + "x" * 600 for i in range(25)] + [f"{i + 10}吨" for i in range(9)])
    df = spark.createDataFrame([("a", "# Head\n" + body), ("b", "y" * 3000), ("c", "z" * 3000)], "id string, md string")
    text = {r.id: r.section_text for r in documents.sections(df, "id", "md").collect()}
    assert text == {"a": body, "b": "y" * 3000, "c": "z" * 3000}
    assert {r.id: len(r.section_text) for r in documents.sections(df, "id", "md", longest=2000).collect()} == {"a": 2000, "b": 2000, "c": 2000}
    assert [len(r.definition) for r in documents.definitions(df, "id", "md").collect()] == [600] * 25
    got = {(r.id, r.row_type): r for r in documents.extract(df, "id", "md").collect()}
    assert got["a", "section"].body == body and got["a", "section"].thresholds == ", ".join(str(i + 10) for i in range(9))


def test_a_service_is_read_to_its_last_page(spark, tmp_path):
    service = "def fetch(url, page=1, page_size=100, since=None):\n    lo = (page - 1) * page_size\n    return {'data': [{'n': i} for i in range(lo, min(250 if since else 1205, lo + page_size))]}\n"
    module = tmp_path / "many_pages.py"
    module.write_text(service)
    spark.sparkContext.addPyFile(str(module))
    scope: dict = {}
    exec(service, scope)
    assert len(list(connectors.pages(scope["fetch"], "u", size=10))) == 1205
    assert len(list(connectors.pages(scope["fetch"], "u", last=121, size=10))) == 1205
    with pytest.raises(RuntimeError, match="more than the 120 pages"):
        list(connectors.pages(scope["fetch"], "u", last=120, size=10))
    con = connectors.connector(spark, "rest", fetch="many_pages:fetch", size=10)
    assert con.pull_full("u").distinct().count() == con.pull_full("u").count() == 1205
    assert con.pull_delta("u", since="1").count() == 250


@pytest.mark.parametrize("n", [49, 100, 849])
def test_a_delta_in_one_reply_is_read_once(n):
    assert len(list(connectors.pages(lambda url, **p: {"items": [{"n": i} for i in range(n)]}, "u", since="1"))) == n


def test_distances_reach_the_end_of_a_long_chain(spark):
    edges = spark.createDataFrame([(f"v{i:02}", f"v{i + 1:02}") for i in range(55)], "source_entity string, target_entity string")
    start = spark.createDataFrame([("v00",)], "id string")
    assert {r.id: r.hops for r in graph.distances(edges, start).collect()} == {f"v{i:02}": i for i in range(56)}
    with pytest.raises(RuntimeError, match="more than 3 steps"):
        graph.distances(edges, start, 3)


def test_links_reach_purchase_orders_of_every_load(spark, tmp_path):
    spark.createDataFrame([("l1", " A ")], "row_id string, `产品编码` string").write.parquet(f"{tmp_path}/logistics_fulfillment.parquet")
    spark.createDataFrame([("p1", "A", 1), ("p2", "A", 2), ("p3", "B", 2)], "row_id string, `物料编码` string, load_no int").write.parquet(f"{tmp_path}/purchase_orders.parquet")
    got = joins.q.queries["joi_05_link_mapping"](spark, str(tmp_path)).collect()
    assert sorted((r.source, r.target) for r in got) == [("l1", "p1"), ("l1", "p2")]
