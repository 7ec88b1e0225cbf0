"""No operator drops what lies beyond an old limit."""

import pytest
from pyspark.sql import functions as F

from tributary.operators import catalog, documents, graph, mapping
from tributary.sources import exports


def test_documents_keep_everything(spark):
    md = "\n".join(f"# t{i}\n名称{i} (q): {'长' * 600}\n" for i in range(40))
    d = spark.createDataFrame([(1, md)], "id int, md string")
    assert documents.definitions(d, "id", "md").filter("length(definition) = 600").count() == 40
    one = documents.common(d, "id", "md").first()
    assert one.section_count == 40 and one.sections.count(",") == 39 and len(one.doc_summary) > 24_000
    own = spark.createDataFrame([(" ".join(f"{i}0吨" for i in range(1, 31)),)], "t string")
    assert documents.enrich(own, ["t"]).first().thresholds.count(",") == 29
    bad = documents.structured_by(d, "id", "md", lambda texts: [], auto=True).first()
    assert "extraction_error" in bad.fields


def test_graph_goes_to_the_end(spark):
    e = spark.createDataFrame([(f"e{i}", f"v{i}", f"v{i + 1}") for i in range(12)], "id string, source_entity string, target_entity string")
    start = spark.createDataFrame([("v0",)], "id string")
    assert graph.neighbourhood(e, start, 9).count() == 10 and graph.neighbourhood(e, start, 30).count() == 13
    assert {r.id: r.hops for r in graph.distances(e, start).collect()} == {f"v{i}": i for i in range(13)}
    with pytest.raises(ValueError):
        graph.neighbourhood(e, start, 0)


def test_guarded_query_reads_the_plan(spark):
    v = {"vertices": spark.createDataFrame([("a", "o1", "delete me"), ("b", "o2", "x")], "id string, ontology_id string, name string")}
    assert graph.guarded_query(spark, "SELECT id FROM vertices WHERE ontology_id = 'o1' AND name = 'delete me'", v).count() == 1
    for text in ("SELECT id FROM vertices -- ontology_id", "SELECT id FROM vertices WHERE name = 'ontology_id'", "SELECT ontology_id FROM vertices", "DROP VIEW vertices", "INSERT INTO vertices SELECT * FROM vertices WHERE ontology_id = 'x'", "SELECT a.id FROM vertices a WHERE a.ontology_id = 'o1' UNION ALL SELECT id FROM vertices"):
        with pytest.raises(ValueError):
            graph.guarded_query(spark, text, v)


def test_nulls_survive_deleting_and_merging(spark):
    v = spark.createDataFrame([("a", "o1"), ("b", "o2"), ("c", None)], "id string, ontology_id string")
    e = spark.createDataFrame([("1", "a", "b", "t"), ("2", "c", None, "t"), ("3", "c", "b", "t")], "id string, source_entity string, target_entity string, type string")
    left, edges = exports.delete_scope(v, e, "o1")
    assert {r.id for r in left.collect()} == {"b", "c"} and {r.id for r in edges.collect()} == {"2", "3"}
    v = spark.createDataFrame([(x, None, None) for x in "abcd"], "id string, name_en string, description string")
    e = spark.createDataFrame([("1", "a", "c", "t"), ("2", "b", "c", "t"), ("3", "a", "b", "t"), ("4", "d", None, "t"), ("5", "d", None, "t"), ("6", None, "d", "t")], "id string, source_entity string, target_entity string, type string")
    plan = spark.createDataFrame([("a", "b", "merge")], "orphan string, anchor string, action string")
    v2, e2 = mapping.apply_plan(v, e, plan)
    assert {r.id for r in v2.collect()} == {"b", "c", "d"}
    assert {(r.id, r.source_entity, r.target_entity) for r in e2.collect()} == {("1", "b", "c"), ("4", "d", None), ("5", "d", None), ("6", None, "d")}


def test_sanitise_is_deterministic(spark):
    v = spark.createDataFrame([("a", i, {"k": str(i)}) for i in range(50)] + [(None, 1, None)], "id string, n int, m map<string,string>")
    e = spark.createDataFrame([("1", "a", "a")], "id string, source_entity string, target_entity string")
    assert {graph.sanitise(v.repartition(k, "n"), e)[0].first().n for k in (1, 3, 7)} == {0}


def test_discovery_takes_all_timestamps():
    names = [a["name"] for a in mapping.discover_actions([], {}, [f"t{i}" for i in range(9)], [])]
    assert sum(n.startswith("Set ") for n in names) == 9
    assert sum(a["name"].startswith("Set ") for a in mapping.discover_actions([], {}, [f"t{i}" for i in range(9)], [], most=3)) == 3


def test_catalog(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("b", 3, "y"), (None, 4, "z")], "k string, n int, t string")
    assert {(r.k, r.n, r.source_row_count) for r in catalog.collapsed(df, "k", ["n", "t"], ["n"]).collect()} == {("a", 1, 2), ("b", 3, 1)}
    assert {(r.k, r.t) for r in catalog.keep_first(df, ["k"], ["n"]).collect()} == {("a", "x"), ("b", "y"), (None, "z")}
    assert [r.samples for r in catalog.samples(df.filter("k = 'a'"), "k", "n", 1).collect()] == [[1]]
    assert catalog.same_rows(df, df).first().equal and not catalog.same_rows(df, df.unionAll(df)).first().equal and catalog.same_rows(df.limit(0), df.limit(0)).first().equal
    assert catalog.reconciled(df, df.filter("n <> 2"), "k").first().k == "a"
    assert [r.n for r in catalog.page(df, ["n"], 2, 1).collect()] == [3, 4]
    assert catalog.synced(df, df, "append").count() == 8 and catalog.synced(df, df, "snapshot").count() == 4
    with pytest.raises(ValueError):
        catalog.synced(None, df, "other")


def test_checksum_of_the_whole_content(spark):
    v = spark.createDataFrame([("d", 1, "x" * 2000 + "a"), ("e", 1, "x" * 2000 + "b")], "d string, version_no int, t string")
    whole, part = exports.next_version(v, "d", F.col("t")), exports.next_version(v, "d", F.col("t"), 1024)
    assert whole.select("checksum").distinct().count() == 2 and part.select("checksum").distinct().count() == 1
