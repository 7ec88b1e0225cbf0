"""Queries of joins, aggregations and graph operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.operators import catalog
from tributary.operators import graph as g
from tributary.operators import links as ln
from tributary.operators import profiling as p
from tributary.queries.registry import Registry, latest

q = Registry()
c = F.col


@q("joi_01_fk_exact", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def _(T):
    return T("supplier").join(T("nation"), c("s_nationkey") == c("n_nationkey")).select("s_suppkey", "n_name")


@q("joi_02_fk_normalised", "SELECT o_orderkey, 'C-' || o_custkey AS target_key, CASE WHEN o_orderkey % 2 = 0 THEN 'exact' ELSE 'normal' END AS how FROM orders JOIN customer ON o_custkey = c_custkey")
def _(T):
    ref = F.when(c("o_orderkey") % 2 == 0, F.concat(F.lit("C-"), c("o_custkey").cast("string"))).otherwise(F.concat(F.lit("c_"), c("o_custkey").cast("string")))
    t = T("customer").select(F.concat(F.lit("C-"), c("c_custkey").cast("string")).alias("pk"))
    return ln.exact_or_normal(T("orders").select("o_orderkey", ref.alias("ref")), "ref", t, "pk").select("o_orderkey", "target_key", "how")


@q("joi_03_same_name", "SELECT DISTINCT p.row_id AS source, t.target FROM purchase_orders p JOIN (SELECT upper(regexp_replace(\"产品编码\", '[\\s\\-_]', '', 'g')) AS k, max(row_id) AS target FROM logistics_fulfillment WHERE trim(\"产品编码\") <> '' GROUP BY 1) t ON t.k = upper(regexp_replace(p.\"物料编码\", '[\\s\\-_]', '', 'g'))")
def _(T):
    s, t = T("purchase_orders").select("row_id", c("物料编码").alias("编码")), T("logistics_fulfillment").select("row_id", c("产品编码").alias("编码"))
    assert ln.same_name_columns(s.columns, t.columns) == ["row_id", "编码"]
    return ln.same_name_join(s, "row_id", t, "row_id", "编码")


@q("joi_04_alternate_key", "SELECT DISTINCT p.id AS source, t.target FROM (SELECT id, upper(regexp_replace(trim(unnest(regexp_split_to_array(array_to_string(linked_entities, '、'), '[,，、;；|]'))), '[\\s\\-_]', '', 'g')) AS k FROM a) p JOIN (SELECT upper(regexp_replace(name_cn, '[\\s\\-_]', '', 'g')) AS k, max(id) AS target FROM v GROUP BY 1) t ON t.k = p.k WHERE length(p.k) >= 3")
def _(T):
    cells = T("a").select("id", F.array_join("linked_entities", "、").alias("cell"))
    return ln.alternate_key_join(cells, "id", "cell", T("v"), "id", "name_cn")


@q("joi_05_link_mapping", "SELECT DISTINCT l.row_id AS source, p.row_id AS target FROM logistics_fulfillment l JOIN purchase_orders p ON trim(l.\"产品编码\") = trim(p.\"物料编码\")")
def _(T):
    s = T("logistics_fulfillment").select(c("row_id").alias("source"), F.trim("产品编码").alias("k"))
    t = T("purchase_orders").select(c("row_id").alias("target"), F.trim("物料编码").alias("k"))
    return s.join(t, "k").select("source", "target").distinct()


@q("joi_06_link_check", "SELECT count(*) AS matches FROM logistics_fulfillment WHERE trim(\"产品编码\") IN (SELECT trim(\"物料编码\") FROM purchase_orders)")
def _(T):
    return ln.link_check(T("logistics_fulfillment"), "产品编码", T("purchase_orders"), "物料编码")


@q("joi_07_isolated", "SELECT id FROM v WHERE id NOT IN (SELECT source_entity FROM e WHERE source_entity IS NOT NULL UNION ALL SELECT target_entity FROM e WHERE target_entity IS NOT NULL)")
def _(T):
    return g.isolated(T("v"), T("e")).select("id")


@q("joi_08_orphan_edges", "SELECT id FROM e WHERE source_entity IS NULL OR target_entity IS NULL OR source_entity NOT IN (SELECT id FROM v) OR target_entity NOT IN (SELECT id FROM v)")
def _(T):
    return g.orphan_edges(T("v"), T("e")).select("id")


@q("joi_09_inner_edges", "SELECT id FROM e WHERE source_entity IN (SELECT id FROM v WHERE type = '物料') AND target_entity IN (SELECT id FROM v WHERE type = '物料')")
def _(T):
    return g.inner_edges(T("v").filter("type = '物料'"), T("e")).select("id")


@q("joi_10_named_edges", "SELECT e.id AS id, s.name_cn AS source_name_cn, t.name_cn AS target_name_cn FROM e LEFT JOIN v s ON s.id = e.source_entity LEFT JOIN v t ON t.id = e.target_entity")
def _(T):
    return g.named_edges(T("v"), T("e")).select("id", "source_name_cn", "target_name_cn")


@q("joi_11_broken_lists", "SELECT id, list(ref ORDER BY i) AS broken FROM (SELECT id, unnest(linked_logic_ids) AS ref, generate_subscripts(linked_logic_ids, 1) AS i FROM a) WHERE ref IS NOT NULL AND ref NOT IN (SELECT id FROM r) GROUP BY id")
def _(T):
    return ln.broken_list_references(T("a"), "id", "linked_logic_ids", T("r").select("id"))


_PATTERNS = [("供应", "物料", "SUPPLIES"), ("客户", "单据", "PLACES")]


@q("joi_12_missing_relations", "SELECT s.id AS source, t.id AS target, p.rel AS relation FROM v s JOIN v t ON s.ontology_id = t.ontology_id AND s.id <> t.id JOIN (VALUES ('供应', '物料', 'SUPPLIES'), ('客户', '单据', 'PLACES')) p(sp, tp, rel) ON contains(s.type, sp) AND contains(t.type, tp) WHERE NOT EXISTS (SELECT 1 FROM e WHERE e.source_entity = s.id AND e.target_entity = t.id) ORDER BY 1, 2, 3 LIMIT 20")
def _(T):
    return ln.missing_relations(T("v"), T("e"), _PATTERNS, 20)


_KNOWN = "(SELECT name_cn AS k, min(id) AS id FROM v WHERE name_cn <> '' GROUP BY name_cn)"
_ASK = "(SELECT DISTINCT n AS name FROM (SELECT unnest(linked_entities) AS n FROM a) WHERE n <> '')"
_SHARE = "len(list_distinct(list_intersect(string_split(name, ''), string_split(k, ''))))"


@q("joi_13_fuzzy_names", f"SELECT name, id FROM {_ASK} JOIN {_KNOWN} ON name = k UNION ALL SELECT name, id FROM (SELECT name, k, id, {_SHARE} AS s FROM {_ASK} JOIN {_KNOWN} ON contains(name, k) OR contains(k, name)) WHERE name NOT IN (SELECT k FROM {_KNOWN}) QUALIFY row_number() OVER (PARTITION BY name ORDER BY s DESC, k DESC) = 1")
def _(T):
    asked = T("a").select(F.explode("linked_entities").alias("name"))
    return ln.resolve_names(asked, "name", T("v"), "name_cn", "id")


@q("joi_14_anchor_matching")
def _(T):
    v = latest(T("entities"), "ontology_id", "name_cn", "name_en", "type")
    return ln.anchor_matches(v.filter("ontology_id <> 'o-sup-00000'"), v.filter("ontology_id = 'o-sup-00000'"))


@q("joi_15_entity_instances", "SELECT v.id AS id, x.version AS version FROM v JOIN entities x ON x.id = v.id")
def _(T):
    return T("v").select("id").join(T("entities").select("id", "version"), "id").orderBy("id", "version")


@q("joi_16_explode_with_fallback", "SELECT a.id AS id, x.ref AS ref, r.id AS rule FROM a LEFT JOIN LATERAL (SELECT unnest(a.linked_logic_ids) AS ref) x ON true LEFT JOIN r ON r.id = x.ref")
def _(T):
    return catalog.with_references(T("a"), "id", "linked_logic_ids", T("r"), "id", "rule")


@q("joi_17_dataset_pairs", "SELECT a AS source, b AS target FROM (VALUES ('customer'), ('orders'), ('nation')) x(a), (VALUES ('customer'), ('orders'), ('nation')) y(b) WHERE a <> b")
def _(T):
    names = ["customer", "orders", "nation"]  # configuration, not data
    return T("region").sparkSession.createDataFrame(catalog.ordered_pairs(names), "source string, target string")


@q("joi_18_edit_overlay", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN 'X' ELSE c_mktsegment END AS c_mktsegment FROM customer")
def _(T):
    cu = T("customer").select("c_custkey", "c_mktsegment")
    edits = cu.filter("c_custkey % 4 = 0").select(c("c_custkey").cast("string").alias("row_pk"), F.lit("c_mktsegment").alias("field_name"), F.lit("X").alias("new_value"), F.lit(1).alias("seq"))
    return p.apply_edits(cu, "c_custkey", edits, ["c_mktsegment"])


@q("joi_19_endpoint_existence", "SELECT id FROM e WHERE source_entity IN (SELECT id FROM v) AND target_entity IN (SELECT id FROM v)")
def _(T):
    return g.inner_edges(T("v"), T("e")).select("id")


@q("joi_20_declared_links", "SELECT l_orderkey, l_linenumber, p_name, s_name FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey")
def _(T):
    out = T("lineitem")
    for fk, table, pk in (("l_partkey", "part", "p_partkey"), ("l_suppkey", "supplier", "s_suppkey")):
        out = out.join(T(table), c(fk) == c(pk))
    return out.select("l_orderkey", "l_linenumber", "p_name", "s_name")


_KEPT = "(SELECT list(id) FROM r WHERE status = 'active')"


@q("joi_21_lineage_retention", f"SELECT id FROM a WHERE list_has_any(linked_logic_ids, {_KEPT})")
def _(T):
    return catalog.retained(T("a"), "id", "linked_logic_ids", T("r").filter("status = 'active'"), "id").select("id")


@q("joi_22_orphan_datasets", "SELECT DISTINCT ontology_id FROM entities WHERE ontology_id NOT IN (SELECT ontology_id FROM uploaded_files WHERE file_size > 0 AND converted_md <> '')")
def _(T):
    return catalog.without_live(T("entities"), "ontology_id", T("uploaded_files").filter("file_size > 0 and converted_md <> ''"))


@q("agg_01_counts", "SELECT (SELECT count(DISTINCT ontology_id) FROM v) AS ontologies, (SELECT count(*) FROM v) AS entities, (SELECT count(*) FROM r) AS rules, (SELECT count(*) FROM a) AS actions")
def _(T):
    one = T("v").agg(F.count_distinct("ontology_id").alias("ontologies"), F.count("*").alias("entities"))
    for n, a in (("r", "rules"), ("a", "actions")):
        one = one.crossJoin(F.broadcast(T(n).agg(F.count("*").alias(a))))  # single rows
    return one


@q("agg_02_group_counts", "SELECT type, status, n FROM (SELECT type, NULL AS status, count(*) AS n FROM v WHERE type IS NOT NULL GROUP BY type UNION ALL SELECT NULL, status, count(*) FROM r WHERE status IS NOT NULL GROUP BY status)")
def _(T):
    a = T("v").filter("type is not null").groupBy("type").agg(F.count("*").alias("n")).withColumn("status", F.lit(None).cast("string"))
    return a.unionByName(T("r").filter("status is not null").groupBy("status").agg(F.count("*").alias("n")).withColumn("type", F.lit(None).cast("string")))


@q("agg_03_parent_counts", "SELECT p.ontology_id AS ontology_id, count(r.id) AS rules FROM (SELECT ontology_id, max(created_at) AS m FROM v GROUP BY ontology_id ORDER BY m DESC, ontology_id LIMIT 6) p LEFT JOIN r ON r.ontology_id = p.ontology_id GROUP BY p.ontology_id")
def _(T):
    return catalog.child_counts(catalog.latest(T("v"), "ontology_id", "created_at", 6), "ontology_id", rules=T("r")).drop("created_at")


@q("agg_04_page_counts", "SELECT o.ontology_id AS ontology_id, o.n AS entity_count, coalesce(x.n, 0) AS relation_count FROM (SELECT ontology_id, count(*) AS n FROM v GROUP BY 1) o LEFT JOIN (SELECT ontology_id, count(*) AS n FROM e GROUP BY 1) x ON x.ontology_id = o.ontology_id ORDER BY 1 LIMIT 3")
def _(T):
    counts = catalog.child_counts(T("v").select("ontology_id").distinct(), "ontology_id", entity_count=T("v"), relation_count=T("e"))
    return catalog.page(counts, ["ontology_id"], 3)


@q("agg_05_type_histogram", "SELECT 'node' AS kind, coalesce(type, 'Entity') AS type, count(*) AS n FROM v GROUP BY 2 UNION ALL SELECT 'edge', coalesce(type, 'RELATED'), count(*) FROM e GROUP BY 2")
def _(T):
    h = lambda t, kind, default: T(t).groupBy(F.coalesce("type", F.lit(default)).alias("type")).agg(F.count("*").alias("n")).select(F.lit(kind).alias("kind"), "type", "n")
    return h("v", "node", "Entity").unionByName(h("e", "edge", "RELATED"))


@q("agg_06_duplicate_names", "SELECT name_cn, count(*) AS n FROM v GROUP BY name_cn HAVING count(*) > 1")
def _(T):
    return T("v").groupBy("name_cn").agg(F.count("*").alias("n")).filter("n > 1")


_GQ = """WITH x AS (SELECT (SELECT count(*) FROM v) AS nodes, (SELECT count(*) FROM e) AS edges,
(SELECT count(*) FROM v WHERE id NOT IN (SELECT source_entity FROM e WHERE source_entity IS NOT NULL UNION ALL SELECT target_entity FROM e WHERE target_entity IS NOT NULL)) AS isolated,
(SELECT coalesce(sum(k), 0) FROM (SELECT count(*) AS k FROM v GROUP BY name_cn HAVING count(*) > 1)) AS duplicate_names,
(SELECT count(*) FROM e WHERE source_entity IS NULL OR target_entity IS NULL OR source_entity NOT IN (SELECT id FROM v) OR target_entity NOT IN (SELECT id FROM v)) AS orphans)
SELECT *, round(greatest(0, 1 - least(0.4, isolated / nodes * 0.4) - least(0.25, duplicate_names / nodes * 0.25) - least(0.25, orphans / edges * 0.25)), 4) AS quality, round(edges / nodes, 4) AS density FROM x"""


@q("agg_07_graph_quality", _GQ)
def _(T):
    return g.quality(T("v"), T("e"))


@q("agg_08_summary", "SELECT ontology_id, count(*) AS entities, (SELECT count(*) FROM e WHERE e.ontology_id = v.ontology_id) AS relations, round((SELECT count(*) FROM e WHERE e.ontology_id = v.ontology_id) / (count(*) * (count(*) - 1)), 4) AS density, count(*) FILTER (WHERE id NOT IN (SELECT source_entity FROM e WHERE source_entity IS NOT NULL UNION ALL SELECT target_entity FROM e WHERE target_entity IS NOT NULL)) AS isolated FROM v GROUP BY ontology_id")
def _(T):
    return g_summary(T("v"), T("e"))


def g_summary(v, e):
    from tributary.operators.audit import summary

    return summary(v, e)


@q("agg_09_coverage", "SELECT type, count(*) AS total, round(avg((id IN (SELECT source_entity FROM e WHERE source_entity IS NOT NULL UNION ALL SELECT target_entity FROM e WHERE target_entity IS NOT NULL))::INT), 2) AS coverage FROM v GROUP BY type HAVING avg((id IN (SELECT source_entity FROM e WHERE source_entity IS NOT NULL UNION ALL SELECT target_entity FROM e WHERE target_entity IS NOT NULL))::INT) < 0.999")
def _(T):
    from tributary.operators.audit import coverage

    return coverage(T("v"), T("e"), 0.999).select("type", "total", "coverage")


_ENDS = "(SELECT source_entity AS id, id AS edge, 1 AS o FROM e UNION ALL SELECT target_entity, id, 0 FROM e)"


@q("agg_10_degree", f"SELECT v.id AS id, count(DISTINCT edge) FILTER (WHERE o = 0) AS in_degree, count(DISTINCT edge) FILTER (WHERE o = 1) AS out_degree, count(DISTINCT edge) AS degree FROM v LEFT JOIN {_ENDS} x ON x.id = v.id GROUP BY v.id")
def _(T):
    return g.degrees(T("v"), T("e"))


@q("agg_11_top_connected", f"SELECT v.id AS id, name_cn, count(*) AS degree FROM v JOIN {_ENDS} x ON x.id = v.id GROUP BY v.id, name_cn ORDER BY degree DESC, v.id LIMIT 10")
def _(T):
    return g.top_connected(T("v"), T("e"))


@q("agg_12_cardinality", "SELECT CASE WHEN count(DISTINCT o_orderkey) = count(*) AND count(DISTINCT o_custkey) = count(*) THEN 'one_to_one' WHEN count(DISTINCT o_orderkey) = count(*) THEN 'many_to_one' WHEN count(DISTINCT o_custkey) = count(*) THEN 'one_to_many' ELSE 'many_to_many' END AS cardinality FROM orders")
def _(T):
    return ln.cardinality(T("orders"), "o_orderkey", "o_custkey")


@q("agg_13_collapsed_rows", "SELECT \"订单号\" AS k, arg_min(\"供应商\", row_id) AS supplier, count(*) AS source_row_count FROM (SELECT *, coalesce(\"供应商\", '') AS z FROM purchase_orders WHERE \"供应商\" IS NOT NULL) GROUP BY 1")
def _(T):
    po = T("purchase_orders").filter(c("供应商").isNotNull()).select(F.coalesce("订单号", F.lit("\0")).alias("k"), c("供应商").alias("supplier"), "row_id")
    return catalog.collapsed(po, "k", ["supplier"], ["row_id"]).withColumn("k", F.nullif("k", F.lit("\0")))


@q("agg_14_states", "SELECT feed, list_sort(list(DISTINCT trim(\"状态\")) FILTER (WHERE trim(\"状态\") <> '')) AS states FROM purchase_orders GROUP BY feed")
def _(T):
    return T("purchase_orders").groupBy("feed").agg(F.array_sort(F.collect_set(F.when(F.trim("状态") != "", F.trim("状态")))).alias("states"))


_C = ["供应商类别", "物料名称", "质检结果", "采购员"]


@q("agg_15_missing_counts", "SELECT " + ", ".join(f"count(*) FILTER (WHERE \"{x}\" IS NULL OR \"{x}\" = '') AS \"{x}\"" for x in _C) + " FROM purchase_orders")
def _(T):
    return T("purchase_orders").agg(*[F.sum((c(x).isNull() | (c(x) == "")).cast("int")).alias(x) for x in _C])


@q("agg_16_null_rates", "SELECT " + ", ".join(f"round(avg((\"{x}\" IS NULL OR \"{x}\" = '')::INT), 4) AS \"{x}\"" for x in _C) + " FROM purchase_orders")
def _(T):
    return T("purchase_orders").agg(*[F.round(F.avg((c(x).isNull() | (c(x) == "")).cast("int")), 4).alias(x) for x in _C])


@q("agg_17_null_pct", "SELECT round(avg((description IS NULL)::INT) * 100, 2) AS null_pct, arg_min(description, id) FILTER (WHERE description IS NOT NULL) AS sample FROM v")
def _(T):
    return T("v").agg(F.round(F.avg(c("description").isNull().cast("int")) * 100, 2).alias("null_pct"), F.min_by("description", F.when(c("description").isNotNull(), c("id"))).alias("sample"))


@q("agg_18_reconciliation", "SELECT coalesce(x.ontology_id, y.ontology_id) AS ontology_id, x.n AS n_entities, y.n AS n_versions FROM (SELECT ontology_id, count(*) AS n FROM v GROUP BY 1) x FULL JOIN (SELECT ontology_id, count(*) AS n FROM entities GROUP BY 1) y ON x.ontology_id = y.ontology_id WHERE x.n IS DISTINCT FROM y.n")
def _(T):
    return catalog.reconciled(T("v"), T("entities"), "ontology_id", ("n_entities", "n_versions"))


@q("agg_19_edge_patterns", "SELECT s.type AS source_type, e.type AS type, t.type AS target_type, count(*) AS n FROM e JOIN v s ON s.id = e.source_entity JOIN v t ON t.id = e.target_entity GROUP BY ALL")
def _(T):
    return g.named_edges(T("v"), T("e"), ("id", "type")).filter("source_id is not null and target_id is not null").groupBy("source_type", "type", "target_type").agg(F.count("*").alias("n"))


@q("agg_20_common_prefix", "SELECT prefix FROM (SELECT regexp_extract(\"物料编码\", '^([A-Za-z]+)', 1) AS prefix, count(*) AS n FROM purchase_orders GROUP BY 1) ORDER BY n DESC, prefix LIMIT 1")
def _(T):
    return T("purchase_orders").groupBy(F.regexp_extract("物料编码", "^([A-Za-z]+)", 1).alias("prefix")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "prefix").limit(1).select("prefix")


@q("agg_21_unknown_ratio", "SELECT avg((type IS NULL)::INT) AS ratio, avg((type IS NULL)::INT) > 0.5 AS warn FROM v")
def _(T):
    r = F.avg(c("type").isNull().cast("int"))
    return T("v").agg(r.alias("ratio"), (r > 0.5).alias("warn"))


@q("agg_22_sparsity", _GQ.replace("SELECT *, round(greatest", "SELECT edges < greatest(5, 0.8 * nodes) OR isolated > greatest(2, 0.25 * nodes) AND nodes >= 5 AS sparse FROM x --").replace("\nSELECT edges", " SELECT edges").split(" --")[0])
def _(T):
    x = g.quality(T("v"), T("e"))
    return x.select(((c("edges") < F.greatest(F.lit(5), 0.8 * c("nodes"))) | ((c("isolated") > F.greatest(F.lit(2), 0.25 * c("nodes"))) & (c("nodes") >= 5))).alias("sparse"))


@q("agg_23_issues_by_severity", "SELECT CASE WHEN confidence IS NULL THEN 'error' WHEN confidence < 0.5 THEN 'warning' ELSE 'info' END AS severity, count(*) AS n FROM v GROUP BY 1")
def _(T):
    sev = F.when(c("confidence").isNull(), "error").when(c("confidence") < 0.5, "warning").otherwise("info")
    return T("v").groupBy(sev.alias("severity")).agg(F.count("*").alias("n"))


@q("agg_24_distinct", "SELECT DISTINCT l_shipdate, l_returnflag FROM lineitem")
def _(T):
    return T("lineitem").select("l_shipdate", "l_returnflag").distinct()


@q("agg_25_keep_first", "SELECT name_cn, arg_min(id, created_at) AS id FROM v WHERE name_cn <> '' GROUP BY name_cn")
def _(T):
    return catalog.keep_first(T("v").filter("name_cn <> ''").select("name_cn", "id", "created_at"), ["name_cn"], ["created_at"]).select("name_cn", "id")


_RICH = "coalesce(length(description), 0) + coalesce(length(name_en), 0)"


@q("agg_26_keep_richest", f"SELECT name_cn, id FROM v WHERE name_cn <> '' QUALIFY row_number() OVER (PARTITION BY name_cn ORDER BY {_RICH} DESC, created_at, id) = 1")
def _(T):
    from tributary.operators.merge import keep_richest

    return keep_richest(T("v").filter("name_cn <> ''"), ["name_cn"], ["description", "name_en"], ["created_at", "id"]).select("name_cn", "id")


_SIZE = "(coalesce(length({0}.n), 0) + coalesce(length({0}.d), 0) + coalesce(length({0}.t), 0))"
_FILL = ", ".join(f"{x} := coalesce(nullif(acc.{x}, ''), CASE WHEN {_SIZE.format('x')} > {_SIZE.format('acc')} THEN x.{x} END)" for x in "ndt")


@q("agg_27_fill_blanks_of_first", f"SELECT name_cn, m.n AS name_en, m.d AS description, m.t AS type FROM (SELECT name_cn, list_reduce(list(struct_pack(n := name_en, d := description, t := type) ORDER BY created_at NULLS FIRST, id), lambda acc, x: struct_pack({_FILL})) AS m FROM v WHERE name_cn <> '' GROUP BY name_cn)")
def _(T):
    from tributary.operators.merge import fold_richer

    return fold_richer(T("v").filter("name_cn <> ''"), "name_cn", ["name_en", "description", "type"], ["created_at", "id"])


@q("agg_28_route_score", "SELECT round(1.0 * 0.4 + (count(trim_a) + count(trim_b)) / (2 * count(*)) * 0.6, 3) AS score FROM (SELECT nullif(trim(\"质检结果\"), '') AS trim_a, nullif(trim(\"供应商\"), '') AS trim_b FROM purchase_orders)")
def _(T):
    return p.route_score(T("purchase_orders"), ["质检结果", "供应商"])


@q("grf_01_subgraph", "SELECT id FROM e WHERE source_entity IN (SELECT id FROM v WHERE ontology_id = 'o-hr-00003') AND target_entity IN (SELECT id FROM v WHERE ontology_id = 'o-hr-00003')")
def _(T):
    return g.inner_edges(T("v").filter("ontology_id = 'o-hr-00003'"), T("e")).select("id")


_UND = "u AS (SELECT source_entity AS a, target_entity AS b FROM e WHERE source_entity <> target_entity UNION SELECT target_entity, source_entity FROM e WHERE source_entity <> target_entity)"


@q("grf_02_neighbours", f"WITH RECURSIVE {_UND}, w AS (SELECT 'e-sup-000000590' AS id, 0 AS hops UNION SELECT u.b, w.hops + 1 FROM w JOIN u ON u.a = w.id WHERE w.hops < 3) SELECT id, min(hops) AS hops FROM w GROUP BY id")
def _(T):
    e = T("e")
    return g.neighbourhood(e, e.sparkSession.createDataFrame([("e-sup-000000590",)], "id string"), 3)


@q("grf_03_distances", f"WITH RECURSIVE {_UND}, w AS (SELECT 'e-sup-000000590' AS id, 0 AS hops UNION SELECT u.b, w.hops + 1 FROM w JOIN u ON u.a = w.id WHERE w.hops < 12) SELECT id, min(hops) AS hops FROM w GROUP BY id")
def _(T):
    e = T("e")
    return g.distances(e, e.sparkSession.createDataFrame([("e-sup-000000590",)], "id string")).select("id", "hops")


@q("grf_04_degree_by_type", f"SELECT type, count(*) AS ends FROM v JOIN {_ENDS} x ON x.id = v.id GROUP BY type")
def _(T):
    return T("v").select("id", "type").join(g.endpoints(T("e")), "id").groupBy("type").agg(F.count("*").alias("ends"))


@q("grf_05_match", "SELECT id, name_cn FROM v WHERE type = '指标' AND ontology_id = 'o-fin-00002'")
def _(T):
    return T("v").filter("type = '指标' and ontology_id = 'o-fin-00002'").select("id", "name_cn")


@q("grf_06_guarded_query", "SELECT type, count(*) AS n FROM e WHERE ontology_id = 'o-med-00001' GROUP BY type")
def _(T):
    e = T("e")
    return g.guarded_query(e.sparkSession, "SELECT type, count(*) AS n FROM edges WHERE ontology_id = 'o-med-00001' GROUP BY type", {"edges": e})


@q("grf_07_question", "SELECT id FROM v ORDER BY id LIMIT 50")
def _(T):
    return g.ask("系统里有哪些供应商", T("v"), T("e"))[0].select("id")


@q("grf_08_hide_isolated", "SELECT id FROM v WHERE id IN (SELECT source_entity FROM e UNION SELECT target_entity FROM e)")
def _(T):
    return T("v").join(g.endpoints(T("e")), "id", "left_semi").select("id")


@q("grf_09_sanitise", "SELECT id FROM e WHERE source_entity <> target_entity AND source_entity IN (SELECT id FROM v) AND target_entity IN (SELECT id FROM v)")
def _(T):
    return g.sanitise(T("v"), T("e"))[1].select("id")


@q("grf_10_layout", "SELECT ontology_id, count(*) AS n FROM e GROUP BY ontology_id")
def _(T):
    return T("e").repartition("ontology_id").groupBy("ontology_id").agg(F.count("*").alias("n"))


@q("grf_11_decay", "SELECT type, round(sum(confidence * pow(0.95, date_diff('day', CAST(created_at AS DATE), DATE '2027-01-01') / 7)), 6) AS weight FROM e GROUP BY type")
def _(T):
    return g.decayed_weights(T("e"), "created_at", "confidence", "2027-01-01", ["type"]).select("type", F.round("weight", 6).alias("weight"))


@q("grf_12_co_occurrence", "WITH x AS (SELECT DISTINCT l_orderkey AS s, l_returnflag || l_linestatus AS c FROM lineitem), n AS (SELECT c, count(*) AS n FROM x GROUP BY c) SELECT p.c AS a, o.c AS b, count(*) AS together, count(*) / any_value(n.n) AS share_of_a FROM x p JOIN x o ON p.s = o.s AND p.c <> o.c JOIN n ON n.c = p.c GROUP BY 1, 2")
def _(T):
    return g.co_occurrence(T("lineitem").withColumn("c", F.concat("l_returnflag", "l_linestatus")), "l_orderkey", "c")
