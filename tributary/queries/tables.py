"""Queries of generic transforms, cleansing, profiling, review edits, ordering and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.operators import catalog
from tributary.operators import cleansing as k
from tributary.operators import profiling as p
from tributary.operators.column_profile import COLUMNS
from tributary.queries.registry import Registry

q = Registry()
c = F.col
PO = ["订单号", "供应商", "单位", "数量", "状态", "质检结果"]
PO_SQL = ", ".join(f'"{x}"' for x in PO)


@q("prj_01_rename_columns", "SELECT n_nationkey AS id, n_name AS name, n_regionkey FROM nation")
def _(T):
    return k.rename_columns(T("nation"), {"n_nationkey": "id", "n_name": "name"})


@q("prj_02_select_columns", "SELECT s_name, s_acctbal FROM supplier")
def _(T):
    return k.select_columns(T("supplier"), ["s_name", "missing", "s_acctbal"])


@q("prj_03_filter_rows", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'")
def _(T):
    return k.filter_rows(T("lineitem"), "l_quantity > 45 AND l_returnflag = 'R'").select("l_orderkey", "l_linenumber", "l_quantity")


@q("prj_04_sort", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def _(T):
    return k.sort(T("customer").select("c_custkey", "c_acctbal"), ["c_acctbal", "c_custkey"], [False, True])


@q("prj_05_join", "SELECT o_orderkey, c_name FROM orders JOIN customer ON o_custkey = c_custkey")
def _(T):
    return T("orders").join(T("customer"), c("o_custkey") == c("c_custkey")).select("o_orderkey", "c_name")


@q("prj_06_aggregate", "SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS qty, avg(l_discount) AS disc FROM lineitem GROUP BY ALL")
def _(T):
    return k.aggregate(T("lineitem"), ["l_returnflag", "l_linestatus"], {"n": ("count", "l_orderkey"), "qty": ("sum", "l_quantity"), "disc": ("avg", "l_discount")})


@q("prj_07_pivot", "SELECT l_returnflag, sum(l_quantity) FILTER (WHERE l_linestatus = 'O') AS \"O\", sum(l_quantity) FILTER (WHERE l_linestatus = 'F') AS \"F\" FROM lineitem GROUP BY l_returnflag")
def _(T):
    return k.pivot(T("lineitem"), ["l_returnflag"], "l_linestatus", ["O", "F"], "l_quantity")


_FILL = ", ".join(f"CASE WHEN \"{x}\" IS NULL OR trim(\"{x}\") = '' THEN '' ELSE \"{x}\" END AS \"{x}\"" for x in PO)


@q("prj_08_cleansing_ops", f"SELECT row_id, {_FILL} FROM purchase_orders")
def _(T):
    return k.fill_nulls(T("purchase_orders").select("row_id", *PO))


@q("prj_09_parse_json", "SELECT event_id, CAST(props::JSON->>'k' AS BIGINT) AS k FROM events")
def _(T):
    return T("events").select("event_id", F.from_json("props", "k long")["k"].alias("k"))


@q("prj_10_parse_xml", "SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) AS id, n_name AS title FROM nation")
def _(T):
    doc = F.concat(F.lit("<list><item id='"), c("n_nationkey").cast("string"), F.lit("'><title>"), "n_name", F.lit("</title></item></list>"))
    return k.xml_records(T("nation").select("n_nationkey", doc.alias("doc")), "doc", "item", "id: string, title: string", ["n_nationkey"])


@q("prj_11_wide_table_ops", "SELECT DISTINCT p_brand, p_type FROM part")
def _(T):
    parts = T("part")
    assert not k.detect_wide(parts)
    return k.apply_split(parts, {"kinds": ["p_brand", "p_type"]})["kinds"]


@q("prj_13_project_properties", "SELECT s_suppkey AS supplier_id, s_name AS display_name FROM supplier")
def _(T):
    shown = {"s_suppkey": "supplier_id", "s_name": "display_name"}
    return T("supplier").select(*[c(a).alias(b) for a, b in shown.items()])


@q("prj_15_preview_step", "SELECT n_nationkey, trim(n_name) AS n_name, n_regionkey FROM nation WHERE n_nationkey IN (SELECT n_nationkey FROM nation ORDER BY n_nationkey LIMIT 20)")
def _(T):
    return k.trim_strings(T("nation").orderBy("n_nationkey").limit(20))


@q("prd_01_equality", "SELECT id FROM v WHERE ontology_id = 'o-sup-00000' AND type = '物料'")
def _(T):
    return T("v").filter((c("ontology_id") == "o-sup-00000") & (c("type") == "物料")).select("id")


@q("prd_02_substring", "SELECT id FROM v WHERE name_cn ILIKE '%textiles%' OR id ILIKE '%SUP-0000001%'")
def _(T):
    return T("v").filter(c("name_cn").ilike("%textiles%") | c("id").ilike("%SUP-0000001%")).select("id")


@q("prd_03_multi_column", "SELECT id FROM v WHERE name_cn ILIKE '%采购%' OR name_en ILIKE '%采购%' OR description ILIKE '%采购%' OR CAST(to_json(properties) AS VARCHAR) ILIKE '%采购%'")
def _(T):
    hit = F.lit(False)
    for x in (c("name_cn"), c("name_en"), c("description"), F.to_json("properties")):
        hit = hit | F.coalesce(x.ilike("%采购%"), F.lit(False))
    return T("v").filter(hit).select("id")


@q("prd_04_in_list", "SELECT id FROM e WHERE type IN ('提供', '存储于')")
def _(T):
    return T("e").filter(c("type").isin("提供", "存储于")).select("id")


@q("prd_05_prefix", "SELECT id FROM v WHERE name_cn LIKE '临时%'")
def _(T):
    return T("v").filter(c("name_cn").startswith("临时")).select("id")


@q("prd_06_entity_filter", "SELECT id FROM v WHERE (lower(name_cn) LIKE '%评分%' OR lower(coalesce(name_en, '')) LIKE '%评分%' OR lower(coalesce(type, '')) LIKE '%评分%') AND type = '物料'")
def _(T):
    low = lambda x: F.lower(F.coalesce(c(x), F.lit(""))).contains("评分")
    return T("v").filter((low("name_cn") | low("name_en") | low("type")) & (c("type") == "物料")).select("id")


@q("prd_07_rule_filter", "SELECT id FROM r WHERE lower(coalesce(name_cn, '')) LIKE '%stock%' OR lower(coalesce(description, '')) LIKE '%stock%' OR lower(coalesce(formula, '')) LIKE '%stock%'")
def _(T):
    low = lambda x: F.lower(F.coalesce(c(x), F.lit(""))).contains("stock")
    return T("r").filter(low("name_cn") | low("description") | low("formula")).select("id")


@q("cln_01_jagged_filter", "SELECT event_id FROM events WHERE event_id % 3 <> 0")
def _(T):
    raw = F.when(c("event_id") % 3 == 0, F.to_json(F.struct("event_id"))).otherwise(F.to_json(F.struct("event_id", "user_id")))
    return k.jagged_filter(T("events").select("event_id", raw.alias("raw")), "raw", ["event_id", "user_id"]).select("event_id")


@q("cln_02_drop_nulls", f"SELECT row_id, {PO_SQL} FROM purchase_orders WHERE " + " AND ".join(f"trim(\"{x}\") <> ''" for x in PO))
def _(T):
    return k.drop_nulls(T("purchase_orders").select("row_id", *PO))


@q("cln_02_mark_nulls", "SELECT row_id, CASE WHEN \"质检结果\" IS NULL OR trim(\"质检结果\") = '' THEN '' ELSE \"质检结果\" END AS \"质检结果\", CASE WHEN \"质检结果\" IS NULL OR trim(\"质检结果\") = '' THEN '1' END AS \"__null_质检结果__\" FROM purchase_orders")
def _(T):
    return k.mark_nulls(T("purchase_orders").select("row_id", "质检结果"))


@q("cln_03_trim", "SELECT row_id, trim(\"供应商\") AS \"供应商\" FROM purchase_orders")
def _(T):
    return k.trim_strings(T("purchase_orders").select("row_id", "供应商"))


@q("cln_04_dedup", f"SELECT DISTINCT {PO_SQL} FROM purchase_orders")
def _(T):
    return k.drop_duplicates(T("purchase_orders").select(*PO))


_D = "\"下单日期\""


@q("cln_05_dates", f"SELECT row_id, CASE WHEN regexp_full_match(trim({_D}), '[0-9]{{4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,2}}') AND TRY_CAST(replace(trim({_D}), '/', '-') AS DATE) IS NOT NULL THEN strftime(TRY_CAST(replace(trim({_D}), '/', '-') AS DATE), '%Y-%m-%d') ELSE trim({_D}) END AS d FROM purchase_orders")
def _(T):
    return T("purchase_orders").select("row_id", k.iso_date(c("下单日期")).alias("d"))


@q("cln_05_dates_compat", "SELECT o_orderkey, year(o_orderdate) || '-' || month(o_orderdate) || '-' || day(o_orderdate) AS d FROM orders")
def _(T):
    return T("orders").select("o_orderkey", k.iso_date(F.date_format("o_orderdate", "yyyyMMdd"), compat=True).alias("d"))


@q("cln_06_metrics", "SELECT count(*) AS rows_before, sum((\"质检结果\" IS NULL OR trim(\"质检结果\") = '')::INT) AS null_cells, count(DISTINCT coalesce(nullif(trim(\"质检结果\"), ''), '')) AS rows_after FROM purchase_orders")
def _(T):
    df = T("purchase_orders").select("质检结果")
    after = k.cleanse(df).agg(F.count("*").alias("rows_after"))
    before = df.agg(F.count("*").alias("rows_before"), F.sum(k.is_blank(c("质检结果")).cast("int")).alias("null_cells"))
    return before.crossJoin(F.broadcast(after))  # two single rows


@q("cln_07_control_characters", "SELECT row_id, regexp_replace(\"部门\", '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]', '', 'g') AS d FROM retention_risk")
def _(T):
    from tributary.functions.text import strip_control

    return T("retention_risk").select("row_id", strip_control(c("部门")).alias("d"))


_NUM = "regexp_full_match(x, '[+-]?[0-9]+')"
_FLT = "regexp_full_match(x, '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?')"
_CELLS = " UNION ALL ".join(f"SELECT '{x}' AS column_name, \"{x}\" AS value FROM purchase_orders" for x in COLUMNS)


@q("prf_01_schema_vote", f"""WITH u AS (SELECT column_name, trim(value) AS t FROM ({_CELLS}) WHERE trim(value) <> ''),
w AS (SELECT column_name, t, replace(t, ',', '') AS x FROM u),
k AS (SELECT column_name, CASE WHEN lower(t) IN ('none','null','nan') THEN 'null' WHEN regexp_matches(t, '^[0-9]{{4}}[-/][0-9]{{1,2}}[-/][0-9]{{1,2}}|^[0-9]{{1,2}}[-/][0-9]{{1,2}}[-/][0-9]{{4}}|^[0-9]{{8}}$') THEN 'timestamp' WHEN lower(t) IN ('true','false','yes','no','1','0') THEN 'boolean' WHEN {_NUM} THEN 'integer' WHEN {_FLT} THEN 'float' ELSE 'string' END AS type FROM w),
n AS (SELECT column_name, type, count(*) AS n, list_position(['timestamp','integer','float','boolean','string','null'], type) AS p FROM k GROUP BY ALL)
SELECT column_name, type FROM n QUALIFY row_number() OVER (PARTITION BY column_name ORDER BY n DESC, p) = 1""")
def _(T):
    return p.schema_vote(T("purchase_orders"), COLUMNS)


_KIND = f"CASE WHEN {_NUM} THEN 'integer' WHEN {_FLT} THEN 'float' WHEN lower(x) IN ('true','false') THEN 'boolean' ELSE 'string' END"
_REPORT = f"""WITH u AS (SELECT column_name, value, nullif(trim(value), '') AS x FROM ({_CELLS})),
s AS (SELECT column_name, count(*) AS rows, count(*) - count(x) AS null_count, count(DISTINCT CASE WHEN x IS NOT NULL THEN value END) AS distinct_count, list_distinct(list(CASE WHEN x IS NOT NULL THEN {_KIND} END) FILTER (WHERE x IS NOT NULL)) AS kinds FROM u GROUP BY column_name),
rep AS (SELECT column_name, rows, null_count, round(null_count * 100 / rows, 2) AS null_pct, distinct_count, CASE WHEN coalesce(len(kinds), 0) = 0 THEN 'null' WHEN len(kinds) = 1 THEN kinds[1] WHEN len(kinds) = 2 AND list_contains(kinds, 'integer') AND list_contains(kinds, 'float') THEN 'float' ELSE 'mixed' END AS type FROM s)"""


@q("prf_02_quality_type", _REPORT + " SELECT column_name, type FROM rep")
def _(T):
    return p.column_report(T("purchase_orders"), COLUMNS).select("column_name", "type")


@q("qlt_02_column_report", _REPORT + " SELECT *, null_pct > 50 AS issue FROM rep")
def _(T):
    return p.column_report(T("purchase_orders"), COLUMNS)


_DUP = "(SELECT count(*) FROM purchase_orders) - (SELECT count(*) FROM (SELECT DISTINCT " + ", ".join(f'"{x}"' for x in COLUMNS) + " FROM purchase_orders))"


@q("qlt_01_quality_report", _REPORT + f""", t AS (SELECT 1 - avg(null_count * 100 / rows) / 100 AS a, 1 - ({_DUP}) / max(rows) AS b, 1 - sum((type = 'mixed')::INT) / {len(COLUMNS)} AS v FROM rep)
SELECT round(a, 3) AS completeness, round(b, 3) AS uniqueness, round(v, 3) AS validity, round(0.4 * a + 0.4 * b + 0.2 * v, 3) AS overall, {_DUP} AS duplicates FROM t""")
def _(T):
    return p.quality_report(T("purchase_orders"), COLUMNS)


@q("qlt_03_duplicates", f"SELECT {_DUP} AS duplicates")
def _(T):
    return p.duplicate_count(T("purchase_orders").select(*COLUMNS))


_LONG3 = lambda table, cols: " UNION ALL ".join(f"SELECT '{x}' AS column_name, CAST({x} AS VARCHAR) AS value, {cols[0]} AS o FROM {table}" for x in cols)


@q("prf_03_property_type", f"SELECT column_name, CASE WHEN {_NUM} THEN 'integer' WHEN {_FLT} THEN 'float' WHEN lower(x) IN ('true','false') THEN 'boolean' ELSE 'string' END AS type FROM (SELECT column_name, arg_min(trim(value), o) AS x FROM ({_LONG3('customer', ['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment'])}) WHERE trim(value) <> '' AND column_name <> 'c_custkey' GROUP BY column_name)")
def _(T):
    df = T("customer")
    return p.first_type(df, df.columns, "c_custkey").select("column_name", "type")


@q("prf_04_dataset_schema", f"SELECT column_name, arg_min(value, o) AS example, CASE WHEN regexp_full_match(arg_min(value, o), '[+-]?[0-9]+') THEN 'integer' WHEN regexp_full_match(arg_min(value, o), '[+-]?[0-9]+[.][0-9]*') THEN 'float' ELSE 'string' END AS type FROM ({_LONG3('supplier', ['s_suppkey', 's_name', 's_nationkey'])}) WHERE column_name <> 's_suppkey' GROUP BY column_name")
def _(T):
    return p.first_type(T("supplier"), ["s_suppkey", "s_name", "s_nationkey"], "s_suppkey")


@q("prf_05_name_type", "SELECT * FROM (VALUES ('o_orderdate','datetime'), ('l_quantity','integer'), ('p_retailprice','float'), ('is_open','boolean'), ('s_name','string'), ('status','datetime')) t(column_name, type)")
def _(T):
    names = ["o_orderdate", "l_quantity", "p_retailprice", "is_open", "s_name", "status"]
    return T("region").sparkSession.createDataFrame([(n, p.guess_type(n)) for n in names], "column_name string, type string")


def _facts(df, cols):
    return {r.column_name: r.asDict() for r in p.key_facts(df, cols).collect()}  # one row a column


@q("prf_06_key_choice", "SELECT * FROM (VALUES ('purchase_orders', 'row_id'), ('orders', '__row_hash__'), ('uploaded_files', 'id')) t(dataset, pk)")
def _(T):
    out = []
    for name, cols in (("purchase_orders", ["row_id", *COLUMNS]), ("orders", ["o_custkey", "o_orderstatus"]), ("uploaded_files", ["id", "filename", "mime_type"])):
        out.append((name, p.choose_key(_facts(T(name), cols), cols)))
    return T("region").sparkSession.createDataFrame(out, "dataset string, pk string")


@q("prf_07_alternate_keys", f"""WITH u AS (SELECT column_name, nullif(trim(value), '') AS x FROM ({" UNION ALL ".join(f"SELECT '{x}' AS column_name, CAST({x} AS VARCHAR) AS value FROM v" for x in ("id", "name_cn", "type", "confidence"))}))
SELECT column_name FROM u WHERE x IS NOT NULL GROUP BY column_name HAVING count(DISTINCT x) >= 2 AND count(*) FILTER (WHERE {_FLT}) < count(*) AND count(*) FILTER (WHERE length(x) >= 3) >= 0.8 * count(*) AND count(DISTINCT x) >= 0.9 * count(*)""")
def _(T):
    return p.alternate_keys(p.key_facts(T("v").select("id", "name_cn", "type", "confidence"), ["id", "name_cn", "type", "confidence"]))


@q("prf_08_property_metadata", "SELECT * FROM (VALUES ('c_acctbal', 'float', false), ('c_custkey', 'integer', true), ('c_name', 'string', false), ('c_nationkey', 'integer', true)) t(column_name, type, technical)")
def _(T):
    df = T("customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal", F.lit("").alias("zz"))
    kinds = p.first_type(df.withColumn("o", c("c_custkey")), df.columns, "o").select("column_name", "type")
    return kinds.withColumn("technical", c("column_name").endswith("key"))


_REV = "(SELECT id AS dataset, updated_at, CASE version WHEN 'v0.1' THEN 'start' WHEN 'v0.2' THEN 'approve' ELSE 'reject' END AS event FROM entities)"


@q("cur_01_latest_review", f"SELECT dataset, event FROM {_REV} QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY updated_at DESC) = 1")
def _(T):
    return p.latest_review(_reviews(T), "dataset", "updated_at").select("dataset", "event")


def _reviews(T):
    event = F.when(c("version") == "v0.1", "start").when(c("version") == "v0.2", "approve").otherwise("reject")
    return T("entities").select(c("id").alias("dataset"), "updated_at", event.alias("event"))


@q("cur_02_review_state", f"SELECT dataset, CASE event WHEN 'start' THEN 'in_review' WHEN 'approve' THEN 'approved' ELSE 'rejected' END AS status FROM {_REV} QUALIFY row_number() OVER (PARTITION BY dataset ORDER BY updated_at DESC) = 1")
def _(T):
    return p.latest_review(_reviews(T), "dataset", "updated_at").select("dataset", p.review_status(c("event")).alias("status"))


_EDITS = "SELECT CAST(c_custkey AS VARCHAR) AS row_pk, 'c_name' AS field_name, c_name || '!' AS new_value, 1 AS seq FROM customer WHERE c_custkey % 5 = 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_name', c_name || '?', 2 FROM customer WHERE c_custkey % 10 = 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'c_mktsegment', NULL, 1 FROM customer WHERE c_custkey % 7 = 0"


def _edits(T):
    cu, pk = T("customer"), c("c_custkey").cast("string").alias("row_pk")
    one = lambda n, f, v, s: cu.filter(c("c_custkey") % n == 0).select(pk, F.lit(f).alias("field_name"), v.alias("new_value"), F.lit(s).alias("seq"))
    name = lambda x: F.concat("c_name", F.lit(x))
    return one(5, "c_name", name("!"), 1).unionByName(one(10, "c_name", name("?"), 2)).unionByName(one(7, "c_mktsegment", F.lit(None).cast("string"), 1))


@q("cur_03_edit_log", _EDITS)
def _(T):
    return _edits(T)


@q("cur_04_apply_edits", "SELECT c_custkey, CASE WHEN c_custkey % 10 = 0 THEN c_name || '?' WHEN c_custkey % 5 = 0 THEN c_name || '!' ELSE c_name END AS c_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment FROM customer")
def _(T):
    return p.apply_edits(T("customer").select("c_custkey", "c_name", "c_mktsegment"), "c_custkey", _edits(T), ["c_name", "c_mktsegment"])


@q("wid_01_detect", "SELECT * FROM (VALUES ('lineitem', false, 11), ('purchase_orders', true, 21)) t(dataset, wide, columns)")
def _(T):
    rows = [(n, k.detect_wide(T(n), 20), len(T(n).columns)) for n in ("lineitem", "purchase_orders")]
    return T("region").sparkSession.createDataFrame(rows, "dataset string, wide boolean, columns int")


@q("wid_02_suggest", "SELECT DISTINCT p_partkey, p_name, p_brand FROM part")
def _(T):
    return k.apply_split(T("part"), k.suggest_split(T("part").columns))["table_1"]


@q("wid_03_apply_split", "SELECT DISTINCT \"供应商\", \"供应商类别\" FROM purchase_orders")
def _(T):
    return k.apply_split(T("purchase_orders"), {"orders": ["订单号", "数量"], "suppliers": ["供应商", "供应商类别", "unknown"]})["suppliers"]


def _nested(T):
    items = T("lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_quantity"))).alias("items"))
    o = T("orders").join(items, c("o_orderkey") == c("l_orderkey"), "left")
    return o.select(c("o_orderkey").alias("order_id"), F.struct(c("o_custkey").alias("id"), F.struct(c("o_orderstatus").alias("status")).alias("state")).alias("customer"), F.coalesce("items", F.array().cast(items.schema["items"].dataType)).alias("items"))


@q("jsn_01_flatten", "SELECT o_orderkey AS order_id, o_custkey AS \"customer.id\", o_orderstatus AS \"customer.state.status\" FROM orders")
def _(T):
    return k.flatten(_nested(T).drop("items"))


@q("jsn_02_explode", "SELECT o_orderkey AS order_id, l_linenumber AS \"items.l_linenumber\", l_partkey AS \"items.l_partkey\", l_quantity AS \"items.l_quantity\", CASE WHEN l_orderkey IS NULL THEN '[]' END AS items FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey")
def _(T):
    return k.explode_array(_nested(T).drop("customer"))


@q("xml_01_records", "SELECT o_custkey, CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS title FROM orders")
def _(T):
    one = F.concat(F.lit("<item id='"), c("o_orderkey").cast("string"), F.lit("'><title>"), "o_orderpriority", F.lit("</title></item>"))
    docs = T("orders").groupBy("o_custkey").agg(F.concat(F.lit("<list>"), F.array_join(F.collect_list(one), ""), F.lit("</list>")).alias("doc"))
    return k.xml_records(docs, "doc", "item", "id: string, title: string", ["o_custkey"])


@q("srt_01_order_by", "SELECT id, created_at FROM v ORDER BY created_at DESC")
def _(T):
    return T("v").select("id", "created_at").orderBy(F.desc("created_at"))


@q("srt_02_limit", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(T):
    return T("orders").select("o_orderkey", "o_totalprice").orderBy(F.desc("o_totalprice"), "o_orderkey").limit(10)


@q("srt_03_page", "SELECT o_orderkey, (SELECT count(*) FROM orders) AS total FROM orders ORDER BY o_orderkey LIMIT 20 OFFSET 40")
def _(T):
    o = T("orders").select("o_orderkey")
    return o.orderBy("o_orderkey").offset(40).limit(20).crossJoin(F.broadcast(o.agg(F.count("*").alias("total"))))  # a page and one row


@q("srt_04_top_k", "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey ORDER BY n DESC, o_custkey LIMIT 10")
def _(T):
    return T("orders").groupBy("o_custkey").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "o_custkey").limit(10)


@q("srt_05_locale_sort", "SELECT id, name_en FROM v WHERE name_en IS NOT NULL ORDER BY lower(name_en), id")
def _(T):
    return T("v").filter("name_en is not null").select("id", "name_en").orderBy(F.collate("name_en", "UNICODE_CI"), "id")


@q("srt_06_samples", "SELECT ontology_id, list_slice(list(id ORDER BY id), 1, 5) AS ids FROM v GROUP BY ontology_id")
def _(T):
    return catalog.samples(T("v"), "ontology_id", "id", 5).withColumnRenamed("samples", "ids")


@q("set_01_union", "SELECT s_name AS name FROM supplier UNION ALL SELECT c_name FROM customer")
def _(T):
    return T("supplier").select(c("s_name").alias("name")).unionByName(T("customer").select(c("c_name").alias("name")))


@q("set_02_union_heterogeneous", "SELECT s_name AS name, coalesce(NULL, '') AS segment FROM supplier UNION ALL SELECT c_name, c_mktsegment FROM customer")
def _(T):
    return T("supplier").select(c("s_name").alias("name")).unionByName(T("customer").select(c("c_name").alias("name"), c("c_mktsegment").alias("segment")), allowMissingColumns=True).na.fill("")


@q("set_03_difference", "SELECT id FROM v EXCEPT (SELECT source_entity FROM e UNION SELECT target_entity FROM e)")
def _(T):
    e = T("e")
    return T("v").select("id").subtract(e.select(c("source_entity").alias("id")).unionAll(e.select("target_entity")))


@q("set_04_intersection", "SELECT source_entity AS id FROM e INTERSECT SELECT target_entity FROM e")
def _(T):
    e = T("e")
    return e.select(c("source_entity").alias("id")).intersect(e.select("target_entity"))


@q("set_05_equality", "SELECT (SELECT count(*) FROM (SELECT id FROM v EXCEPT SELECT id FROM entities)) = 0 AND (SELECT count(*) FROM (SELECT id FROM entities EXCEPT SELECT id FROM v)) = 0 AS equal")
def _(T):
    return catalog.same_rows(T("v").select("id"), T("entities").select("id").distinct())


@q("set_06_ordered_distinct", "SELECT id, (SELECT list(x ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(string_split(name_cn, '')) AS x, generate_subscripts(string_split(name_cn, ''), 1) AS i) GROUP BY x)) AS chars FROM v WHERE name_cn <> ''")
def _(T):
    return T("v").filter("name_cn <> ''").select("id", F.array_distinct(F.split("name_cn", "")).alias("chars"))


@q("win_01_latest_version", "SELECT id, version FROM entities QUALIFY row_number() OVER (PARTITION BY id ORDER BY updated_at DESC) = 1")
def _(T):
    return T("entities").groupBy("id").agg(F.max_by("version", "updated_at").alias("version"))


@q("win_02_last_run", "SELECT feed, load_no, loaded_at FROM purchase_orders QUALIFY row_number() OVER (PARTITION BY feed ORDER BY loaded_at DESC, row_id DESC) = 1")
def _(T):
    return T("purchase_orders").groupBy("feed").agg(F.max_by(F.struct("load_no", "loaded_at"), F.struct("loaded_at", "row_id")).alias("x")).select("feed", "x.*")


@q("win_03_best_match", "SELECT source_entity, id FROM e WHERE source_entity IS NOT NULL QUALIFY row_number() OVER (PARTITION BY source_entity ORDER BY confidence DESC NULLS LAST, id) = 1")
def _(T):
    w = Window.partitionBy("source_entity").orderBy(F.desc_nulls_last("confidence"), "id")
    return T("e").filter("source_entity is not null").withColumn("n", F.row_number().over(w)).filter("n = 1").select("source_entity", "id")


@q("win_04_ordinals", "SELECT id, unnest(linked_entities) AS name, generate_subscripts(linked_entities, 1) AS ordinal FROM a")
def _(T):
    return T("a").select("id", F.posexplode("linked_entities").alias("p", "name")).select("id", "name", (c("p") + 1).alias("ordinal"))


_LINES = "(SELECT id, i, unnest(l) AS line FROM (SELECT id, string_split(converted_md, chr(10)) AS l FROM uploaded_files), LATERAL (SELECT 1) t(i))"


def _lines(T):
    return T("uploaded_files").select("id", F.posexplode(F.split("converted_md", "\n")).alias("i", "line"))


_LSQL = "SELECT id, unnest(string_split(converted_md, chr(10))) AS line, generate_subscripts(string_split(converted_md, chr(10)), 1) - 1 AS i FROM uploaded_files WHERE converted_md IS NOT NULL"


@q("win_05_section_extent", f"SELECT id, i, lead(i) OVER (PARTITION BY id ORDER BY i) AS next FROM ({_LSQL}) WHERE regexp_matches(line, '^#{{1,6}}\\s+.')")
def _(T):
    heads = _lines(T).filter(c("line").rlike(r"^#{1,6}\s+."))
    return heads.select("id", "i", F.lead("i").over(Window.partitionBy("id").orderBy("i")).alias("next"))


@q("win_06_forward_fill", f"SELECT id, i, last_value(CASE WHEN regexp_matches(line, '^#{{1,6}}\\s+.') THEN line END IGNORE NULLS) OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS section FROM ({_LSQL})")
def _(T):
    head = F.when(c("line").rlike(r"^#{1,6}\s+."), c("line"))
    return _lines(T).select("id", "i", F.last(head, ignorenulls=True).over(Window.partitionBy("id").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)).alias("section"))


@q("win_07_keep_first", "SELECT \"订单号\" AS order_no, row_id FROM purchase_orders QUALIFY row_number() OVER (PARTITION BY \"订单号\" ORDER BY row_id) = 1")
def _(T):
    return T("purchase_orders").groupBy(c("订单号").alias("order_no")).agg(F.min("row_id").alias("row_id"))
