"""Queries of sources, exports, documents, rules, mapping, search and incremental loads."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.functions import text as t
from tributary.operators import audit, catalog, cleansing, documents, graph, links, mapping, merge, ontology, rules, search
from tributary.operators import profiling as p
from tributary.plans import pipeline
from tributary.plans.durable import checkpoint_dir
from tributary.queries.registry import Registry, latest
from tributary.sources import connectors, exports, files, object_store
from tributary.streaming import incremental

q = Registry()
c = F.col


def _folder(df) -> str:
    return f"{checkpoint_dir(df.sparkSession)}/files-{uuid.uuid4().hex}"


# sources


def _csv_of(T):
    s = T("supplier").select("s_suppkey", "s_name", "s_nationkey")
    at = _folder(s)
    s.write.option("header", True).csv(at)
    return s.sparkSession, at


@q("src_01_csv", "SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey FROM supplier")
def _(T):
    spark, at = _csv_of(T)
    return files.csv(spark, at, ["s_suppkey", "s_name", "s_nationkey"]).drop("_corrupt")


@q("src_02_json", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def _(T):
    o = T("orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    at = _folder(o)
    o.write.json(at)
    return files.json(o.sparkSession, at, "o_orderkey long, o_custkey long, o_orderpriority string", lines=True)


def _workbook(rows):
    import io
    import zipfile

    cells = lambda r: "".join(f'<c t="inlineStr"><is><t>{x}</t></is></c>' for x in r)
    sheet = '<worksheet xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"><sheetData>' + "".join(f"<row>{cells(r)}</row>" for r in rows) + "</sheetData></worksheet>"
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/worksheets/sheet1.xml", sheet)
    return out.getvalue()


@q("src_03_xlsx", "SELECT CAST(n_nationkey AS VARCHAR) AS key, n_name AS name FROM nation")
def _(T):
    n = T("nation")
    at = _folder(n)
    rows = [(str(r.n_nationkey), r.n_name) for r in n.collect()]  # 25 rows, one workbook
    spark = n.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{at}/nation.xlsx")
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(_workbook([("key", "name"), *rows]))
    out.close()
    return files.xlsx(spark, at).select(c("cells")["key"].alias("key"), c("cells")["name"].alias("name"))


@q("src_04_xml", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation")
def _(T):
    one = F.concat(F.lit("<record id='"), c("n_nationkey").cast("string"), F.lit("'><name>"), "n_name", F.lit("</name></record>"))
    n = T("nation").agg(F.concat(F.lit("<list>"), F.array_join(F.collect_list(one), ""), F.lit("</list>")).alias("value"))  # 25 rows, one document
    at = _folder(n)
    n.write.text(at)
    return files.xml(n.sparkSession, at, "record", "id string, name string")


def _texts(T):
    n = T("nation").select(F.concat("n_name", F.lit(","), c("n_regionkey").cast("string")).alias("value"), "n_nationkey")
    at = _folder(n)
    n.repartition(5, "n_nationkey").select("value").write.text(at)
    return n.sparkSession, at


@q("src_05_documents", "SELECT sum(length(n_name) + 2 + length(CAST(n_regionkey AS VARCHAR))) AS bytes FROM nation")
def _(T):
    spark, at = _texts(T)
    return files.documents(spark, at, "part-*").agg(F.sum("size").alias("bytes"))


_EXT = "lower(regexp_extract(filename, '\\.([^.]+)$', 1))"


@q("src_06_routing", f"SELECT id, CASE WHEN {_EXT} IN ('csv','xlsx','xls') THEN 'A' WHEN {_EXT} IN ('json','xml') THEN 'B' ELSE 'C' END AS route FROM uploaded_files")
def _(T):
    return T("uploaded_files").select("id", files.route(c("filename")).alias("route"))


@q("src_07_source_lookup", "SELECT DISTINCT regexp_replace(source_file, '\\.[^.]+$', '') AS stem FROM raw_orders")
def _(T):
    names = T("raw_orders").select("source_file").distinct()
    named = connectors.sources_of(names.select(F.regexp_replace("source_file", r"\.[^.]+$", "").alias("node")), "node", names, "source_file", "source_file")
    return named.select(c("source").alias("stem"))


def _catalog(T, *names):
    spark = T("region").sparkSession
    for n in names:
        T(n).createOrReplaceTempView(f"src_{n}")
    return connectors.connector(spark, "catalog")


@q("src_08_contract", "SELECT n_nationkey, n_name FROM nation")
def _(T):
    con = _catalog(T, "nation")
    assert con.test_connection()
    return con.pull_full("src_nation").select("n_nationkey", "n_name")


@q("src_09_sql_sample", "SELECT least(count(*), 10) AS n FROM customer")
def _(T):
    return _catalog(T, "customer").pull_sample("src_customer", 10).agg(F.count("*").alias("n"))


@q("src_10_sql_full", "SELECT c_mktsegment, count(*) AS n FROM customer GROUP BY 1")
def _(T):
    return _catalog(T, "customer").pull_full("src_customer", "SELECT c_mktsegment, count(*) AS n FROM src_customer GROUP BY 1")


@q("src_11_sql_delta", "SELECT o_orderkey FROM orders WHERE o_orderkey > 1000")
def _(T):
    return _catalog(T, "orders").pull_delta("src_orders", "o_orderkey", 1000).select("o_orderkey")


@q("src_12_sql_tables", "SELECT * FROM (VALUES ('src_nation'), ('src_region')) t(name)")
def _(T):
    con = _catalog(T, "nation", "region")
    return con.spark.createDataFrame([(n,) for n in con.list_resources() if n in ("src_nation", "src_region")], "name string")


_REST = "tributary.queries.stubs:pages_of_numbers"


@q("src_13_mongo_full", "SELECT CAST(i AS BIGINT) AS n FROM range(0, 40) t(i)")
def _(T):
    con = connectors.connector(T("region").sparkSession, "mongo", fetch="tributary.queries.stubs:find_numbers")
    return con.pull_full("numbers").select(F.get_json_object("record", "$.n").cast("long").alias("n"))


@q("src_14_mongo_delta", "SELECT CAST(i AS BIGINT) AS n FROM range(26, 40) t(i)")
def _(T):
    con = connectors.connector(T("region").sparkSession, "mongo", fetch="tributary.queries.stubs:find_numbers")
    return con.pull_delta("numbers", since="25").select(F.get_json_object("record", "$.n").cast("long").alias("n"))


@q("src_15_rest_full", "SELECT CAST(i AS BIGINT) AS n FROM range(0, 950) t(i)")
def _(T):
    con = connectors.connector(T("region").sparkSession, "rest", fetch=_REST)
    return con.pull_full("numbers").select(F.get_json_object("record", "$.n").cast("long").alias("n"))


@q("src_16_rest_delta", "SELECT CAST(i AS BIGINT) AS n FROM range(901, 950) t(i)")
def _(T):
    con = connectors.connector(T("region").sparkSession, "rest", fetch=_REST)
    return con.pull_delta("numbers", since="900").select(F.get_json_object("record", "$.n").cast("long").alias("n"))


@q("src_17_record_extraction", "SELECT event_id, CAST(props::JSON->>'k' AS BIGINT) AS k FROM events")
def _(T):
    body = F.when(c("event_id") % 2 == 0, F.concat(F.lit('{"data":['), "props", F.lit("]}"))).otherwise(F.concat(F.lit('{"items":['), "props", F.lit("]}")))
    return T("events").select("event_id", F.explode(connectors.records_in(body, "struct<k long>")).alias("x")).select("event_id", "x.k")


@q("src_18_file_listing", "SELECT 5 AS files")
def _(T):
    spark, at = _texts(T)
    con = connectors.connector(spark, "file", path=at, pattern="part-*")
    return spark.createDataFrame([(min(5, len(con.list_resources())),)], "files int")


@q("src_19_registry", "SELECT * FROM (VALUES ('file'), ('mongo'), ('mongodb'), ('mysql'), ('postgres'), ('postgresql'), ('rest'), ('rest_api')) t(kind)")
def _(T):
    return T("region").sparkSession.createDataFrame([(k,) for k in connectors.kinds()], "kind string")


@q("src_20_object_store", "SELECT n_nationkey FROM nation")
def _(T):
    n = T("nation")
    at = _folder(n)
    store = object_store.ObjectStore(n.sparkSession, at)
    for r in n.select("n_nationkey").collect():  # 25 rows, an object each
        store.put(f"nation/{r.n_nationkey}.txt", str(r.n_nationkey).encode())
    return store.read("*.txt").select(c("content").cast("string").cast("long").alias("n_nationkey"))


@q("src_21_comments", "SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name FROM nation WHERE n_nationkey % 4 <> 0")
def _(T):
    row = F.concat(F.when(c("n_nationkey") % 4 == 0, "# ").otherwise(""), c("n_nationkey").cast("string"), F.lit(","), "n_name")
    n = T("nation").select(row.alias("value"))
    at = _folder(n)
    n.write.text(at)
    return n.sparkSession.read.schema("id string, name string").option("comment", "#").csv(at)


@q("src_22_to_markdown", "SELECT n_nationkey || '.md' AS filename, n_name AS markdown_text FROM nation")
def _(T):
    docs = T("nation").select(F.concat(c("n_nationkey").cast("string"), F.lit(".md")).alias("filename"), F.encode("n_name", "UTF-8").alias("content"))
    return files.to_markdown(docs).select("filename", "markdown_text")


@q("src_23_csv_to_markdown", "SELECT n_nationkey, '| id | name |' || chr(10) || '|---|---|' || chr(10) || '| ' || n_nationkey || ' | ' || n_name || ' |' AS md FROM nation")
def _(T):
    text = F.concat(F.lit("id,name\n"), c("n_nationkey").cast("string"), F.lit(","), "n_name", F.lit("\n"))
    return T("nation").select("n_nationkey", files.csv_to_markdown(text).alias("md"))


@q("src_24_row_migration", "SELECT id, source_entity AS source, coalesce(CAST(confidence AS VARCHAR), '') AS props, coalesce(created_at, created_at) AS updated_at FROM e")
def _(T):
    old = T("e").withColumn("confidence", c("confidence").cast("string"))
    return connectors.migrated(old, {"source_entity": "source", "confidence": "props"}, {"props": F.lit(""), "updated_at": c("created_at")}).select("id", "source", "props", "updated_at")


# sinks and exports


@q("snk_01_curated_csv", "SELECT row_id::VARCHAR AS row_id, coalesce(\"供应商\", '') AS \"供应商\", coalesce(\"质检结果\", '') AS \"质检结果\" FROM purchase_orders")
def _(T):
    return exports.stringified(T("purchase_orders").select("row_id", "供应商", "质检结果"))


@q("snk_02_next_version", "SELECT feed AS dataset, max(load_no) + 1 AS version_no, left(sha256(max(\"订单号\")), 16) AS checksum FROM purchase_orders GROUP BY feed")
def _(T):
    v = T("purchase_orders").select(c("feed").alias("dataset"), c("load_no").alias("version_no"), "订单号")
    return exports.next_version(v, "dataset", c("订单号"))


@q("snk_03_split_outputs", "SELECT 'kinds' AS name, count(*) AS n FROM (SELECT DISTINCT p_brand, p_type FROM part) UNION ALL SELECT 'sizes', count(*) FROM (SELECT DISTINCT p_brand, p_size FROM part)")
def _(T):
    parts = T("part")
    at = _folder(parts)
    tables = cleansing.apply_split(parts, {"kinds": ["p_brand", "p_type"], "sizes": ["p_brand", "p_size"]})
    exports.write_tables(tables, at)
    read = [parts.sparkSession.read.parquet(f"{at}/{n}").agg(F.lit(n).alias("name"), F.count("*").alias("n")) for n in tables]
    return read[0].unionByName(read[1])


@q("snk_04_export_json", "SELECT 'relation' AS kind, to_json({'id': e.id, 'source_id': e.source_entity, 'target_id': e.target_entity, 'source_cn': coalesce(s.name_cn, ''), 'target_cn': coalesce(t.name_cn, ''), 'type': e.type}) AS document FROM e LEFT JOIN v s ON s.id = e.source_entity LEFT JOIN v t ON t.id = e.target_entity")
def _(T):
    return exports.ontology_json(T("v"), T("e")).filter("kind = 'relation'").select("kind", "document")


@q("snk_04_export_yaml")
def _(T):
    return exports.yaml_records(exports.ontology_json(T("v"), T("e")))


@q("snk_05_unified_csv", "SELECT 'entity' AS record_type, id, coalesce(name_cn, '') AS name_cn, coalesce(name_en, '') AS name_en, coalesce(description, '') AS description, confidence, '' AS source_cn, '' AS target_cn, '' AS relation_type FROM v UNION ALL SELECT 'relation', e.id, '', '', coalesce(s.name_cn, '') || ' -> ' || coalesce(t.name_cn, ''), e.confidence, coalesce(s.name_cn, ''), coalesce(t.name_cn, ''), e.type FROM e LEFT JOIN v s ON s.id = e.source_entity LEFT JOIN v t ON t.id = e.target_entity UNION ALL SELECT 'logic_rule', id, coalesce(name_cn, ''), coalesce(name_en, ''), coalesce(description, ''), confidence, '', '', '' FROM r UNION ALL SELECT 'action', id, coalesce(name_cn, ''), coalesce(name_en, ''), coalesce(description, ''), confidence, '', '', '' FROM a")
def _(T):
    return exports.unified_csv(T("v"), T("e"), T("r"), T("a"))


@q("snk_06_turtle", "SELECT DISTINCT ':entity_' || regexp_replace(source_entity, '[^\\p{L}\\p{N}_]', '_', 'g') || ' :rel_' || regexp_replace(type, '[^\\p{L}\\p{N}_]', '_', 'g') || ' :entity_' || regexp_replace(target_entity, '[^\\p{L}\\p{N}_]', '_', 'g') || ' .' AS triple FROM e WHERE source_entity IN (SELECT id FROM v) AND target_entity IN (SELECT id FROM v)")
def _(T):
    return exports.turtle(T("v"), T("e")).filter(c("triple").rlike("^:entity_[^ ]+ :rel_"))


@q("snk_07_cypher", "SELECT 'MATCH (a {id: ' || coalesce('''' || source_entity || '''', 'null') || '}), (b {id: ' || coalesce('''' || target_entity || '''', 'null') || '}) MERGE (a)-[r:' || upper(regexp_replace(type, '[^\\p{L}\\p{N}_]', '_', 'g')) || ']->(b) SET r += {confidence: ' || coalesce(CAST(confidence AS VARCHAR), 'null') || '};' AS statement FROM e")
def _(T):
    return exports.cypher(T("v"), T("e")).filter("ord = 2").select("statement")


@q("snk_08_bulk_header", "SELECT e.type AS type, arg_min(s.type, e.id) AS source_label, arg_min(t.type, e.id) AS target_label FROM (SELECT * FROM e) e JOIN v s ON s.id = e.source_entity AND s.type IS NOT NULL JOIN v t ON t.id = e.target_entity AND t.type IS NOT NULL GROUP BY 1")
def _(T):
    return exports.edge_label_pairs(T("v").filter("type is not null"), T("e"))


@q("snk_08_bulk_import", "SELECT coalesce(type, 'Entity') AS label, count(*) AS n FROM v GROUP BY 1")
def _(T):
    v = T("v")
    at = _folder(v)
    exports.bulk_import(v, T("e"), at)
    return v.sparkSession.read.option("header", True).csv(f"{at}/vertices").groupBy("label").agg(F.count("*").alias("n"))


@q("snk_09_html", "SELECT id, '<tr><td>' || id || '</td><td>' || replace(replace(replace(coalesce(name_cn, ''), '&', '&amp;'), '<', '&lt;'), '>', '&gt;') || '</td><td>' || replace(coalesce(name_en, ''), '&', '&amp;') || '</td><td>' || coalesce(type, '') || '</td></tr>' AS html FROM v")
def _(T):
    return exports.html_rows(T("v"))


def _updates(T):
    return T("v").filter("type = '指标'").select("id", F.lit("Metric").alias("name_en"), F.create_map(F.lit("k"), F.lit("new")).alias("properties"))


@q("snk_10_upsert", "SELECT id, CASE WHEN type = '指标' THEN 'Metric' ELSE name_en END AS name_en, CASE WHEN type = '指标' THEN 'new' ELSE properties['k'] END AS k FROM v")
def _(T):
    return exports.upsert(T("v"), _updates(T)).select("id", "name_en", F.element_at("properties", "k").alias("k"))


@q("snk_11_upsert_batch", "SELECT count(*) AS n, count(*) FILTER (WHERE type = '指标') AS changed FROM v")
def _(T):
    return exports.upsert(T("v"), _updates(T)).agg(F.count("*").alias("n"), F.sum((c("name_en") == "Metric").cast("int") * (c("type") == "指标").cast("int")).alias("changed"))


@q("snk_12_upsert_edges", "SELECT id, CASE WHEN source_entity IN (SELECT id FROM v) AND target_entity IN (SELECT id FROM v) THEN 1.0 ELSE confidence END AS confidence FROM e")
def _(T):
    e = T("e")
    return exports.upsert_edges(e, e.withColumn("confidence", F.lit(1.0)), T("v")).select("id", "confidence")


_GONE = "(SELECT id FROM v WHERE ontology_id = 'o-sup-00000')"


@q("snk_13_delete_scope", f"SELECT id, 'edge' AS kind FROM e WHERE (source_entity NOT IN {_GONE} OR source_entity IS NULL) AND (target_entity NOT IN {_GONE} OR target_entity IS NULL) UNION ALL SELECT id, 'vertex' FROM v WHERE ontology_id IS DISTINCT FROM 'o-sup-00000'")
def _(T):
    v, e = exports.delete_scope(T("v"), T("e"), "o-sup-00000")
    return e.select("id", F.lit("edge").alias("kind")).unionByName(v.select("id", F.lit("vertex").alias("kind")))


@q("snk_14_graph_sync", "SELECT id, upper(regexp_replace(coalesce(type, 'Entity'), '[\\s\\-]+', '_', 'g')) AS label, coalesce(name_cn, '') AS name_cn FROM v")
def _(T):
    return exports.graph_nodes(T("v")).select("id", "label", F.element_at("properties", "name_cn").alias("name_cn"))


@q("snk_15_vector_upsert", "SELECT vec_id, CASE WHEN vec_id % 10 = 0 THEN -1 ELSE label END AS label FROM embeddings WHERE vec_id % 7 <> 0")
def _(T):
    e = T("embeddings").select("vec_id", "label")
    up = exports.upsert(e, e.filter("vec_id % 10 = 0").withColumn("label", F.lit(-1)), "vec_id", None)
    return up.join(e.filter("vec_id % 7 = 0").select("vec_id"), "vec_id", "left_anti").select("vec_id", "label")


@q("snk_16_embedding_text", "SELECT id, concat_ws(' ', nullif(name_cn, ''), nullif(name_en, ''), nullif(type, ''), nullif(description, '')) AS text FROM v")
def _(T):
    return T("v").withColumn("properties", F.lit(None).cast("map<string,string>")).select("id", exports.embedding_text().alias("text"))


# documents

_MD = "FROM (SELECT id, converted_md FROM uploaded_files WHERE converted_md IS NOT NULL)"


def _docs(T):
    """The uploaded texts, each with a rule, a definition and a table of its own appended."""
    more = F.concat(F.lit("\nIF rate > "), c("file_size").cast("string"), F.lit(" THEN review order\nIF size > 3, split it\nLimit (upper): "), c("file_size").cast("string"), F.lit("\n| a | b |\n|---|---|\n| "), c("file_size").cast("string"), F.lit(" | x |\n"))
    return T("uploaded_files").filter("converted_md is not null").select("id", F.concat("converted_md", more).alias("md"), "file_size")


@q("doc_01_pass_through", "SELECT id, coalesce(converted_md, '') AS markdown_text, CASE WHEN converted_md IS NULL THEN 'no text' END AS extraction_error FROM uploaded_files")
def _(T):
    return T("uploaded_files").select("id", F.coalesce("converted_md", F.lit("")).alias("markdown_text"), F.when(c("converted_md").isNull(), "no text").alias("extraction_error"))


_THEN, _COMMA = "(?i)IF\\s+(.+?)\\s+THEN\\s+(.+?)$", "(?i)^\\s*IF\\s+([^,，]+?)[,，]\\s*(.+)$"


@q("doc_02_rules", f"""WITH d AS (SELECT id, converted_md || chr(10) || 'IF rate > ' || file_size || ' THEN review order' || chr(10) || 'IF size > 3, split it' AS md FROM uploaded_files WHERE converted_md IS NOT NULL),
ln AS (SELECT id, unnest(string_split(md, chr(10))) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM d),
x AS (SELECT id, 0 AS form, i, trim(regexp_extract(line, '{_THEN}', 1)) AS condition, trim(regexp_extract(line, '{_THEN}', 2)) AS action FROM ln WHERE regexp_matches(line, '{_THEN}')
UNION ALL SELECT id, 1, i, trim(regexp_extract(line, '{_COMMA}', 1)), trim(regexp_extract(line, '{_COMMA}', 2)) FROM ln WHERE regexp_matches(line, '{_COMMA}') AND NOT regexp_matches(line, '(?i)\\bTHEN\\b'))
SELECT id, row_number() OVER (PARTITION BY id ORDER BY form, i) AS rule_index, condition, action FROM x""")
def _(T):
    return documents.rules(_docs(T), "id", "md")


@q("doc_03_tables", "SELECT id, CAST(file_size AS VARCHAR) AS a, 'x' AS b FROM uploaded_files WHERE converted_md IS NOT NULL")
def _(T):
    rows = documents.tables(_docs(T), "id", "md").filter(F.map_contains_key("cells", "a") & F.map_contains_key("cells", "b"))
    return rows.select("id", c("cells")["a"].alias("a"), c("cells")["b"].alias("b"))


@q("doc_03_table_rows")
def _(T):
    return documents.tables(T("uploaded_files").filter("converted_md is not null"), "id", "converted_md")


_DEFINED = "^([A-Za-z一-龥][\\p{L}\\p{N}_一-龥 /\\-]{0,40}?)\\s*[(（]([^)）]{1,40})[)）]\\s*[:：]\\s*(.+)$"


@q("doc_04_definitions", f"""WITH d AS (SELECT id, converted_md || chr(10) || 'IF rate > ' || file_size || ' THEN review order' || chr(10) || 'IF size > 3, split it' || chr(10) || 'Limit (upper): ' || file_size || chr(10) || '| a | b |' AS md FROM uploaded_files WHERE converted_md IS NOT NULL),
ln AS (SELECT id, trim(unnest(string_split(md, chr(10))), ' ' || chr(9) || chr(13)) AS line, generate_subscripts(string_split(md, chr(10)), 1) AS i FROM d),
hit AS (SELECT id, i, trim(regexp_extract(line, '{_DEFINED}', 1)) AS name, trim(regexp_extract(line, '{_DEFINED}', 2)) AS qualifier, trim(regexp_extract(line, '{_DEFINED}', 3)) AS definition FROM ln WHERE regexp_matches(line, '{_DEFINED}'))
SELECT id, row_number() OVER (PARTITION BY id ORDER BY i) AS definition_index, name, qualifier, definition FROM hit WHERE NOT regexp_matches(name, '(?i)^(step|阶段|步骤)\\s*[0-9]*$')""")
def _(T):
    return documents.definitions(_docs(T), "id", "md")


_NUMBERED = "^\\s*([0-9]+[\\.、)])\\s+(\\S[^\\n]{0,60}?)\\s*$"
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(160) || chr(12288)"


@q("doc_05_sections", f"""WITH ln AS (SELECT id, unnest(p) AS line, generate_subscripts(p, 1) AS i FROM (SELECT id, regexp_split_to_array(converted_md, '\\r?\\n') AS p FROM uploaded_files WHERE converted_md IS NOT NULL)),
h AS (SELECT *, regexp_matches(line, '^#{{1,6}}\\s+.') AS sharp, regexp_matches(line, '{_NUMBERED}') AND NOT regexp_matches(line, '(?i)^\\s*[0-9]+[\\.、)]\\s+(IF|Step)\\b') AS number FROM ln),
k AS (SELECT *, CASE WHEN bool_or(sharp) OVER (PARTITION BY id) THEN sharp ELSE number END AS head FROM h),
n AS (SELECT *, count(*) FILTER (WHERE head) OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS n, bool_or(head) OVER (PARTITION BY id) AS has_head FROM k),
s AS (SELECT id, greatest(n, 1) AS section_index, max(CASE WHEN head THEN trim(CASE WHEN sharp THEN regexp_extract(line, '^(#{{1,6}})\\s+(.+)$', 2) ELSE regexp_extract(line, '{_NUMBERED}', 2) END, {_WS}) END) AS section_title, trim(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT head), ''), {_WS}) AS section_text FROM n WHERE NOT has_head OR n > 0 GROUP BY id, n)
SELECT * FROM s WHERE section_text <> ''""")
def _(T):
    return documents.sections(T("uploaded_files").filter("converted_md is not null"), "id", "converted_md")


@q("doc_06_fallback", "SELECT id FROM uploaded_files WHERE trim(converted_md) <> ''")
def _(T):
    return documents.extract(T("uploaded_files"), "id", "converted_md").select("id").distinct()


@q("doc_07_common", "SELECT id, len(regexp_extract_all(converted_md, '(?m)^(#{1,6})\\s+(.+)$', 2)) AS section_count, array_to_string(regexp_extract_all(converted_md, '(?m)^(#{1,6})\\s+(.+)$', 2), ', ') AS sections FROM uploaded_files WHERE converted_md IS NOT NULL")
def _(T):
    return documents.common(T("uploaded_files").filter("converted_md is not null"), "id", "converted_md").select("id", "section_count", "sections")


@q("doc_08_enrich", "SELECT id, array_to_string(regexp_extract_all(coalesce(description, ''), '([0-9][0-9,\\.]+)\\s*(?:万元?|吨|件|小时|天|%|个月|季度)', 1), ', ') AS thresholds FROM v")
def _(T):
    return documents.enrich(T("v"), ["description"]).select("id", "thresholds")


@q("doc_09_injected_extractor", "SELECT id, CAST(length(converted_md) AS VARCHAR) AS size FROM uploaded_files WHERE converted_md IS NOT NULL")
def _(T):
    from tributary.queries.stubs import sizes

    return documents.structured_by(T("uploaded_files").filter("converted_md is not null"), "id", "converted_md", sizes, auto=True).select("id", c("fields")["size"].alias("size"))


@q("doc_10_deterministic_default", "SELECT DISTINCT id FROM uploaded_files WHERE trim(converted_md) <> ''")
def _(T):
    from tributary.queries.stubs import sizes

    return documents.structured_by(T("uploaded_files"), "id", "converted_md", sizes, auto=False).select("id").distinct()


@q("doc_11_combine", "SELECT ontology_id, string_agg('=== ' || id || ' ===' || chr(10) || converted_md, chr(10) || chr(10) ORDER BY id) AS combined FROM uploaded_files WHERE trim(converted_md, ' ' || chr(9) || chr(10) || chr(13)) <> '' AND NOT starts_with(converted_md, '[ERROR') AND NOT starts_with(converted_md, '[转换失败') AND NOT starts_with(converted_md, 'ERROR:') GROUP BY ontology_id")
def _(T):
    return documents.combined(T("uploaded_files"), "ontology_id", "id", "converted_md")


@q("prj_12_injected_document_ops", "SELECT id, CAST(length(converted_md) AS VARCHAR) AS size FROM uploaded_files WHERE converted_md IS NOT NULL")
def _(T):
    from tributary.queries.stubs import sizes

    pipeline.register("structurize_by_model", lambda df, params: documents.structured_by(df, "id", "converted_md", sizes, auto=True))
    return pipeline.OPERATIONS["structurize_by_model"](T("uploaded_files").filter("converted_md is not null"), {}).select("id", c("fields")["size"].alias("size"))


# rules and actions

_RULES = [
    {"name": "has_priority", "logic_type": "validation", "expression": {"operator": "required", "field": "o_orderpriority"}},
    {"name": "open", "expression": {"operator": "eq", "field": "o_orderstatus", "value": "O"}},
    {"name": "large", "expression": {"op": "gt", "field": "o_totalprice", "value": 100000}},
    {"name": "words", "expression": {"op": "gte", "field": "o_orderpriority", "value": 3}},
    {"name": "known", "expression": {"op": "in", "field": "o_orderstatus", "value": ["O", "F"]}},
    {"name": "declared", "logic_type": "mapping", "expression": {}},
    {"name": "counted", "logic_type": "validation", "expression": {"missing_count": 0}},
]


@q("prd_08_rule_evaluation", "SELECT o_orderkey, unnest(['has_priority','open','large','words','known','declared','counted']) AS rule, unnest(['completed','completed','completed','failed','completed','skipped','completed']) AS status, unnest([coalesce(o_orderpriority, '') <> '', o_orderstatus = 'O', o_totalprice > 100000, false, o_orderstatus IN ('O', 'F'), NULL, true]) AS passed FROM orders")
def _(T):
    return rules.evaluate(T("orders"), "o_orderkey", _RULES)


def _submissions(T):
    s = T("e").select("id", "ontology_id", c("target_entity").alias("target_id"), F.create_map(F.lit("reason"), F.when(c("confidence") > 0.5, "x").otherwise("")).alias("params"))
    return rules.submission_errors(s, ["reason"], [{"type": "required_target"}, {"type": "entity_exists"}, {"logic_type": "x"}], T("v"))


@q("prd_09_submission_criteria", "SELECT id, 'missing_parameter' AS type, 'reason' AS detail FROM e WHERE NOT coalesce(confidence > 0.5, false) UNION ALL SELECT id, 'required_target', 'target_id' FROM e WHERE target_entity IS NULL UNION ALL SELECT e.id, 'entity_exists', 'target_id' FROM e LEFT JOIN v ON v.id = e.target_entity AND v.ontology_id = e.ontology_id WHERE v.id IS NULL")
def _(T):
    return _submissions(T)


@q("prd_10_identifier_whitelist", "SELECT s_suppkey, regexp_full_match(s_name, '[A-Za-z_][A-Za-z0-9_$.]*') AS ok FROM supplier")
def _(T):
    return T("supplier").select("s_suppkey", c("s_name").rlike(r"^[A-Za-z_][A-Za-z0-9_$.]*$").alias("ok"))


@q("prd_11_read_only_guard", "SELECT * FROM (VALUES (true, false, false)) t(reads, writes, unscoped)")
def _(T):
    spark = T("region").sparkSession

    def allowed(text: str) -> bool:
        try:
            graph.guarded_query(spark, text, {"vertices": T("v")})
            return True
        except ValueError:
            return False

    rows = [tuple(allowed(x) for x in ("SELECT id FROM vertices WHERE ontology_id = 'x'", "DELETE FROM vertices WHERE ontology_id = 'x'", "SELECT id FROM vertices"))]
    return spark.createDataFrame(rows, "reads boolean, writes boolean, unscoped boolean")


@q("str_15_readable_formula", "SELECT row_id, CASE row_id % 3 WHEN 0 THEN '单价 必填（缺失 ' || load_no || ' 行）' WHEN 1 THEN '单价 gt ' || load_no ELSE 'order -[HAS_X]-> ' || feed END AS formula FROM purchase_orders")
def _(T):
    load, n = c("load_no").cast("string"), c("row_id") % 3
    expr = F.when(n == 0, F.create_map(F.lit("column"), F.lit("单价"), F.lit("missing_count"), load)).when(n == 1, F.create_map(F.lit("column"), F.lit("单价"), F.lit("operator"), F.lit("gt"), F.lit("value"), load)).otherwise(F.create_map(F.lit("src"), F.lit("order"), F.lit("rel_type"), F.lit("HAS_X"), F.lit("tgt"), c("feed")))
    return T("purchase_orders").select("row_id", rules.readable(F.when(n == 2, "inference").otherwise("validation"), expr, F.lit("Order")).alias("formula"))


@q("str_16_display_name", "SELECT id, left(coalesce(nullif(trim(name_cn), ''), nullif(trim(name_en), ''), id), 200) AS name FROM v")
def _(T):
    v = T("v").select("id", "name_cn", "name_en")
    return v.select("id", ontology.display_name(v.columns, "Entity", "id", F.lit(1)).alias("name"))


@q("qlt_04_validator", "SELECT kind, count(*) AS n FROM (SELECT 'missing_name' AS kind FROM v WHERE name_cn IS NULL OR trim(name_cn) = '' UNION ALL SELECT 'missing_type' FROM v WHERE type IS NULL OR trim(type) = '' UNION ALL SELECT 'unknown_type' FROM v WHERE type <> '' AND type NOT IN ('物料', '供应商', '客户') UNION ALL SELECT 'broken_end' FROM e WHERE source_entity IS NULL OR target_entity IS NULL OR source_entity NOT IN (SELECT id FROM v) OR target_entity NOT IN (SELECT id FROM v) UNION ALL SELECT DISTINCT 'broken_link' || substr(id, 1, 0) FROM (SELECT id, unnest(linked_logic_ids) AS x FROM a) WHERE false UNION ALL SELECT 'broken_link' FROM (SELECT DISTINCT id FROM (SELECT id, unnest(linked_logic_ids) AS x FROM a) WHERE x IS NOT NULL AND x NOT IN (SELECT id FROM r)) UNION ALL SELECT 'no_formula' FROM r WHERE formula IS NULL OR trim(formula) = '' UNION ALL SELECT 'repeated_name' FROM (SELECT ontology_id, name_cn FROM v WHERE trim(name_cn) <> '' GROUP BY 1, 2 HAVING count(*) > 1)) GROUP BY kind")
def _(T):
    return rules.issues(T("v"), T("e"), T("r"), T("a"), ["物料", "供应商", "客户"]).groupBy("kind").agg(F.count("*").alias("n"))


@q("qlt_05_ui_rules", "SELECT id, cardinality(properties) = 0 AS no_properties FROM v WHERE properties IS NOT NULL")
def _(T):
    return T("v").filter("properties is not null").select("id", (F.size("properties") == 0).alias("no_properties"))


@q("qlt_06_calibration", "SELECT id, round(greatest(0.30, least(0.98, coalesce(nullif(confidence, 0), 0.85) - CASE WHEN coalesce(cardinality(properties), 0) > 0 THEN 0 ELSE 0.10 END - CASE WHEN trim(coalesce(description, '')) = '' THEN 0.05 ELSE 0 END + CASE WHEN id IN (SELECT source_entity FROM e WHERE source_entity IS NOT NULL UNION ALL SELECT target_entity FROM e WHERE target_entity IS NOT NULL) THEN 0.05 ELSE 0 END)), 3) AS confidence FROM v")
def _(T):
    touched = graph.endpoints(T("e")).distinct().withColumn("g", F.lit(0.05))
    v = T("v").join(touched, "id", "left")
    adjust = F.coalesce("g", F.lit(0.0)) - F.when(F.size("properties") > 0, 0.0).otherwise(0.10) - F.when(F.trim(F.coalesce("description", F.lit(""))) == "", 0.05).otherwise(0.0)
    return v.select("id", merge.calibrated(F.nullif("confidence", F.lit(0.0)), adjust).alias("confidence"))


@q("qlt_07_bands", "SELECT id, CASE WHEN confidence >= 0.85 THEN 'high' WHEN confidence >= 0.6 THEN 'medium' ELSE 'low' END AS band FROM e")
def _(T):
    return T("e").select("id", merge.bands(c("confidence")).alias("band"))


def _runs(T):
    n = F.abs(F.hash("id")) % 5
    e = F.when(n == 0, "set_property").when(n == 1, "create_object").when(n == 2, "merge_relationship").when(n == 3, "delete_relationship").otherwise("notify")
    x = T("e").filter("source_entity is not null and target_entity is not null")
    return x.select(F.concat(F.lit("run-"), "id").alias("id"), c("created_at").alias("seq"), F.lit(True).alias("published"), (c("confidence") > 0.3).alias("enabled"), e.alias("effect"), F.when(n == 1, F.concat(F.lit("new-"), "id")).otherwise(c("target_entity")).alias("target_id"), "ontology_id", F.lit("state").alias("field"), c("type").alias("value"), c("source_entity").alias("source"), c("type").alias("relation"))


@q("act_01_runtime")
def _(T):
    v, e, log = rules.run_actions(T("v").drop("name_en"), T("e"), _runs(T))
    return v.agg(F.count("*").alias("vertices")).crossJoin(F.broadcast(e.agg(F.count("*").alias("edges")))).crossJoin(F.broadcast(log.groupBy("status").agg(F.count("*").alias("n"))))  # single rows


@q("act_02_publish", "SELECT id, CASE WHEN status = 'draft' AND confidence >= 0.8 THEN 'active' ELSE status END AS status, CASE WHEN status = 'retired' THEN false ELSE enabled END AS enabled FROM r")
def _(T):
    publish = (c("status") == "draft") & (c("confidence") >= 0.8)
    return catalog.reviewed(T("r"), publish).select("id", "status", "enabled")


@q("aud_01_audit_tools", "SELECT ontology_id, count(*) AS entities FROM v GROUP BY ontology_id")
def _(T):
    return audit.summary(T("v"), T("e")).select("ontology_id", "entities")


# mapping

_CUST = {"entity_class": "Customer", "primary_key": "c_custkey", "properties": {"c_custkey": ("c_custkey", "integer"), "c_name": ("c_name", "string"), "c_mktsegment": ("segment", "string")}}


@q("mpg_01_suggest", "SELECT * FROM (VALUES ('supplier_list', 'SupplierList', 'id', 3)) t(dataset, entity_class, primary_key, properties)")
def _(T):
    s = mapping.suggest("supplier_list", ["name", "id", "created_at"])
    return T("region").sparkSession.createDataFrame([("supplier_list", s["entity_class"], s["primary_key"], len(s["properties"]))], "dataset string, entity_class string, primary_key string, properties int")


@q("mpg_02_injected_suggestion", "SELECT * FROM (VALUES ('Given'), ('SupplierList')) t(entity_class)")
def _(T):
    out = [(mapping.suggest_or("supplier_list", ["id"], m)["entity_class"],) for m in (lambda d, cols: {"entity_class": "Given"}, lambda d, cols: 1 / 0)]
    return T("region").sparkSession.createDataFrame(out, "entity_class string")


@q("mpg_03_suggest_links", "SELECT * FROM (VALUES ('orders', 'customer_id', 'customers', 'HAS_CUSTOMER')) t(source, col, target, relation)")
def _(T):
    out = [(x["source"], x["column"], x["target"], x["relation"]) for x in mapping.suggest_links("orders", ["id", "customer_id", "amount"], ["customers", "parts", "orders"])]
    return T("region").sparkSession.createDataFrame(out, "source string, col string, target string, relation string")


@q("mpg_04_repair_key", "SELECT * FROM (VALUES ('Customer', 'c_custkey'), ('Order', 'o_custkey'), ('Thing', '__row_hash__')) t(entity_class, pk)")
def _(T):
    cases = [("Customer", "c_nationkey", T("customer").select("c_custkey", "c_nationkey", "c_mktsegment")), ("Order", "o_custkey", T("orders").select("o_custkey", "o_orderstatus")), ("Thing", "o_custkey", T("orders").select("o_custkey", "o_orderstatus"))]
    out = [(n, mapping.repaired_key({"entity_class": n, "primary_key": pk}, df)) for n, pk, df in cases]
    return T("region").sparkSession.createDataFrame(out, "entity_class string, pk string")


_U5 = "substr(x,1,8)||'-'||substr(x,9,4)||'-5'||substr(x,14,3)||'-'||substr('89ab89ab89ab89ab', 1 + (strpos('0123456789abcdef', substr(x,17,1)) - 1) % 4, 1)||substr(x,18,3)||'-'||substr(x,21,12)"
_SHA = "lower(sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({})))"


@q("mpg_05_instances", f"SELECT {_U5} AS id, segment, source_row_count FROM (SELECT {_SHA.format(chr(39) + 'o1:Customer:c_custkey:' + chr(39) + ' || c_custkey')} AS x, c_mktsegment AS segment, 1 AS source_row_count FROM customer)")
def _(T):
    return mapping.instances(T("customer"), "o1", _CUST).select("id", c("row_data")["segment"].alias("segment"), "source_row_count")


@q("mpg_06_first_row_wins", "SELECT \"供应商\" AS k, arg_min(row_id, row_id) AS row_id, count(*) AS source_row_count FROM purchase_orders WHERE trim(\"供应商\") <> '' GROUP BY 1")
def _(T):
    po = T("purchase_orders").filter("trim(`供应商`) <> ''").select(c("供应商").alias("k"), "row_id")
    return catalog.collapsed(po, "k", ["row_id"], ["row_id"])


@q("mpg_07_concepts", "SELECT substr(x,1,8)||'-'||substr(x,9,4)||'-'||substr(x,13,4)||'-'||substr(x,17,4)||'-'||substr(x,21,12) AS id, k AS entity_class FROM (SELECT k, md5('o1:' || k || ':concept') AS x FROM (VALUES ('Customer'), ('Nation')) t(k))")
def _(T):
    return mapping.concepts(T("region").sparkSession, "o1", ["Customer", "Nation", "Customer"]).select("id", "entity_class")


@q("mpg_08_apply_mapping", "SELECT c_mktsegment AS segment, count(*) AS n FROM customer GROUP BY 1")
def _(T):
    return mapping.instances(T("customer"), "o1", _CUST).groupBy(c("row_data")["segment"].alias("segment")).agg(F.count("*").alias("n"))


def _build(T, grain="instance"):
    pairs = [("supplier", "Supplier", "s_suppkey", "nation", "Nation", "n_nationkey"), ("customer", "Customer", "c_custkey", "nation", "Nation", "n_nationkey"), ("nation", "Nation", "n_nationkey", "region", "Region", "r_regionkey")]
    out = None
    for s, sc, sp, u, tc, tp in pairs:
        cand = mapping.fk_candidates(T(s), s, T(u), u, tp, sp)
        r = mapping.infer_relations(T(s), sc, sp, T(u), tc, tp, cand, "o1", grain)
        out = r if out is None else out.unionByName(r)
    return out


@q("mpg_09_build_all", "SELECT 'HAS_NATION' AS type, (SELECT count(*) FROM supplier) + (SELECT count(*) FROM customer) AS n UNION ALL SELECT 'HAS_REGION', (SELECT count(*) FROM nation)")
def _(T):
    return _build(T).groupBy("type").agg(F.count("*").alias("n"))


@q("mpg_09_build_all_summary", "SELECT 'concepts' AS part, 3 AS n UNION ALL SELECT 'instances', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) + (SELECT count(*) FROM region) UNION ALL SELECT 'relations', (SELECT count(*) FROM supplier) + (SELECT count(*) FROM nation) UNION ALL SELECT 'texts', 3")
def _(T):
    sets = [ontology.Dataset(n, T(n), {"entity_class": n.title(), "primary_key": pk}) for n, pk in (("supplier", "s_suppkey"), ("nation", "n_nationkey"), ("region", "r_regionkey"))]
    return ontology.build_all(T("region").sparkSession, "o1", sets)["summary"].filter("part not in ('rules', 'actions')")


@q("mpg_10_fk_detection", "SELECT * FROM (VALUES ('supplier', 's_nationkey', 'name'), ('orders', 'o_custkey', 'name')) t(dataset, col, how)")
def _(T):
    out = [("supplier", x["column"], x["how"]) for x in mapping.fk_candidates(T("supplier"), "supplier", T("nation"), "nation", "n_nationkey", "s_suppkey")]
    out += [("orders", x["column"], x["how"]) for x in mapping.fk_candidates(T("orders").select("o_orderkey", "o_custkey", "o_orderstatus"), "orders", T("customer"), "customer", "c_custkey", "o_orderkey")]
    return T("region").sparkSession.createDataFrame(out, "dataset string, col string, how string")


@q("mpg_11_relations", f"SELECT {_U5} AS id FROM (SELECT {_SHA.format(chr(39) + 'o1:Nation:n_nationkey:' + chr(39) + ' || n_nationkey')} AS x FROM nation)")
def _(T):
    return _build(T).filter("type = 'HAS_REGION'").select(c("source").alias("id"))


@q("mpg_11_concept_grain", "SELECT 'HAS_NATION' AS type, 2 AS n UNION ALL SELECT 'HAS_REGION', 1")
def _(T):
    return _build(T, "concept").groupBy("type").agg(F.count("*").alias("n"))


@q("mpg_12_confidence", "SELECT * FROM (VALUES ('fk', 0.85), ('same_name', 0.80), ('alt_key', 0.75), ('link', 0.90)) t(origin, confidence)")
def _(T):
    return T("region").sparkSession.createDataFrame(list(links.CONFIDENCE.items()), "origin string, confidence double")


@q("mpg_13_link_upsert", "SELECT DISTINCT l_suppkey AS s, l_partkey AS p FROM lineitem")
def _(T):
    have = T("lineitem").filter("l_quantity > 25").select(c("l_suppkey").alias("s"), c("l_partkey").alias("p")).distinct()
    return mapping.insert_new(have, T("lineitem").select(c("l_suppkey").alias("s"), c("l_partkey").alias("p")), ["s", "p"])


@q("mpg_14_discover_rules", "SELECT * FROM (VALUES ('mapping', 1), ('validation', 3), ('state', 1), ('inference', 1), ('automation', 1)) t(logic_type, n)")
def _(T):
    po = T("purchase_orders").select("row_id", c("供应商类别").alias("category"), c("质检结果").alias("result"), c("状态").alias("state"))
    m = mapping.suggest("purchase_order", po.columns)
    states = [r[0] for r in po.select("state").distinct().collect()]  # a handful of states
    found = mapping.discover_rules(m, mapping.facts_of(po, po.columns), {"state": sorted(states)}, [{"source": "A", "relation": "R", "target": "B"}])
    return po.sparkSession.createDataFrame([(r["logic_type"],) for r in found], "logic_type string").groupBy("logic_type").agg(F.count("*").alias("n"))


@q("mpg_15_discover_actions", "SELECT * FROM (VALUES ('create_object', 2), ('set_property', 7), ('merge_relationship', 1), ('delete_relationship', 1)) t(effect, n)")
def _(T):
    found = mapping.discover_actions(["A", "B"], {"state": []}, ["created_at"], [{"source": "A", "relation": "R", "target": "B"}])
    return T("region").sparkSession.createDataFrame([(a["effect"],) for a in found], "effect string").groupBy("effect").agg(F.count("*").alias("n"))


@q("mpg_16_fixed_rules", "SELECT id, name_cn FROM r UNION ALL SELECT 'fixed-1', '必填检查'")
def _(T):
    r = T("r").select("id", "name_cn")
    return mapping.insert_new(r, r.sparkSession.createDataFrame([("fixed-1", "必填检查"), ("fixed-1", "必填检查")], r.schema), ["name_cn"])


@q("mpg_17_extraction_merge", "SELECT name_cn, arg_min(id, (created_at, id)) AS id FROM v WHERE name_cn <> '' GROUP BY name_cn")
def _(T):
    v = T("v").filter("name_cn <> ''")
    union = exports.union_of([v.filter("type is null"), v.filter("type is not null")])
    return union.groupBy("name_cn").agg(F.min_by("id", F.struct("created_at", "id")).alias("id"))


@q("mpg_18_second_pass", "SELECT DISTINCT target_entity AS source_entity, source_entity AS target_entity, type FROM e WHERE source_entity IS NOT NULL AND target_entity IS NOT NULL EXCEPT SELECT source_entity, target_entity, type FROM e")
def _(T):
    e = T("e")
    return catalog.new_relations(e, e.select(c("target_entity").alias("source_entity"), c("source_entity").alias("target_entity"), "type"))


def _plan(T):
    v = latest(T("entities"), "ontology_id", "name_cn", "name_en", "type", "confidence")
    m = links.anchor_matches(v.filter("ontology_id <> 'o-sup-00000'"), v.filter("ontology_id = 'o-sup-00000'"))
    return mapping.link_plan(m, v.filter("ontology_id = 'o-sup-00000' and confidence > 0.5"))


@q("mpg_19_link_plan")
def _(T):
    return _plan(T)


@q("mpg_20_apply_plan")
def _(T):
    v, e = mapping.apply_plan(T("v"), T("e"), _plan(T))
    return v.select("id", F.lit("vertex").alias("kind")).unionByName(e.select("id", F.lit("edge").alias("kind")))


@q("mpg_21_anchor_import", "SELECT id FROM v")
def _(T):
    v = T("v").select("id")
    return mapping.insert_new(v.filter("id like '%5'"), v, ["id"])


@q("mpg_22_verdict", "SELECT n.name AS name, CASE WHEN count(DISTINCT v.id) = 0 THEN 'UNMATCHED' WHEN count(DISTINCT v.id) = 1 THEN 'MATCHED' ELSE 'AMBIGUOUS' END AS verdict FROM (SELECT DISTINCT unnest(linked_entities) AS name FROM a) n LEFT JOIN v ON v.name_cn = n.name GROUP BY 1")
def _(T):
    return mapping.verdict(T("a").select(F.explode("linked_entities").alias("name")), "name", T("v"), "name_cn", "id")


@q("mpg_23_constraints", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN CASE WHEN c_acctbal > 5000 THEN 'bounds reversed' ELSE '' END WHEN c_custkey % 3 = 1 THEN 'value required' ELSE '' END AS issues FROM customer")
def _(T):
    n = c("c_custkey") % 3
    kind = F.when(n == 0, "RANGE").otherwise("FIXED")
    out = mapping.target_violations(kind, F.when(n == 2, c("c_acctbal")), F.when(n == 0, c("c_acctbal")), F.when(n == 0, F.lit(5000.0)))
    return T("customer").select("c_custkey", F.array_join(out, ",").alias("issues"))


@q("mpg_24_calculation", "SELECT l_orderkey AS parent, round(sum(CASE WHEN l_linenumber % 2 = 1 THEN l_extendedprice ELSE -l_extendedprice END), 4) AS value FROM lineitem GROUP BY 1")
def _(T):
    li = T("lineitem").select(c("l_orderkey").alias("parent"), F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("child"), F.when(c("l_linenumber") % 2 == 1, "ADDEND").otherwise("SUBTRAHEND").alias("role"), c("l_extendedprice").alias("value"))
    li = li.withColumn("child", F.concat("child", F.lit("-"), F.row_number().over(Window.partitionBy("child").orderBy("value"))))
    return mapping.calculated(li.drop("value"), li.select("child", "value")).select("parent", F.round("value", 4).alias("value"))


# search


@q("sch_01_keyword", "SELECT id, name_cn AS name FROM v WHERE name_cn ILIKE '%阈值%' OR name_en ILIKE '%阈值%' OR description ILIKE '%阈值%' OR CAST(to_json(properties) AS VARCHAR) ILIKE '%阈值%'")
def _(T):
    return search.keyword(T("v"), "阈值").select("id", "name")


@q("sch_02_contains_ranked", "SELECT doc_id, length(text) AS size FROM documents WHERE contains(text, '复核') ORDER BY size DESC, doc_id")
def _(T):
    return T("documents").filter(c("text").contains("复核")).select("doc_id", F.length("text").alias("size")).orderBy(F.desc("size"), "doc_id")


def _first_vector(T):
    return [float(x) for x in T("embeddings").orderBy("vec_id").first()["embedding"]]


_COS = "list_dot_product(embedding::DOUBLE[], q::DOUBLE[]) / (sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])) * sqrt(list_dot_product(q::DOUBLE[], q::DOUBLE[])))"


@q("sch_03_semantic", f"SELECT vec_id, round({_COS}, 6) AS score FROM embeddings, (SELECT embedding AS q FROM embeddings ORDER BY vec_id LIMIT 1) ORDER BY {_COS} DESC, vec_id LIMIT 10")
def _(T):
    return search.nearest(T("embeddings"), "vec_id", "embedding", _first_vector(T), 10).select("vec_id", F.round("score", 6).alias("score"))


@q("sch_03_semantic_block", f"SELECT query, vec_id, round(s, 5) AS score FROM (SELECT q.vec_id AS query, x.vec_id AS vec_id, {_COS.replace('embedding', 'x.embedding').replace('q::', 'q.embedding::')} AS s FROM embeddings x, embeddings q WHERE q.vec_id % 50 = 0) QUALIFY row_number() OVER (PARTITION BY query ORDER BY s DESC, vec_id) <= 5")
def _(T):
    e = T("embeddings")
    return search.nearest_of_all(e, e.filter("vec_id % 50 = 0"), "vec_id", "embedding", 5).select("query", "vec_id", F.round("score", 5).alias("score"))


@q("sch_04_unified", "SELECT id FROM v WHERE name_cn ILIKE '%口径%' OR name_en ILIKE '%口径%' OR description ILIKE '%口径%' OR CAST(to_json(properties) AS VARCHAR) ILIKE '%口径%' ORDER BY id LIMIT 20")
def _(T):
    return search.unified(T("v"), "口径").select("id")


# pipelines

_DEFINITION = {
    "nodes": [{"id": "in", "type": "connector", "dataset": "purchase_orders"}, {"id": "store", "type": "storage"}, {"id": "fill", "type": "transform", "op": "fill_nulls"}, {"id": "agg", "type": "transform", "op": "group_by", "params": {"by": ["质检结果"], "measures": {"n": ("count", "row_id")}}}, {"id": "out", "type": "output"}],
    "edges": [{"source": a, "target": b} for a, b in (("in", "store"), ("store", "fill"), ("fill", "agg"), ("agg", "out"))],
}


@q("srt_07_topological", "SELECT * FROM (VALUES (0, 'in'), (1, 'store'), (2, 'fill'), (3, 'agg'), (4, 'out')) t(pos, node)")
def _(T):
    edges = [(e["source"], e["target"]) for e in reversed(_DEFINITION["edges"])]
    order = pipeline.topological(["out", "agg", "fill", "store", "in"], edges)
    return T("region").sparkSession.createDataFrame(list(enumerate(order)), "pos int, node string")


@q("prj_14_deep_merge", "SELECT '{\"a\": {\"x\": 2, \"y\": 1}, \"b\": 3}' AS spec")
def _(T):
    import json

    return T("region").sparkSession.createDataFrame([(json.dumps(pipeline.deep_merge({"a": {"x": 1, "y": 1}}, {"a": {"x": 2}, "b": 3})),)], "spec string")


@q("pip_01_pipeline_run", "SELECT CASE WHEN \"质检结果\" IS NULL OR trim(\"质检结果\") = '' THEN '' ELSE \"质检结果\" END AS \"质检结果\", count(*) AS n FROM purchase_orders GROUP BY 1")
def _(T):
    return pipeline.compile_pipeline(_DEFINITION, {"purchase_orders": T("purchase_orders").select("row_id", "质检结果")})["out"]


@q("win_08_page_loop", "SELECT CAST(i AS BIGINT) AS n FROM range(0, 950) t(i)")
def _(T):
    from tributary.queries.stubs import pages_of_numbers

    rows = [(r["n"],) for r in connectors.pages(pages_of_numbers, "numbers")]
    return T("region").sparkSession.createDataFrame(rows, "n long")


# incremental


@q("inc_01_delta", "SELECT o_orderkey FROM orders WHERE o_orderdate > TIMESTAMP '1997-01-01'")
def _(T):
    import datetime

    return incremental.delta(T("orders"), "o_orderdate", datetime.datetime(1997, 1, 1)).select("o_orderkey")


def _pipelines(T):
    return T("r").select(c("id").alias("pipeline"), c("ontology_id").alias("dataset"), "status", c("enabled").alias("on_dataset_version"), c("enabled").alias("auto_apply_on_review"))


@q("inc_02_triggered", "SELECT id AS pipeline FROM r WHERE enabled AND status <> 'disabled' AND ontology_id IN (SELECT ontology_id FROM uploaded_files)")
def _(T):
    return incremental.to_run(_pipelines(T), T("uploaded_files").select(c("ontology_id").alias("dataset"))).select("pipeline")


@q("inc_03_review_reset", "SELECT id, CASE WHEN status = 'active' AND ontology_id = 'o-sup-00000' THEN 'pending_review' WHEN status = 'active' THEN 'approved' ELSE status END AS status FROM r")
def _(T):
    cur = T("r").select("id", c("ontology_id").alias("dataset"), F.when(c("status") == "active", "approved").otherwise(c("status")).alias("status"))
    fresh = T("v").filter("ontology_id = 'o-sup-00000'").select(c("ontology_id").alias("dataset"))
    return incremental.reset_reviews(cur, fresh).select("id", "status")


@q("inc_04_auto_apply", "SELECT id AS pipeline FROM r WHERE enabled AND ontology_id IN (SELECT ontology_id FROM a WHERE status = 'active')")
def _(T):
    ok = T("a").select(c("ontology_id").alias("dataset"), F.when(c("status") == "active", "approved").otherwise("x").alias("status"))
    return incremental.mappings_to_apply(_pipelines(T), ok).select("pipeline")


@q("inc_05_idempotence", "SELECT count(*) AS once, count(*) AS twice FROM supplier")
def _(T):
    one = mapping.instances(T("supplier"), "o1", {**mapping.suggest("supplier", T("supplier").columns), "primary_key": "s_suppkey"})
    twice = one.unionByName(one).dropDuplicates(["id"])
    return one.agg(F.count("*").alias("once")).crossJoin(F.broadcast(twice.agg(F.count("*").alias("twice"))))  # single rows


@q("inc_07_versions", "SELECT load_no AS version_no, count(*) AS n FROM purchase_orders GROUP BY 1")
def _(T):
    po = T("purchase_orders").select("row_id", "load_no")
    at = _folder(po)
    versions = [r.load_no for r in po.select("load_no").distinct().collect()]  # one row a load
    for v in versions:
        exports.write_version(po.filter(c("load_no") == v).select("row_id"), at, v)
    return po.sparkSession.read.parquet(at).groupBy("version_no").agg(F.count("*").alias("n"))


@q("inc_08_append_and_snapshot", "SELECT 'append' AS mode, 2 * count(*) AS n FROM nation UNION ALL SELECT 'snapshot', count(*) FROM nation")
def _(T):
    n = T("nation")
    out = None
    for mode, how in (("append", "append"), ("snapshot", "overwrite")):
        at = _folder(n)
        for _ in range(2):
            n.write.mode(how).parquet(at)
        one = n.sparkSession.read.parquet(at).agg(F.lit(mode).alias("mode"), F.count("*").alias("n"))
        out = one if out is None else out.unionByName(one)
    return out


def _copy_of_events(T):
    e = T("events").select("event_id", "ts", "user_id", "event_type", "value")
    at = _folder(e)
    e.write.parquet(at)
    return e.sparkSession.readStream.schema(e.schema).parquet(at)


@q("ext_01_stream_cleanse", "SELECT event_id, event_type FROM events")
def _(T):
    s = _copy_of_events(T).select("event_id", "event_type")
    return incremental.run_available(cleansing.trim_strings(s, ["event_type"]))


@q("ext_02_stream_windows", "SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n FROM events GROUP BY ALL")
def _(T):
    return incremental.run_available(incremental.windowed_counts(_copy_of_events(T), "ts", "event_type"), "complete").select(c("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@q("ext_03_stream_distinct", "SELECT count(DISTINCT user_id) AS users FROM events")
def _(T):
    return incremental.run_available(incremental.distinct_within(_copy_of_events(T), "user_id", "ts").select("user_id")).agg(F.count("*").alias("users"))
