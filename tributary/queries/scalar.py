"""Queries of the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tributary.functions import text as t
from tributary.operators.profiling import DATE_LIKE
from tributary.queries.registry import Registry

q = Registry()
c = F.col


@q("str_01_fk_normalise", "SELECT id, upper(regexp_replace(source_entity, '[\\s\\-_]', '', 'g')) AS k FROM e")
def _(T):
    return T("e").select("id", t.key_normal(c("source_entity")).alias("k"))


@q("str_02_name_normalise", "SELECT DISTINCT name_cn, lower(regexp_replace(nfkc, '\\s+', '', 'g')) AS n FROM (SELECT name_cn, replace(replace(name_cn, '（', '('), '）', ')') AS nfkc FROM entities WHERE regexp_full_match(name_cn, '[\\x20-\\x7e一-龥（）]*'))")
def _(T):
    return T("entities").filter(c("name_cn").rlike("^[\\x20-\\x7e一-龥（）]*$")).select("name_cn", t.name_normal(c("name_cn")).alias("n")).distinct()


_ABBR = "'^(.+?)[\\s（(]+([A-Za-z][A-Za-z0-9-]*)[\\s）)]\\s*$'"


@q("str_03_abbreviation", f"SELECT id, CASE WHEN regexp_matches(trim(x), {_ABBR}) THEN trim(regexp_extract(trim(x), {_ABBR}, 1)) ELSE trim(x) END AS base, CASE WHEN regexp_matches(trim(x), {_ABBR}) THEN regexp_extract(trim(x), {_ABBR}, 2) ELSE '' END AS abbr FROM (SELECT id, name_cn || '（' || coalesce(name_en, 'X') || '）' AS x FROM v)")
def _(T):
    base, abbr = t.abbreviation(F.concat("name_cn", F.lit("（"), F.coalesce("name_en", F.lit("X")), F.lit("）")))
    return T("v").select("id", base.alias("base"), abbr.alias("abbr"))


@q("str_04_slugify", "SELECT p_partkey, coalesce(nullif(trim(regexp_replace(lower(trim(p_name)), '[^a-z0-9]+', '_', 'g'), '_'), ''), 'unknown') AS s FROM part")
def _(T):
    return T("part").select("p_partkey", t.slug(c("p_name")).alias("s"))


@q("str_05_class_name", "SELECT p_partkey, array_to_string(list_transform(list_filter(regexp_split_to_array(p_type || '-' || p_name, '[_\\-\\s]+'), lambda x: x <> ''), lambda x: upper(x[1]) || lower(x[2:])), '') AS s FROM part")
def _(T):
    return T("part").select("p_partkey", t.class_name(F.concat_ws("-", "p_type", "p_name")).alias("s"))


@q("str_06_camel_spaced", "SELECT id, name_en, upper(regexp_replace(name_en, '([a-z0-9])([A-Z])', '\\1_\\2', 'g')) AS snake FROM r WHERE name_en IS NOT NULL")
def _(T):
    return T("r").filter(c("name_en").isNotNull()).select("id", "name_en", t.camel_upper_snake(c("name_en")).alias("snake"))


@q("str_06_camel_title")
def _(T):
    return T("r").select("id", t.camel_spaced(c("name_en")).alias("title"))


@q("str_07_property_name", "SELECT p_partkey, lower(replace(p_type, ' ', '_')) AS s FROM part")
def _(T):
    return T("part").select("p_partkey", t.property_name(c("p_type")).alias("s"))


@q("str_08_cjk", "SELECT id, regexp_matches(name_cn, '[一-鿿]') AS cjk FROM v")
def _(T):
    return T("v").select("id", t.has_cjk(c("name_cn")).alias("cjk"))


@q("str_09_safe_token", "SELECT id, regexp_replace(coalesce(nullif(type, ''), 'unknown'), '[^\\p{L}\\p{N}_]', '_', 'g') AS token FROM e")
def _(T):
    return T("e").select("id", t.safe_token(c("type")).alias("token"))


@q("str_10_escaping", "SELECT doc_id, '''' || replace(replace(replace(replace(replace(text, '\\', '\\\\'), '''', '\\'''), chr(10), '\\n'), chr(13), '\\r'), chr(9), '\\t') || '''' AS cypher, replace(replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;') AS html FROM documents")
def _(T):
    return T("documents").select("doc_id", t.cypher_string(c("text")).alias("cypher"), t.html_escape(c("text")).alias("html"))


@q("str_11_truncate", "SELECT doc_id, left(text, 200) AS short, left(text, 2000) AS body FROM documents")
def _(T):
    return T("documents").select("doc_id", F.left("text", F.lit(200)).alias("short"), F.left("text", F.lit(2000)).alias("body"))


@q("str_12_sequence_ratio")
def _(T):
    return T("v").filter("name_en is not null").select("id", t.sequence_ratio(c("name_cn"), c("name_en")).alias("ratio"))


_ORG = "list_filter(regexp_extract_all(text, '([一-龥]{2,10}(?:公司|集团|科技|物流|铝业|五金|包装|原材料))', 1), lambda x: true)"


@q("str_13_thresholds", "SELECT doc_id, array_to_string(regexp_extract_all(text, '([0-9][0-9,\\.]+)\\s*(?:万元?|吨|件|小时|天|%|个月|季度)', 1), ', ') AS thresholds FROM documents")
def _(T):
    return T("documents").select("doc_id", t.thresholds(c("text"), None).alias("thresholds"))


@q("str_13_organisations", f"SELECT doc_id, (SELECT coalesce(string_agg(x, ', ' ORDER BY i), '') FROM (SELECT x, min(i) AS i FROM (SELECT unnest(l) AS x, generate_subscripts(l, 1) AS i FROM (SELECT {_ORG} AS l)) GROUP BY x)) AS organisations FROM documents")
def _(T):
    return T("documents").select("doc_id", t.organisations(c("text"), None).alias("organisations"))


@q("str_14_id_pattern", "SELECT row_id, regexp_full_match(\"订单号\", '[A-Za-z]+[-_]?[0-9]+') OR regexp_full_match(\"订单号\", '[A-Za-z]+[0-9_\\-]+[0-9]+') AS order_id, regexp_full_match(\"物料编码\", '[A-Za-z]+[-_]?[0-9]+') OR regexp_full_match(\"物料编码\", '[A-Za-z]+[0-9_\\-]+[0-9]+') AS material_id FROM purchase_orders")
def _(T):
    return T("purchase_orders").select("row_id", t.looks_like_id(c("订单号")).alias("order_id"), t.looks_like_id(c("物料编码")).alias("material_id"))


@q("str_17_shared_characters", "SELECT v.id AS id, len(list_distinct(list_intersect(string_split(v.name_cn, ''), string_split(o.name_cn, '')))) AS n FROM v JOIN r o ON o.ontology_id = v.ontology_id AND o.id = (SELECT min(x.id) FROM r x WHERE x.ontology_id = v.ontology_id)")
def _(T):
    first = T("r").groupBy("ontology_id").agg(F.min_by("name_cn", "id").alias("rule"))
    return T("v").join(first, "ontology_id").select("id", t.shared_characters(c("name_cn"), c("rule")).alias("n"))


@q("dat_01_date_detection", "SELECT row_id, regexp_matches(trim(\"下单日期\"), '^[0-9]{4}[-/][0-9]{1,2}[-/][0-9]{1,2}|^[0-9]{1,2}[-/][0-9]{1,2}[-/][0-9]{4}|^[0-9]{8}$') AS is_date FROM purchase_orders")
def _(T):
    return T("purchase_orders").select("row_id", t.strip(c("下单日期")).rlike(DATE_LIKE).alias("is_date"))


@q("dat_02_period", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS m, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS q, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders")
def _(T):
    return T("orders").select("o_orderkey", *[t.period_key(c("o_orderdate"), k).alias(a) for k, a in (("MONTH", "m"), ("QUARTER", "q"), ("YEAR", "y"))])


@q("dat_03_cron", "SELECT e AS expression, regexp_full_match(trim(e), '(\\*|[0-9,\\-\\*/]+)\\s+(\\*|[0-9,\\-\\*/]+)\\s+(\\*|[0-9,\\-\\*/]+)\\s+(\\*|[0-9,\\-\\*/]+)\\s+(\\*|[0-9,\\-\\*/]+)') AS valid FROM (SELECT DISTINCT CASE WHEN p_size % 5 = 0 THEN '*/' || p_size || ' * * * *' WHEN p_size % 5 = 1 THEN '0 ' || p_size % 24 || ' * * *' WHEN p_size % 5 = 2 THEN 'bad ' || p_size WHEN p_size % 5 = 3 THEN '* * * * *' ELSE '5 4 ' || p_size || ' * 1' END AS e FROM part)")
def _(T):
    s, n = c("p_size").cast("string"), c("p_size") % 5
    e = F.when(n == 0, F.concat(F.lit("*/"), s, F.lit(" * * * *"))).when(n == 1, F.concat(F.lit("0 "), (c("p_size") % 24).cast("string"), F.lit(" * * *"))).when(n == 2, F.concat(F.lit("bad "), s)).when(n == 3, "* * * * *").otherwise(F.concat(F.lit("5 4 "), s, F.lit(" * 1")))
    return T("part").select(e.alias("expression")).distinct().select("expression", t.cron(c("expression"))["valid"].alias("valid"))


@q("dat_03_cron_description")
def _(T):
    e = F.concat(F.lit("0 "), (c("p_size") % 24).cast("string"), F.lit(" * * *"))
    return T("part").select(e.alias("expression")).distinct().select("expression", *[x.alias(k) for k, x in t.cron(c("expression")).items()])


@q("mth_01_round_clamp", "SELECT id, round(confidence, 2) AS r2, round(greatest(0.3, least(0.98, confidence - 0.1)), 3) AS clamped FROM e")
def _(T):
    return T("e").select("id", F.round("confidence", 2).alias("r2"), F.round(t.clamp(c("confidence") - 0.1, 0.3, 0.98), 3).alias("clamped"))


@q("mth_02_percent", "SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 2 = 0 THEN l_discount * 100 / 100 ELSE l_discount END AS stored FROM lineitem")
def _(T):
    unit = F.when(c("l_linenumber") % 2 == 0, "PERCENT").otherwise("RATIO")
    v = F.when(unit == "PERCENT", c("l_discount") * 100).otherwise(c("l_discount"))
    return T("lineitem").select("l_orderkey", "l_linenumber", t.stored_value(v, unit).alias("stored"))


@q("arr_01_split_cell", "SELECT id, list_filter(list_transform(regexp_split_to_array(description, '[,，、;；|]'), lambda x: trim(x)), lambda x: x <> '') AS parts FROM v WHERE description IS NOT NULL")
def _(T):
    return T("v").filter("description is not null").select("id", t.split_cell(c("description")).alias("parts"))


_OLD = "l-000000010"


@q("arr_02_replace_in_list", f"SELECT id, (SELECT list(x ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT CASE WHEN y = '{_OLD}' THEN 'l-new' ELSE y END AS x, i FROM (SELECT unnest(linked_logic_ids) AS y, generate_subscripts(linked_logic_ids, 1) AS i)) GROUP BY x)) AS ids FROM a WHERE len(linked_logic_ids) > 0")
def _(T):
    return T("a").filter(F.size("linked_logic_ids") > 0).select("id", t.replace_in_list(c("linked_logic_ids"), _OLD, "l-new").alias("ids"))


@q("arr_03_add_alias", "SELECT id, CASE WHEN name_en IS NULL OR name_en = '' OR name_en = name_cn THEN [type] WHEN name_en = type THEN [type] ELSE [type, name_en] END AS aliases FROM v WHERE type IS NOT NULL")
def _(T):
    return T("v").filter("type is not null").select("id", t.add_alias(F.array("type"), c("name_en"), c("name_cn")).alias("aliases"))


@q("map_01_merge", "SELECT id, coalesce(properties['来源'], 'x') AS existing_wins, 'x' AS new_wins FROM v")
def _(T):
    new, old = F.create_map(F.lit("来源"), F.lit("x")), F.coalesce(c("properties"), F.create_map().cast("map<string,string>"))
    keep = lambda first, second: F.map_concat(F.map_filter(first, lambda k, _: ~F.array_contains(F.map_keys(second), k)), second)
    return T("v").select("id", F.element_at(keep(new, F.map_filter(old, lambda k, x: x.isNotNull())), "来源").alias("existing_wins"), F.element_at(keep(old, new), "来源").alias("new_wins"))


@q("map_02_row_to_map", "SELECT c_custkey, to_json({'c_mktsegment': c_mktsegment, 'c_name': c_name}) AS props FROM customer")
def _(T):
    full = F.create_map(F.lit("c_mktsegment"), c("c_mktsegment"), F.lit("c_name"), c("c_name"), F.lit("__row"), F.lit("1"))
    return T("customer").select("c_custkey", F.to_json(F.map_filter(full, lambda k, _: ~k.startswith("__"))).alias("props"))


@q("jsn_03_canonical_row", "SELECT n_nationkey, to_json({'n_name': n_name, 'n_nationkey': n_nationkey, 'n_regionkey': n_regionkey}) AS row FROM nation")
def _(T):
    return T("nation").select("n_nationkey", t.canonical_json(["n_nationkey", "n_name", "n_regionkey"]).alias("row"))


@q("jsn_04_tolerant_json", "SELECT event_id, CAST(CAST(props::JSON->>'k' AS BIGINT) AS VARCHAR) AS k FROM events")
def _(T):
    reply = F.concat(F.lit("Here:\n```json\n"), F.replace("props", F.lit("}"), F.lit(",}")), F.lit("\n```"))
    return T("events").select("event_id", F.get_json_object(t.tolerant_json(reply), "$.k").alias("k"))


@q("jsn_05_json_contains", "SELECT id FROM v WHERE CAST(to_json(properties) AS VARCHAR) ILIKE '%采购%'")
def _(T):
    return T("v").filter(F.to_json("properties").ilike("%采购%")).select("id")


_UUID = """WITH h AS (SELECT {key}, lower(sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode({name}))) AS x FROM {table})
SELECT {key}, substr(x,1,8)||'-'||substr(x,9,4)||'-5'||substr(x,14,3)||'-'||substr('89ab89ab89ab89ab', 1 + (strpos('0123456789abcdef', substr(x,17,1)) - 1) % 4, 1)||substr(x,18,3)||'-'||substr(x,21,12) AS uid FROM h"""


@q("hsh_01_row_id", _UUID.format(key="c_custkey", name="'o1:Customer:c_custkey:' || c_custkey", table="customer"))
def _(T):
    return T("customer").select("c_custkey", t.row_id(F.lit("o1"), F.lit("Customer"), t.row_identity("c_custkey", ["c_custkey", "c_name"])).alias("uid"))


@q("hsh_02_relation_id", _UUID.format(key="id", name="concat(ontology_id, ':', coalesce(source_entity, '-'), ':', type, ':', coalesce(target_entity, '-'), ':fk')", table="e"))
def _(T):
    return T("e").select("id", t.relation_id(c("ontology_id"), F.coalesce("source_entity", F.lit("-")), c("type"), F.coalesce("target_entity", F.lit("-")), F.lit("fk")).alias("uid"))


_MD5 = "substr(x,1,8)||'-'||substr(x,9,4)||'-'||substr(x,13,4)||'-'||substr(x,17,4)||'-'||substr(x,21,12)"


@q("hsh_03_concept_id", f"SELECT ontology_id, type, {_MD5} AS uid FROM (SELECT DISTINCT ontology_id, type, md5(ontology_id || ':' || type || ':concept') AS x FROM v WHERE type IS NOT NULL)")
def _(T):
    return T("v").filter("type is not null").select("ontology_id", "type").distinct().withColumn("uid", t.concept_id(c("ontology_id"), c("type")))


@q("hsh_04_instance_id", f"SELECT id, {_MD5} AS uid FROM (SELECT id, md5(concat_ws(':', ontology_id, type, name_cn)) AS x FROM v)")
def _(T):
    return T("v").select("id", t.instance_id(c("ontology_id"), c("type"), c("name_cn")).alias("uid"))


@q("hsh_05_canonical_id", "SELECT id, 'custom:' || coalesce(nullif(trim(regexp_replace(lower(coalesce(name_en, '')), '[^a-z0-9]+', '_', 'g'), '_'), ''), left(md5(coalesce(name_cn, '')), 10)) AS cid FROM v")
def _(T):
    return T("v").select("id", t.canonical_id("custom", c("name_en"), c("name_cn")).alias("cid"))
