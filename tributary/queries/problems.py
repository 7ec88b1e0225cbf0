"""Queries of the general data problems: failed rows, orphan references, column profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.operators import column_profile as profile
from tributary.operators import orphan_refs as refs
from tributary.operators import strict_load as load
from tributary.plans.tables import table


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return load.rejects(table(spark, d, "raw_orders")).select("raw_id", "reason")


def p1_orders(spark: SparkSession, d: str) -> DataFrame:
    return load.typed_orders(table(spark, d, "raw_orders")).select("raw_id", *[F.col(c).cast("double").alias(c) if k.startswith("number") else F.col(c) for c in load.ORDER_FIELDS for k in [load.ORDER_KINDS.get(c, "")]])


def p1_failed_fields(spark: SparkSession, d: str) -> DataFrame:
    bad = load.rejects(table(spark, d, "raw_orders")).filter("reason = 'value'")
    return bad.select("raw_id", "failed_field", "line")


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    raw = table(spark, d, "raw_orders")
    bad = load.rejects(raw).select("raw_id", "reason")
    return raw.select("raw_id", "source_file").join(bad, "raw_id").groupBy("source_file", "reason").agg(F.count("*").alias("n"))


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return refs.ontology_orphans(*[table(spark, d, t) for t in ("entities", "logic_rules", "relations", "actions")])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d)


def p4_report(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).groupBy("table_name", "field_name", "period", "kind").agg(F.count("*").alias("n"))


LOAD = ["feed", "load_no"]


def _values(spark: SparkSession, d: str) -> DataFrame:
    return profile.values(table(spark, d, "purchase_orders"), profile.COLUMNS, LOAD)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    of_categories = profile.values(table(spark, d, "purchase_orders"), profile.CATEGORIES, LOAD)
    return profile.findings(_values(spark, d), table(spark, d, "column_quality"), of_categories=of_categories)


def p5_profile(spark: SparkSession, d: str) -> DataFrame:
    p = profile.profile(profile.mask_table(_values(spark, d), LOAD), LOAD)
    return p.select(*LOAD, "column_name", "rows", "null_count", F.round("null_pct", 6).alias("null_pct"), "distinct_count", "inferred_type", "min_number", "max_number", "n_violations")


def p5_patterns(spark: SparkSession, d: str) -> DataFrame:
    return profile.pattern_report(_values(spark, d))


def p5_rare_values(spark: SparkSession, d: str) -> DataFrame:
    return profile.rare_values(_values(spark, d), LOAD)


QUERIES = {f.__name__: f for f in (p1_found, p1_orders, p1_failed_fields, p1_report, p4_found, p4_report, p5_found, p5_profile, p5_patterns, p5_rare_values)}


# SQL


def _p1_sql() -> tuple[str, list[str], str]:
    def per_sep(make) -> str:
        return "CASE sep " + " ".join(f"WHEN {lit} THEN {make(rx)}" for lit, rx in (("','", ","), ("';'", ";"), ("'|'", "[|]"), ("chr(9)", r"\t"))) + " END"

    field = lambda rx: '(?:"[^"]*(?:""[^"]*)*"|[^"%s]*)' % rx.strip("[]")
    quoted_well = per_sep(lambda rx: f"regexp_full_match(sep || line, '(?:{rx}{field(rx)})+')")
    fields = per_sep(lambda rx: f"regexp_extract_all(sep || line, '{rx}({field(rx)})', 1)")
    date = lambda v: (
        f"coalesce(CASE WHEN regexp_full_match({v}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN TRY_CAST({v} AS DATE) "
        f"WHEN regexp_full_match({v}, '[0-9]{{4}}/[0-9]{{1,2}}/[0-9]{{1,2}}') THEN TRY_CAST(replace({v}, '/', '-') AS DATE) "
        f"WHEN regexp_full_match({v}, '[0-9]{{8}}') THEN TRY_CAST(substr({v},1,4)||'-'||substr({v},5,2)||'-'||substr({v},7,2) AS DATE) END, NULL)"
    )
    number = lambda v: f"regexp_full_match({v}, '-?([0-9]{{1,3}}(,[0-9]{{3}})+|[0-9]+)([.][0-9]+)?')"
    at = {c: f"f[{i + 1}]" for i, c in enumerate(load.ORDER_FIELDS)}
    ok = [f"regexp_full_match({at['订单号']}, 'PO-20[0-9]{{2}}(0[1-9]|1[0-2])-[0-9]{{4,}}')", f"{date(at['下单日期'])} IS NOT NULL"]
    ok += [f"({at[c]} = '' OR {date(at[c])} IS NOT NULL)" for c in ("要求交货期", "实际到货期")] + [f"({at[c]} = '' OR {number(at[c])})" for c in ("数量", "单价", "总金额")]
    typed = [f"{date(at[c])} AS \"{c}\"" if k.startswith("date") else f"TRY_CAST(replace({at[c]}, ',', '') AS DOUBLE) AS \"{c}\"" if k.startswith("number") else f"nullif({at[c]}, '') AS \"{c}\"" for c in load.ORDER_FIELDS for k in [load.ORDER_KINDS.get(c, "")]]
    return f"""
WITH lines AS (SELECT raw_id, source_file, sep, regexp_replace(c0, '\\r$', '') AS line FROM raw_orders WHERE line_no <> 0),
records AS (SELECT * FROM lines WHERE line <> '' AND NOT starts_with(line, '#')),
parsed AS (SELECT *, {quoted_well} AS quoted_well, list_transform({fields}, lambda x: trim(CASE WHEN starts_with(x, '"') THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END)) AS f FROM records),
judged AS (SELECT *, CASE WHEN NOT quoted_well THEN 'quoting' WHEN len(f) <> 17 THEN 'column_count' WHEN NOT ({" AND ".join(ok)}) THEN 'value' END AS reason FROM parsed)
""", typed, "CASE " + " ".join(f"WHEN NOT ({o}) THEN '{n}'" for o, n in zip(ok, ["订单号", "下单日期", "要求交货期", "实际到货期", "数量", "单价", "总金额"], strict=True)) + " END"


_P1, _TYPED, _FAILED = _p1_sql()

_P4 = """
WITH latest AS (
  SELECT lower(trim(id)) AS id, lower(trim(ontology_id)) AS ontology_id, trim(name_cn) AS name, created_at, deleted_at FROM entities
  QUALIFY row_number() OVER (PARTITION BY lower(trim(id)) ORDER BY updated_at DESC NULLS LAST, version DESC) = 1),
parents AS (
  SELECT 'entity' AS space, '' AS scope, id AS k, created_at, deleted_at FROM latest
  UNION ALL SELECT 'name', ontology_id, name, created_at, deleted_at FROM latest
  UNION ALL SELECT 'rule', '', lower(trim(id)), created_at, deleted_at FROM logic_rules),
keyed AS (SELECT space, scope, k, min(created_at) FILTER (WHERE deleted_at IS NULL) AS first_live FROM parents WHERE k <> '' GROUP BY ALL),
refs AS (
  SELECT 'relations' AS table_name, 'source_entity' AS field_name, 'entity' AS space, '' AS scope, id AS row_key, source_entity AS ref_key, created_at FROM relations
  UNION ALL SELECT 'relations', 'target_entity', 'entity', '', id, target_entity, created_at FROM relations
  UNION ALL SELECT 'actions', 'linked_entities', 'name', lower(trim(ontology_id)), id, unnest(linked_entities), created_at FROM actions
  UNION ALL SELECT 'actions', 'linked_logic_ids', 'rule', '', id, unnest(linked_logic_ids), created_at FROM actions),
judged AS (
  SELECT r.*, CASE WHEN p.k IS NULL THEN 'missing' WHEN p.first_live IS NULL THEN 'deleted' WHEN p.first_live > r.created_at THEN 'late' END AS kind
  FROM refs r LEFT JOIN keyed p ON p.space = r.space AND p.scope = r.scope AND p.k = CASE WHEN r.space = 'name' THEN trim(r.ref_key) ELSE lower(trim(r.ref_key)) END
  WHERE trim(r.ref_key) <> ''),
found AS (SELECT DISTINCT table_name, field_name, row_key, ref_key, kind, strftime(created_at, '%Y-%m') AS period FROM judged WHERE kind IS NOT NULL)
"""


def _p5_sql() -> str:
    cells = " UNION ALL ".join(f"SELECT feed, load_no, '{c}' AS column_name, \"{c}\" AS value FROM purchase_orders" for c in profile.COLUMNS)
    forms = "CASE column_name WHEN '订单号' THEN regexp_full_match(t, 'PO-[0-9]{6}-[0-9]{4,}') WHEN '物料编码' THEN regexp_full_match(t, '[A-Z]{2}-[A-Z]{2}-[0-9]{3}') WHEN '下单日期' THEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') WHEN '要求交货期' THEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') WHEN '实际到货期' THEN regexp_full_match(t, '[0-9]{4}-[0-9]{2}-[0-9]{2}') END"
    listed = lambda names: ", ".join(f"'{n}'" for n in names)
    return f"""
WITH cells AS ({cells}),
v AS (SELECT feed, load_no, column_name, value, nullif(trim(value), '') AS t, regexp_full_match(trim(value), '[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)') AS is_number FROM cells),
p AS (
  SELECT feed, load_no, column_name, count(*) AS rows, count(*) - count(t) AS null_count, (count(*) - count(t)) * 100.0 / count(*) AS null_pct,
    count(DISTINCT CASE WHEN t IS NOT NULL THEN value END) AS distinct_count, count(t) AS filled,
    count(*) FILTER (WHERE t IS NOT NULL AND is_number) AS n_number, count(*) FILTER (WHERE regexp_full_match(t, '[+-]?[0-9]+')) AS n_integer, count(*) FILTER (WHERE lower(t) IN ('true', 'false')) AS n_boolean,
    min(CASE WHEN is_number THEN TRY_CAST(t AS DOUBLE) END) AS min_number, max(CASE WHEN is_number THEN TRY_CAST(t AS DOUBLE) END) AS max_number,
    count(*) FILTER (WHERE t IS NOT NULL AND NOT {forms}) AS n_violations
  FROM v GROUP BY feed, load_no, column_name),
profile AS (SELECT *, CASE WHEN filled = 0 THEN 'null' WHEN n_integer = filled THEN 'integer' WHEN n_number = filled THEN 'float' WHEN n_boolean = filled THEN 'boolean' WHEN n_number = 0 AND n_boolean = 0 THEN 'string' ELSE 'mixed' END AS inferred_type FROM p),
shares AS (SELECT feed, load_no, column_name, t, count(*) / sum(count(*)) OVER (PARTITION BY feed, load_no, column_name) AS share FROM v WHERE t IS NOT NULL AND column_name IN ({listed(profile.CATEGORIES)}) GROUP BY feed, load_no, column_name, t),
pairs AS (SELECT feed, load_no, column_name, t, share, 0 AS former FROM shares UNION ALL SELECT feed, load_no + 1, column_name, t, 0, share FROM shares),
drift AS (SELECT feed, load_no, column_name, sum(abs(d)) / 2 AS divergence FROM (SELECT feed, load_no, column_name, t, sum(share) - sum(former) AS d FROM pairs GROUP BY feed, load_no, column_name, t) GROUP BY feed, load_no, column_name HAVING sum(d) BETWEEN -0.001 AND 0.001),
x AS (
  SELECT n.*, b.null_pct AS b_null_pct, b.inferred_type AS b_type, b.distinct_count AS b_distinct, b.min_number AS b_min, b.max_number AS b_max, d.divergence, r.name AS r_name, r.null_count AS r_null_count, r.null_pct AS r_null_pct, r.distinct_count AS r_distinct, r.inferred_type AS r_type
  FROM profile n LEFT JOIN profile b ON b.feed = n.feed AND b.load_no + 1 = n.load_no AND b.column_name = n.column_name
  LEFT JOIN drift d ON d.feed = n.feed AND d.load_no = n.load_no AND d.column_name = n.column_name
  LEFT JOIN column_quality r ON r.feed = n.feed AND r.load_no = n.load_no AND r.name = n.column_name),
found AS (
  SELECT feed, load_no, column_name, 'null_rate' AS finding FROM x WHERE abs(null_pct - b_null_pct) >= 10 - 1e-9
  UNION ALL SELECT feed, load_no, column_name, 'type' FROM x WHERE inferred_type <> b_type
  UNION ALL SELECT feed, load_no, column_name, 'distinct' FROM x WHERE distinct_count * 2 < b_distinct OR distinct_count > 2 * b_distinct
  UNION ALL SELECT feed, load_no, column_name, 'range' FROM x WHERE column_name IN ({listed(profile.RANGED)}) AND (max_number > 5 * b_max OR (min_number < 0 AND b_min >= 0))
  UNION ALL SELECT feed, load_no, column_name, 'drift' FROM x WHERE divergence >= 0.2 - 1e-9
  UNION ALL SELECT feed, load_no, column_name, 'pattern' FROM x WHERE n_violations * 20 > filled
  UNION ALL SELECT feed, load_no, column_name, 'recorded' FROM x WHERE r_name IS NOT NULL AND (r_null_count <> null_count OR r_distinct <> distinct_count OR r_type <> inferred_type OR abs(r_null_pct - null_pct) > 0.01))
"""


_P5 = _p5_sql()

_P5_MASKS = (
    "WITH cells AS ("
    + " UNION ALL ".join(f"SELECT feed, load_no, '{c}' AS column_name, \"{c}\" AS value FROM purchase_orders" for c in profile.COLUMNS)
    + """),
v AS (
  SELECT feed, load_no, column_name, value, trim(value) AS t,
    regexp_replace(translate(CASE WHEN column_name = '订单号' AND starts_with(trim(value), 'PO-') THEN substr(trim(value), 4) ELSE trim(value) END,
      '0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz', '9999999999AAAAAAAAAAAAAAAAAAAAAAAAAAaaaaaaaaaaaaaaaaaaaaaaaaaa'), '\\p{Han}', '汉', 'g') AS rest
  FROM cells WHERE trim(value) <> ''),
m AS (SELECT *, CASE WHEN column_name = '订单号' AND starts_with(t, 'PO-') THEN 'PO-' || rest ELSE rest END AS mask FROM v),
masks AS (SELECT feed, load_no, column_name, mask, count(*) AS n FROM m GROUP BY ALL),
judged AS (SELECT *, sum(n) OVER (PARTITION BY feed, load_no, column_name) AS total, n >= 0.05 * sum(n) OVER (PARTITION BY feed, load_no, column_name) AS dominant FROM masks),
pairs AS (
  SELECT feed, load_no, column_name, mask, n / total AS now, 0 AS former FROM judged
  UNION ALL SELECT feed, load_no + 1, column_name, mask, 0, n / total FROM judged),
changed AS (SELECT feed, load_no, column_name, mask, sum(now) AS now, sum(former) AS former FROM pairs GROUP BY ALL),
moved AS (SELECT feed, load_no, column_name, sum(abs(now - former)) / 2 AS divergence FROM changed GROUP BY ALL HAVING sum(now) > 0 AND sum(former) > 0)
"""
)

SQL = {
    "p1_found": _P1 + "SELECT raw_id, reason FROM judged WHERE reason IS NOT NULL",
    "p1_orders": _P1 + "SELECT raw_id, " + ", ".join(_TYPED) + " FROM judged WHERE reason IS NULL",
    "p1_failed_fields": _P1 + f"SELECT raw_id, {_FAILED} AS failed_field, line FROM judged WHERE reason = 'value'",
    "p1_report": _P1 + "SELECT source_file, reason, count(*) AS n FROM judged WHERE reason IS NOT NULL GROUP BY source_file, reason",
    "p4_found": _P4 + "SELECT * FROM found",
    "p4_report": _P4 + "SELECT table_name, field_name, period, kind, count(*) AS n FROM found GROUP BY ALL",
    "p5_found": _P5 + "SELECT DISTINCT * FROM found",
    "p5_patterns": _P5_MASKS + """
SELECT j.feed, j.load_no, j.column_name, sum(n)::BIGINT AS filled, count(*) AS masks, count(*) FILTER (WHERE dominant) AS dominant_masks, max(struct_pack(n := n, mask := encode(mask))).n AS top_count,
  decode(max(struct_pack(n := n, mask := encode(mask))).mask) AS top_mask, coalesce(sum(n) FILTER (WHERE NOT dominant), 0)::BIGINT AS rare_values, round(any_value(d.divergence), 6) AS mask_divergence
FROM judged j LEFT JOIN moved d ON d.feed = j.feed AND d.load_no = j.load_no AND d.column_name = j.column_name GROUP BY j.feed, j.load_no, j.column_name""",
    "p5_rare_values": _P5_MASKS + "SELECT feed, load_no, column_name, mask, m.value, count(*) AS n FROM m JOIN judged USING (feed, load_no, column_name, mask) WHERE NOT dominant GROUP BY feed, load_no, column_name, mask, m.value",
    "p5_profile": _P5 + "SELECT feed, load_no, column_name, rows, null_count, round(null_pct, 6) AS null_pct, distinct_count, inferred_type, min_number, max_number, n_violations FROM profile",
}
