"""Scalar functions over text, as Column expressions unless only Python has the rule."""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What an organisation's name ends in, and the units of a threshold.
ORGANISATION = r"([一-龥]{2,10}(?:公司|集团|科技|物流|铝业|五金|包装|原材料))"
THRESHOLD = r"([0-9][0-9,\.]+)\s*(?:万元?|吨|件|小时|天|%|个月|季度)"
CJK = r"[一-鿿]"


def strip(c: Column) -> Column:
    """Without outer white space of any kind."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    return c.isNull() | (strip(c) == "")


def key_normal(c: Column) -> Column:
    """A key as it is compared across formats: SUP-001, sup_001 and SUP001 are one."""
    return F.upper(F.regexp_replace(c, r"[\s\-_]", ""))


def name_normal(c: Column) -> Column:
    """Compatibility form, no white space, lower case; texts that are ASCII stay in the JVM."""

    @F.pandas_udf("string")
    def nfkc(s: pd.Series) -> pd.Series:
        return s.map(lambda x: None if x is None else unicodedata.normalize("NFKC", x), na_action="ignore")

    return F.lower(F.regexp_replace(F.when(c.rlike(r"^\p{ASCII}*$"), c).otherwise(nfkc(c)), r"(?U)\s+", ""))


ABBREVIATED = r"^(.+?)[\s（(]+([A-Za-z][A-Za-z0-9-]*)[\s）)]\s*$"


def abbreviation(c: Column) -> tuple[Column, Column]:
    """(name, abbreviation) of ``name（ABC）``."""
    s = strip(c)
    hit = s.rlike(ABBREVIATED)
    return F.when(hit, strip(F.regexp_extract(s, ABBREVIATED, 1))).otherwise(s), F.when(hit, F.regexp_extract(s, ABBREVIATED, 2)).otherwise("")


def slug(c: Column) -> Column:
    plain = F.btrim(F.regexp_replace(F.lower(strip(c)), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.coalesce(F.nullif(plain, F.lit("")), F.lit("unknown"))


def class_name(c: Column) -> Column:
    """snake_case or kebab-case in CamelCase."""
    parts = F.filter(F.split(c, r"[_\-\s]+"), lambda p: p != "")
    return F.array_join(F.transform(parts, lambda p: F.concat(F.upper(F.substring(p, 1, 1)), F.lower(p.substr(F.lit(2), F.length(p))))), "")


def camel_spaced(c: Column) -> Column:
    """CamelCase in words with initial capitals."""
    return F.initcap(F.replace(F.regexp_replace(c, "(?<=[a-z0-9])(?=[A-Z])", " "), F.lit("_"), F.lit(" ")))


def camel_upper_snake(c: Column) -> Column:
    return F.upper(F.regexp_replace(c, "(?<=[a-z0-9])(?=[A-Z])", "_"))


def property_name(c: Column) -> Column:
    return F.lower(F.replace(c, F.lit(" "), F.lit("_")))


def has_cjk(c: Column) -> Column:
    return c.rlike(CJK)


def safe_token(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown")), r"(?U)[^\w]", "_")


def cypher_string(c: Column) -> Column:
    """A text as a quoted graph-query literal, null as null."""
    out = c
    for a, b in (("\\", "\\\\"), ("'", "\\'"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.coalesce(F.concat(F.lit("'"), out, F.lit("'")), F.lit("null"))


def cypher_key(c: Column) -> Column:
    return F.when(c.rlike("^[A-Za-z_][A-Za-z0-9_]*$"), c).otherwise(F.concat(F.lit("`"), F.replace(c, F.lit("`"), F.lit("``")), F.lit("`")))


def html_escape(c: Column) -> Column:
    out = F.coalesce(c, F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#x27;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


def organisations(c: Column, most: int | None = None) -> Column:
    found = F.array_distinct(F.regexp_extract_all(c, F.lit(ORGANISATION), F.lit(1)))
    return F.array_join(F.slice(found, 1, most) if most else found, ", ")


def thresholds(c: Column, most: int | None = None) -> Column:
    found = F.regexp_extract_all(c, F.lit(THRESHOLD), F.lit(1))
    return F.array_join(F.slice(found, 1, most) if most else found, ", ")


def looks_like_id(c: Column) -> Column:
    return c.rlike(r"^[A-Za-z]+[-_]?[0-9]+$") | c.rlike(r"^[A-Za-z]+[0-9_\-]+[0-9]+$")


def sequence_ratio(a: Column, b: Column) -> Column:
    """Twice the matching characters over all characters, by longest matching blocks."""

    @F.pandas_udf("double")
    def ratio(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([None if p is None or q is None else difflib.SequenceMatcher(None, p, q).ratio() for p, q in zip(x, y, strict=True)], dtype="float64")

    return ratio(a, b)


def split_cell(c: Column) -> Column:
    """The values of a cell that holds several."""
    return F.filter(F.transform(F.split(c, r"[,，、;；|]"), strip), lambda x: x != "")


def shared_characters(a: Column, b: Column) -> Column:
    """How many different characters two texts share."""
    return F.size(F.array_intersect(F.split(a, ""), F.split(b, "")))


def strip_control(c: Column) -> Column:
    return F.regexp_replace(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", "")


def replace_in_list(c: Column, old: str, new: str) -> Column:
    """A name replaced in a list, which then keeps the first of equal names."""
    return F.array_distinct(F.transform(c, lambda x: F.when(x == old, F.lit(new)).otherwise(x)))


def add_alias(aliases: Column, alias: Column, primary: Column) -> Column:
    """An alias appended unless it is there, empty or the primary name."""
    have = F.coalesce(aliases, F.array().cast("array<string>"))
    return F.when(alias.isNull() | (alias == "") | (alias == primary), have).otherwise(F.array_union(have, F.array(alias)))


def clamp(c: Column, least: float, most: float) -> Column:
    return F.greatest(F.lit(least), F.least(F.lit(most), c))


#: The namespace of identifiers made from URLs (RFC 4122).
URL_NAMESPACE = "6ba7b8119dad11d180b400c04fd430c8"


def dashed(hexadecimal: Column) -> Column:
    cut = lambda a, n: F.substring(hexadecimal, a, n)
    return F.concat_ws("-", cut(1, 8), cut(9, 4), cut(13, 4), cut(17, 4), cut(21, 12))


def uuid5(name: Column, namespace: str = URL_NAMESPACE) -> Column:
    """Version 5 identifier of a name, native."""
    h = F.sha1(F.concat(F.unhex(F.lit(namespace)), F.encode(name, "UTF-8")))
    variant = F.lower(F.conv(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8).cast("string"), 10, 16))
    return dashed(F.concat(F.substring(h, 1, 12), F.lit("5"), F.substring(h, 14, 3), variant, F.substring(h, 18, 15)))


def row_id(ontology: Column, entity_class: Column, identity: Column) -> Column:
    return uuid5(F.concat_ws(":", ontology, entity_class, identity))


def relation_id(ontology: Column, source: Column, kind: Column, target: Column, origin: Column) -> Column:
    return uuid5(F.concat_ws(":", ontology, source, kind, target, origin))


def concept_id(ontology: Column, entity_class: Column) -> Column:
    return dashed(F.md5(F.concat_ws(":", ontology, entity_class, F.lit("concept"))))


def instance_id(ontology: Column, concept: Column, name: Column) -> Column:
    return dashed(F.md5(F.concat_ws(":", ontology, concept, name)))


def canonical_id(prefix: str, name_en: Column, name: Column) -> Column:
    """prefix:slug, or by ten digits of a hash where there is no slug."""
    s = F.btrim(F.regexp_replace(F.lower(F.coalesce(name_en, F.lit(""))), "[^a-z0-9]+", "_"), F.lit("_"))
    return F.concat(F.lit(prefix + ":"), F.coalesce(F.nullif(s, F.lit("")), F.substring(F.md5(F.coalesce(name, F.lit(""))), 1, 10)))


def canonical_json(columns: list[str]) -> Column:
    """A row as JSON with sorted keys, null values included."""
    return F.to_json(F.struct(*[F.col(c) for c in sorted(columns)]), {"ignoreNullFields": "false"})


def row_identity(pk: str | None, columns: list[str]) -> Column:
    """``pk:value`` where the key has a value, else the row's canonical JSON."""
    hashed = F.concat(F.lit("row_hash:"), canonical_json([c for c in columns if c != "content"]))
    if not pk or pk == "__row_hash__":
        return hashed
    v = F.col(pk).cast("string")
    return F.when(v.isNotNull() & (v != ""), F.concat(F.lit(f"{pk}:"), v)).otherwise(hashed)


def period_key(ts: Column, kind: str) -> Column:
    """MONTH 2024-05, QUARTER 2024-Q2, YEAR 2024."""
    if kind == "MONTH":
        return F.date_format(ts, "yyyy-MM")
    if kind == "QUARTER":
        return F.concat(F.year(ts).cast("string"), F.lit("-Q"), F.quarter(ts).cast("string"))
    if kind == "YEAR":
        return F.year(ts).cast("string")
    raise ValueError(f"unknown period {kind}")


PERIODS = {"MONTH": r"^[0-9]{4}-(0[1-9]|1[0-2])$", "QUARTER": r"^[0-9]{4}-Q[1-4]$", "YEAR": r"^[0-9]{4}$"}


def valid_period(key: Column, kind: str) -> Column:
    return key.rlike(PERIODS[kind])


CRON = r"^(\*|[0-9,\-\*/]+)\s+(\*|[0-9,\-\*/]+)\s+(\*|[0-9,\-\*/]+)\s+(\*|[0-9,\-\*/]+)\s+(\*|[0-9,\-\*/]+)$"


def cron(c: Column) -> dict[str, Column]:
    """Validity, the five fields and a description of a schedule expression."""
    s = strip(c)
    ok = s.rlike(CRON)
    parts = F.split(s, r"\s+")
    field = lambda i: F.when(ok, F.get(parts, F.lit(i)))
    minute, hour = field(0), field(1)
    daily = (minute == "0") & (field(2) == "*") & (field(3) == "*") & (field(4) == "*")
    text = (
        F.when(~ok, "无效的 cron 表达式")
        .when(s == "* * * * *", "每分钟")
        .when(minute.startswith("*/"), F.concat(F.lit("每 "), minute.substr(F.lit(3), F.length(minute)), F.lit(" 分钟")))
        .when(daily & (hour == "*"), "每小时整点")
        .when(daily & (hour == "8"), "每天 08:00")
        .when(daily, F.concat(F.lit("每天 "), hour, F.lit(":00")))
        .otherwise(F.concat(F.lit("按计划执行 ("), s, F.lit(")")))
    )
    return {"valid": ok, "minute": minute, "hour": hour, "day_of_month": field(2), "month_of_year": field(3), "day_of_week": field(4), "description": text}


def stored_value(value: Column, unit: Column) -> Column:
    """Percent values are stored from 0 to 1."""
    return F.when(unit == "PERCENT", value / 100).otherwise(value)


def tolerant_json(c: Column) -> Column:
    """The JSON object inside a reply: fences and control characters off, from the first to the last brace.

    What still does not parse is repaired once in Python (trailing commas, single quotes), else null.
    """
    fenced = F.regexp_extract(c, r"(?s)```(?:json)?\s*(.+?)```", 1)
    body = strip_control(F.coalesce(F.nullif(fenced, F.lit("")), c))
    braces = F.regexp_extract(body, r"(?s)([\[{].*[\]}])", 1)

    @F.pandas_udf("string")
    def mend(s: pd.Series) -> pd.Series:
        import json
        import re

        def one(x: str | None) -> str | None:
            if not x:
                return None
            for t in (x, re.sub(r",\s*([}\]])", r"\1", x), re.sub(r",\s*([}\]])", r"\1", x.replace("'", '"'))):
                try:
                    return json.dumps(json.loads(t), ensure_ascii=False, sort_keys=True)
                except ValueError:
                    pass
            return None

        return s.map(one)

    return mend(braces)
