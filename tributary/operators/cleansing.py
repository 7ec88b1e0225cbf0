"""Generic transforms and cleansing of tables: DataFrame to DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tributary.functions.text import is_blank, strip


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns that exist, in the order asked for."""
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def filter_rows(df: DataFrame, condition: str | Column) -> DataFrame:
    return df.filter(condition)


def sort(df: DataFrame, by: list[str], ascending: bool | list[bool] = True) -> DataFrame:
    return df.orderBy(*by, ascending=ascending)


def aggregate(df: DataFrame, by: list[str], measures: dict[str, tuple[str, str]]) -> DataFrame:
    """``measures``: output name to (function, column)."""
    return df.groupBy(*by).agg(*[getattr(F, f)(c).alias(a) for a, (f, c) in measures.items()])


def pivot(df: DataFrame, by: list[str], column: str, values: list, measure: str, function: str = "sum") -> DataFrame:
    """One column for each of the declared values, so that no extra pass finds them."""
    return df.groupBy(*by).pivot(column, values).agg(getattr(F, function)(measure))


def fill_nulls(df: DataFrame, value: str = "", columns: list[str] | None = None) -> DataFrame:
    """Null and blank cells of text columns become ``value``."""
    return df.withColumns({c: F.when(is_blank(F.col(f"`{c}`")), F.lit(value)).otherwise(F.col(f"`{c}`")) for c in columns or _texts(df)})


def drop_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Rows with a null or blank cell removed."""
    keep = F.lit(True)
    for f in df.schema.fields:
        if columns is None or f.name in columns:
            c = F.col(f"`{f.name}`")
            keep = keep & ~(is_blank(c) if isinstance(f.dataType, T.StringType) else c.isNull())
    return df.filter(keep)


def mark_nulls(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Blank cells become empty, and a marker column for each column says where they were."""
    names = columns or _texts(df)
    marks = {f"__null_{c}__": F.when(is_blank(F.col(f"`{c}`")), F.lit("1")) for c in names}
    return fill_nulls(df.withColumns(marks), "", names)


def trim_strings(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    return df.withColumns({c: strip(F.col(f"`{c}`")) for c in columns or _texts(df)})


def drop_duplicates(df: DataFrame, keys: list[str] | None = None) -> DataFrame:
    return df.dropDuplicates(keys) if keys else df.dropDuplicates()


YEAR_FIRST, YEAR_LAST, COMPACT = r"^([0-9]{4})[-/]([0-9]{1,2})[-/]([0-9]{1,2})$", r"^([0-9]{1,2})[-/]([0-9]{1,2})[-/]([0-9]{4})$", r"^([0-9]{4})([0-9]{2})([0-9]{2})$"


def iso_date(c: Column, day_first: bool = False, compat: bool = False) -> Column:
    """Dates written with the year first, last or without separators as YYYY-MM-DD, other text unchanged.

    By default numbers are padded and what is no real date is unchanged; ``compat`` takes year-last
    dates as month first without a check and leaves compact ones unpadded.
    """
    s = strip(c)
    part = lambda p, i, n=2: F.lpad(F.regexp_extract(s, p, i), n, "0")
    number = lambda p, i: F.regexp_replace(F.regexp_extract(s, p, i), "^0+(?=.)", "")
    join = lambda *x: F.concat_ws("-", *x)
    a, b = (2, 1) if day_first and not compat else (1, 2)
    first = join(F.regexp_extract(s, YEAR_FIRST, 1), part(YEAR_FIRST, 2), part(YEAR_FIRST, 3))
    last = join(F.regexp_extract(s, YEAR_LAST, 3), part(YEAR_LAST, a), part(YEAR_LAST, b))
    compact = join(number(COMPACT, 1), number(COMPACT, 2), number(COMPACT, 3)) if compat else join(F.regexp_extract(s, COMPACT, 1), F.regexp_extract(s, COMPACT, 2), F.regexp_extract(s, COMPACT, 3))
    made = F.when(s.rlike(YEAR_FIRST), first).when(s.rlike(YEAR_LAST), last).when(s.rlike(COMPACT), compact)
    if not compat:
        made = F.when(made.try_cast("date").isNotNull(), made)
    return F.coalesce(made, s)


def jagged_filter(df: DataFrame, raw: str, expected: list[str]) -> DataFrame:
    """JSON rows whose keys are exactly the expected ones."""
    keys = F.json_object_keys(F.col(raw))
    want = F.array(*[F.lit(k) for k in expected])
    return df.filter((F.size(F.array_except(keys, want)) == 0) & (F.size(F.array_except(want, keys)) == 0))


def cleanse(df: DataFrame, null_strategy: str = "fill_empty", trim: bool = True, deduplicate: bool = True, dates: list[str] | None = None, observation: Observation | None = None) -> DataFrame:
    """The cleansing step: null handling, trimming, dates, duplicates; metrics through ``observation``."""
    if observation is not None:
        blank = sum((is_blank(F.col(f"`{c}`")).cast("int") for c in _texts(df)), F.lit(0))
        df = df.observe(observation, F.count(F.lit(1)).alias("rows_before"), F.sum(blank).alias("null_cells_handled"))
    handle: dict[str, Callable[[DataFrame], DataFrame]] = {"fill_empty": fill_nulls, "drop": drop_nulls, "mark": mark_nulls}
    out = df
    if trim:
        out = out.withColumns({c: F.when(is_blank(F.col(f"`{c}`")), F.col(f"`{c}`")).otherwise(strip(F.col(f"`{c}`"))) for c in _texts(df)})
    out = handle[null_strategy](out)
    for c in dates or []:
        out = out.withColumn(c, iso_date(F.col(f"`{c}`")))
    return out.dropDuplicates() if deduplicate else out


def detect_wide(df: DataFrame, threshold: int = 80) -> bool:
    return len(df.columns) >= threshold


def suggest_split(columns: list[str]) -> dict[str, list[str]]:
    """Two tables with half of the columns each, both with the first one as their key."""
    half = len(columns) // 2
    return {"table_1": columns[: half or 1], "table_2": columns[:1] + columns[half or 1 :]}


def apply_split(df: DataFrame, tables: dict[str, list[str]]) -> dict[str, DataFrame]:
    """Each table with the columns it names that exist, without duplicates; none exist: no rows."""
    return {name: select_columns(df, cols).distinct() if any(c in df.columns for c in cols) else df.limit(0).select() for name, cols in tables.items()}


def flatten(df: DataFrame, sep: str = ".", max_depth: int = 10) -> DataFrame:
    """Nested structs as columns named by their path; what is deeper becomes JSON text."""
    out: list[Column] = []

    def walk(path: list[str], kind: T.DataType) -> None:
        ref = F.col(".".join(f"`{p}`" for p in path))
        if isinstance(kind, T.StructType):
            if len(path) > max_depth:
                out.append(F.to_json(ref).alias(sep.join(path)))
            else:
                for f in kind.fields:
                    walk([*path, f.name], f.dataType)
        else:
            out.append(ref.alias(sep.join(path)))

    for f in df.schema.fields:
        walk([f.name], f.dataType)
    return df.select(*out)


def explode_array(df: DataFrame, column: str | None = None, sep: str = ".") -> DataFrame:
    """The first array column, or the one named, with one row an item; other arrays become JSON text.

    Struct items become columns ``array.field``; an empty array keeps its row with ``[]``.
    """
    arrays = [f for f in df.schema.fields if isinstance(f.dataType, T.ArrayType)]
    target = next((f for f in arrays if column in (None, f.name)), None)
    rest = [F.to_json(f"`{f.name}`").alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f"`{f.name}`") for f in df.schema.fields if f is not target]
    if target is None:
        return df.select(*rest)
    item = F.explode_outer(f"`{target.name}`").alias("__item")
    empty = F.when(F.size(f"`{target.name}`") == 0, F.lit("[]"))
    wide = df.select(*rest, empty.alias("__empty"), item)
    names = [c for c in wide.columns if not c.startswith("__")]
    keep = [F.col(f"`{c}`") for c in names]
    if isinstance(target.dataType.elementType, T.StructType):
        fields = [F.col(f"__item.`{f.name}`").alias(f"{target.name}{sep}{f.name}") for f in target.dataType.elementType.fields]
        return wide.select(*keep, *fields, F.col("__empty").alias(target.name))
    return wide.select(*keep, F.coalesce(F.col("__item").cast("string"), "__empty").alias(target.name))


def xml_records(df: DataFrame, column: str, record: str, schema: str, keep: list[str]) -> DataFrame:
    """One row a record element: attributes and children as columns; what does not parse stays one row of nulls."""
    wrapped = F.from_xml(F.col(column), F.lit(f"{record} array<struct<{schema}>>"), {"attributePrefix": "", "mode": "PERMISSIVE"})
    return df.select(*keep, F.explode_outer(wrapped[record]).alias("x")).select(*keep, "x.*")


def _texts(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
