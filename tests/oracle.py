"""Runs queries beside their SQL in DuckDB and compares columns, row counts and values.

As a script: python tests/oracle.py [--dir FOLDER] [NAME...]
"""

from __future__ import annotations

import decimal
import math
import sys
import time
from collections import Counter
from pathlib import Path

import duckdb

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import SparkSession  # noqa: E402


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for p in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p if p.is_file() else p / '*.parquet'}'")
    return con


def plain(v):
    if v is None:
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, (decimal.Decimal, int)):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, dict):
        return tuple(sorted((k, plain(x)) for k, x in v.items()))
    if hasattr(v, "asDict"):
        return tuple(sorted((k, plain(x)) for k, x in v.asDict().items()))
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if isinstance(v, (bytes, bytearray)):
        return bytes(v)
    return str(v)


def compare(spark, con, f, sql: str, folder: str) -> tuple[bool, str]:
    t = time.time()
    df = f(spark, folder)
    names = sorted(df.columns)
    ours = Counter(tuple(plain(r[c]) for c in names) for r in df.collect())
    took = time.time() - t
    cur = con.execute(sql)
    theirs_names = [d[0] for d in cur.description]
    if sorted(theirs_names) != names:
        return False, f"columns {names} and {sorted(theirs_names)}"
    at = [theirs_names.index(c) for c in names]
    theirs = Counter(tuple(plain(r[i]) for i in at) for r in cur.fetchall())
    if ours == theirs:
        return True, f"{sum(ours.values())} rows, {took:.1f} s"
    a, b = ours - theirs, theirs - ours
    return False, f"{sum(ours.values())} and {sum(theirs.values())} rows; only Spark {sum(a.values())} {list(a)[:2]}; only SQL {sum(b.values())} {list(b)[:2]}"


def main(args: list[str]) -> int:
    import __spark_entry__ as e

    folder = args[args.index("--dir") + 1] if "--dir" in args else "/root/testdata/sf0.01"
    prefix = args[args.index("--like") + 1] if "--like" in args else ""
    names = [a for i, a in enumerate(args) if not a.startswith("--") and (i == 0 or args[i - 1] not in ("--dir", "--like"))]
    qs, sqls = e.queries(), e.oracle_sql()
    names = names or [n for n in qs if prefix and any(n.startswith(p) for p in prefix.split(","))]
    spark, con, bad = session(), duck(folder), 0
    for name in names or qs:
        try:
            if name in sqls:
                ok, said = compare(spark, con, qs[name], sqls[name], folder)
            else:
                t = time.time()
                ok, said = True, f"no SQL; {qs[name](spark, folder).count()} rows, {time.time() - t:.1f} s"
        except Exception as x:  # noqa: BLE001
            ok, said = False, repr(x)[:600]
        bad += not ok
        if not ok or names or "no SQL" in said:
            print("ok  " if ok else "BAD ", name, said, flush=True)
    print(f"{len(names or qs)} queries, {bad} bad, {len(sqls)} with SQL")
    return int(bad > 0)


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
