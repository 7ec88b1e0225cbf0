import datetime
import random
import re

import pytest

from tributary.operators.strict_load import ORDER_FIELDS, rejects, typed_orders

GOOD = ["PO-202501-0001", "2025-01-02", "甲", "A", "RM-AL-001", "b", "c", "d", "个", "1", "2.50", "1,234.5", "2025/1/3", "", "x", "", "z"]


def record(sep=",", **changes):
    f = list(GOOD)
    for k, v in changes.items():
        f[int(k[1:])] = v
    return sep.join(f'"{x}"' if sep in x or "\n" in x else x for x in f)


def parse(line, sep):
    """Brute force over characters."""
    fields, i, n = [], 0, len(line)
    while True:
        if i < n and line[i] == '"':
            out, i = [], i + 1
            while True:
                if i >= n:
                    return None
                if line[i] == '"':
                    if i + 1 < n and line[i + 1] == '"':
                        out.append('"')
                        i += 2
                        continue
                    i += 1
                    break
                out.append(line[i])
                i += 1
            if i < n and not line.startswith(sep, i):
                return None
            fields.append("".join(out))
        else:
            j = line.find(sep, i) if sep else -1
            j = n if j < 0 else j
            if '"' in line[i:j]:
                return None
            fields.append(line[i:j])
            i = j
        if i >= n:
            return fields
        i += len(sep)


def is_date(v):
    m = re.fullmatch(r"(\d{4})-(\d\d)-(\d\d)|(\d{4})/(\d{1,2})/(\d{1,2})|(\d{4})(\d\d)(\d\d)", v, re.ASCII)
    try:
        return bool(m) and bool(datetime.date(*[int(x) for x in m.groups() if x]))
    except ValueError:
        return False


def reason(line, sep):
    if line is None:
        return None
    line = line.removesuffix("\r")
    if not line or line.startswith("#"):
        return None
    f = parse(line, sep)
    if f is None:
        return "quoting"
    if len(f) != 17:
        return "column_count"
    f = [x.strip(" ") for x in f]
    ok = re.fullmatch(r"PO-20\d\d(0[1-9]|1[0-2])-\d{4,}", f[0], re.ASCII) and is_date(f[1])
    ok = ok and all(not f[i] or is_date(f[i]) for i in (12, 13))
    ok = ok and all(not f[i] or re.fullmatch(r"-?(\d{1,3}(,\d{3})+|\d+)(\.\d+)?", f[i], re.ASCII) for i in (9, 10, 11))
    return None if ok else "value"


LINES = [
    record(), record(";"), record("|"), record("\t"), record() + "\r", record() + "\r\r", record(c0="PO-202513-0001"), record(c0=" PO-202501-0001 "), record(c0="po-202501-0001"),
    record(c0="PO-202501-001"), record(c1=""), record(c1="2025-02-30"), record(c1="20250230"), record(c1="20250228"), record(c1="0000-01-01"), record(c1="２０２５-01-01"), record(c12="2025/13/1"),
    record(c9="-5"), record(c9="1,23"), record(c9="１"), record(c9="5."), record(c9="1e5"), record(c9="  "), record(c2="多行\n规格"), record(c2='a""b'), '"a"b,' + record(), record() + '"', record() + ",",
    record()[:40], "#x", "", None, "\r", " ", '"', '""', '"' * 17, "," * 16, "x" * 100_000, '"' + "x" * 50_000 + '""' * 50_000 + '"', '""' * 40_000,
]


def test_every_line_equals_brute_force(spark):
    seps = [",", ";", "|", "\t", "~", "||"]
    rows = [(i * 10 + j, "f", 1, s, line) for i, line in enumerate(LINES) for j, s in enumerate(seps)]
    df = spark.createDataFrame(rows, "raw_id long, source_file string, line_no int, sep string, c0 string")
    got = {r.raw_id: r.reason for r in rejects(df).collect()}
    want = {k: w for k, _, _, s, line in rows if (w := reason(line, s))}
    assert got == want and set(want.values()) == {"quoting", "column_count", "value"}


@pytest.mark.parametrize("seed", range(3))
def test_random_text(spark, seed):
    r = random.Random(seed)
    rows = [(i, "f", 1, r.choice([",", "|"]), "".join(r.choices('a",|"\n\r# ', k=r.randint(0, 30)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "raw_id long, source_file string, line_no int, sep string, c0 string")
    assert {x.raw_id: x.reason for x in rejects(df).collect()} == {k: w for k, _, _, s, line in rows if (w := reason(line, s))}


def test_edges(spark):
    schema = "raw_id long, source_file string, line_no int, sep string, c0 string, offset string, line string, reason string"
    rows = [(1, "f", 0, ",", "header", "", "", ""), (2, None, None, ",", record(), "", "", ""), (2, None, 5, ",", "bad", "", "", ""), (3, "f", 2, None, record(), "", "", ""), (4, "f", 3, "", "a", "", "", ""), (5, "f", 1, ",", record(), "", "", ""), (5, "f", 1, ",", record(), "", "", ""), (None, "f", 1, ",", "x", "", "", "")]
    df = spark.createDataFrame(rows, schema)
    assert sorted((r.raw_id or 0, r.reason) for r in rejects(df).collect()) == [(0, "column_count"), (2, "column_count"), (3, "quoting"), (4, "column_count")]
    good = typed_orders(df).collect()
    assert [r.raw_id for r in sorted(good, key=lambda x: x.raw_id)] == [2, 5, 5]
    one = good[0].asDict()
    assert one["下单日期"] == datetime.date(2025, 1, 2) and float(one["总金额"]) == 1234.5 and one["实际到货期"] is None and set(one) == {"raw_id", *ORDER_FIELDS}
    assert rejects(df.limit(0)).count() == typed_orders(df.limit(0)).count() == 0
