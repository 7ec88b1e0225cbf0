import datetime
import random

import pytest

from tributary.operators.orphan_refs import ontology_orphans

T0 = datetime.datetime(2025, 1, 1)
ENTITY = "id string, ontology_id string, name_cn string, version string, created_at timestamp_ntz, updated_at timestamp_ntz, deleted_at timestamp_ntz, key string"
RULE = "id string, created_at timestamp_ntz, deleted_at timestamp_ntz"
RELATION = "id string, ontology_id string, source_entity string, target_entity string, created_at timestamp_ntz, cell string"
ACTION = "id string, ontology_id string, linked_entities array<string>, linked_logic_ids array<string>, created_at timestamp_ntz"


def day(n):
    return None if n is None else T0 + datetime.timedelta(days=n)


def brute(entities, rules, relations, actions):
    latest = {}
    for e in entities:
        k = e[0].strip().lower()
        if k not in latest or (e[5] or datetime.datetime.min, e[3]) > (latest[k][5] or datetime.datetime.min, latest[k][3]):
            latest[k] = e
    ids, names, logic = {}, {}, {}
    for k, e in latest.items():
        ids.setdefault(k, []).append((e[4], e[6]))
        if e[2] and e[2].strip():
            names.setdefault((e[1].strip().lower(), e[2].strip()), []).append((e[4], e[6]))
    for r in rules:
        logic.setdefault(r[0].strip().lower(), []).append((r[1], r[2]))

    def kind(found, at):
        if not found:
            return "missing"
        live = [c for c, d in found if d is None]
        if not live:
            return "deleted"
        if at is not None and all(c is not None and c > at for c in live):
            return "late"

    out = set()

    def judge(table, field, row, ref, found, at):
        k = kind(found, at)
        if k:
            out.add((table, field, row, ref, k, at and at.strftime("%Y-%m")))

    for i, _, s, t, at, _ in relations:
        for f, ref in (("source_entity", s), ("target_entity", t)):
            if ref and ref.strip():
                judge("relations", f, i, ref, ids.get(ref.strip().lower()), at)
    for i, o, es, ls, at in actions:
        for ref in es or []:
            if ref and ref.strip():
                judge("actions", "linked_entities", i, ref, names.get(((o or "").strip().lower(), ref.strip())), at)
        for ref in ls or []:
            if ref and ref.strip():
                judge("actions", "linked_logic_ids", i, ref, logic.get(ref.strip().lower()), at)
    return out


@pytest.mark.parametrize("seed,sizes", [(0, {}), (1, {"parents_a_range": 3, "references_a_cell": 5}), (2, {"parents_a_range": 10, "references_a_cell": 2})])
def test_equals_brute_force(spark, seed, sizes):
    r = random.Random(seed)
    ident = lambda: r.choice(["E-", "e-"]) + str(r.randint(0, 30)) + r.choice(["", " ", "　"])
    maybe = lambda x: r.choice([None, x, x, x])
    entities = [(ident(), r.choice(["o1", "O2 "]), maybe(r.choice(["名", "名 ", "Name", "name", ""])), f"v{i}", maybe(day(r.randint(0, 60))), day(i), r.choice([None, None, day(70)]), "x") for i in range(60)]
    rules = [(ident(), maybe(day(r.randint(0, 60))), r.choice([None, day(9)])) for _ in range(20)]
    relations = [(f"r{i % 80}", "o1", maybe(ident() if i % 3 else "e-1"), maybe(" "), maybe(day(i % 60)), "c") for i in range(200)]
    actions = [(f"a{i}", maybe(r.choice(["O1", "o2"])), maybe([maybe(r.choice(["名", "NAME", " Name ", ""])) for _ in range(3)]), maybe([maybe(ident())]), maybe(day(i))) for i in range(60)]
    frames = [spark.createDataFrame(x, s) for x, s in ((entities, ENTITY), (rules, RULE), (relations, RELATION), (actions, ACTION))]
    got = [tuple(x) for x in ontology_orphans(*frames, **sizes).collect()]
    want = brute(entities, rules, relations, actions)
    assert len(got) == len(set(got)) and set(got) == want and {w[4] for w in want} == {"missing", "deleted", "late"}


def test_empty_and_long(spark):
    none = [spark.createDataFrame([], s) for s in (ENTITY, RULE, RELATION, ACTION)]
    assert ontology_orphans(*none).count() == 0
    rel = spark.createDataFrame([("r", "o", "x" * 100_000, None, None, "c")], RELATION)
    rows = ontology_orphans(none[0], none[1], rel, none[3]).collect()
    assert [(x.kind, x.period, len(x.ref_key)) for x in rows] == [("missing", None, 100_000)]


def test_different_keys_with_one_hash():
    import numpy as np
    import pyarrow as pa

    from tributary.operators.orphan_refs import _Cell

    cell = _Cell()
    cell.add(np.array([1, 5, 5, 5, 9]), pa.array(list("abcde")), np.array([1, 2, 3, 4, 5]))
    found, live = cell.probe(np.array([5, 5, 5, 5, 1, 7]), pa.array(list("dbcxaz")))
    assert found.tolist() == [True, True, True, False, True, False] and live[found].tolist() == [4, 2, 3, 1]


def test_a_hot_key_is_spread(spark):
    """One key has a tenth of all references, another range none: no cell gets more than it should, and none is lost."""
    from pyspark.sql import functions as F

    from tributary.operators.orphan_refs import orphans, placed

    keys = F.when(F.col("id") % 10 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 3000))
    refs = spark.range(20_000).select(F.concat(F.lit("entity\u0001\u0001"), keys).alias("key"), F.lit("t").alias("table_name"), F.lit("f").alias("field_name"), F.col("id").cast("string").alias("row_key"), keys.alias("ref_key"), F.lit(T0).cast("timestamp_ntz").alias("created_at"))
    parents = spark.range(2_000).select(F.concat(F.lit("entity\u0001\u0001k"), "id").alias("key"), F.lit(T0).cast("timestamp_ntz").alias("first_live"))
    cells = placed(parents, refs, 2_000, parents_a_range=250, references_a_cell=500)
    assert cells.filter("is_ref = 1").groupBy("cell", "salt").count().agg({"count": "max"}).first()[0] <= 600
    assert cells.filter("is_ref = 1").count() == 20_000
    few, plain = orphans(parents, refs, 2_000, parents_a_range=250, references_a_cell=500), orphans(parents, refs, 2_000)
    assert sorted(few.collect()) == sorted(plain.collect()) and few.count() > 2_000
