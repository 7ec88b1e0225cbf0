import pytest
from oracle import compare, duck

from tributary.llm.queries import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, name):
    if name in SQL:
        ok, said = compare(spark, duck(FOLDER), QUERIES[name], SQL[name], FOLDER)
        assert ok, said
    else:
        QUERIES[name](spark, FOLDER).collect()


def test_containers_hold_every_token_once(spark):
    from tributary.plans.tables import table

    got = QUERIES["p7_containers"](spark, FOLDER).collect()
    per, held = {}, {}
    for r in got:
        per[r.container] = per.get(r.container, 0) + r.tokens
        held[r.doc_id] = held.get(r.doc_id, 0) + r.tokens
    want = {r.doc_id: len(r.text.encode()) + 1 for r in table(spark, FOLDER, "documents").collect() if r.text is not None}
    assert held == want and max(per.values()) <= 4096
    assert all(r.pieces == 1 for r in got if want[r.doc_id] <= 4096)
