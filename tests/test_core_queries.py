"""Every core query beside its SQL on the smallest tables; those without SQL must run."""

import pytest
from oracle import compare, duck

from tributary.queries import flows, joins, problems, scalar, tables

FOLDER = "/root/testdata/sf0.001"
QUERIES = problems.QUERIES | {k: f for m in (scalar, tables, joins, flows) for k, f in m.q.queries.items()}
SQL = problems.SQL | {k: s for m in (scalar, tables, joins, flows) for k, s in m.q.sql.items()}


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    from tributary.plans.ship import ship

    ship(spark)
    if name in SQL:
        ok, said = compare(spark, con, QUERIES[name], SQL[name], FOLDER)
        assert ok, said
    else:
        QUERIES[name](spark, FOLDER).collect()


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)
