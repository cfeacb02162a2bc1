"""Every registered query against its SQL statement."""

import pytest

import __spark_entry__ as entry
from studytrail.plans import oracle
from studytrail.plans.queries import all_queries
from compare import connect, duck_rows, spark_rows

QUERIES, SQL = all_queries(), oracle.all_statements()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_statement_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, duck):
    df = QUERIES[name](spark, sf_dir)
    got = spark_rows(df)
    assert got
    if name in SQL:
        want_cols = sorted(c[0] for c in duck.execute(SQL[name]).description)
        assert sorted(df.columns) == want_cols
        want = duck_rows(duck, SQL[name])
        assert len(got) == len(want)
        assert got == want


def test_entry(spark):
    assert entry.entry(spark).count() > 0
