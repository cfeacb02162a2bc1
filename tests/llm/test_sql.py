"""Queries of the llm package against their SQL statements, over whole tables."""

import pytest

pytest.importorskip("studytrail.llm")

from compare import connect, duck_rows, spark_rows  # noqa: E402
from studytrail.llm import queries  # noqa: E402

SQL = queries.all_statements()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query(name, spark, sf_dir):
    duck = connect(sf_dir)
    df = queries.all_queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(c[0] for c in duck.execute(SQL[name]).description)
    assert spark_rows(df) == duck_rows(duck, SQL[name])
