"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

import __spark_entry__ as entry
from aggrex.registry import ORACLE
from aggrex.registry import QUERIES as NAMES
from compare import rows
from conftest import SMALL

QUERIES = {k: v for k, v in entry.queries().items() if k in NAMES}


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = duck.sql(ORACLE[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_an_oracle():
    assert sorted(QUERIES) == sorted(ORACLE)


def test_entry(spark):
    df = entry.entry(spark)
    assert set(df.columns) == {"period", "class", "n"}
    assert df.count() > 0
