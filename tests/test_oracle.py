import pytest

import __spark_entry__ as contract
from compare import connect, differences
from oracle.sql import ORACLE
from quiltmap.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert QUERIES.items() <= contract.queries().items() and ORACLE.items() <= contract.oracle_sql().items()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, sf_dir, con, name):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLE[name]) == []


def test_entry_is_the_pyramid(spark):
    df = contract.entry(spark)
    assert set(df.columns) == {"zoom", "gx", "gy", "r", "g", "b", "priority"}
    assert {r.zoom for r in df.select("zoom").distinct().collect()} == set(range(1, 13))
