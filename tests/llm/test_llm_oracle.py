"""Queries that SQL can express against their SQL."""

import pytest

from compare import connect, differences
from quiltmap.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir), connect(sf_dir), ORACLE[name]) == []


def test_every_operator_has_a_query():
    assert {int(name[2:].split("_")[0]) for name in QUERIES} == set(range(1, 14))
