"""Every registered query against its DuckDB oracle on the smallest tables."""

import pytest

from __spark_entry__ import oracle_sql, queries
from tests.compare import compare, connect

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
QUERIES, ORACLES = queries(), oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_oracle(spark, duck, name):
    ok, message = compare(spark, duck, SF, QUERIES[name], ORACLES.get(name))
    if message.endswith(" 0 rows"):  # an empty result shows nothing: the next size must give rows
        ok, message = compare(spark, connect(LARGER), LARGER, QUERIES[name], ORACLES.get(name))
    assert ok, message


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
