"""Every registered query against its SQL, over the whole tables."""

import pytest

import __spark_entry__ as entry
from checks.compare import difference, in_duckdb, in_spark

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, name):
    assert difference(in_spark(spark, QUERIES[name], SMALL), in_duckdb(ORACLES[name], SMALL)) is None


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert entry.entry(spark).count() == 9
