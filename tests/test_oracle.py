"""Every registered query against its SQL answer on the small tables."""

import pytest

import __spark_entry__ as entry_points
from compare import difference, oracle_connection
from conftest import SF_SMALL

from tripgauge.plans import oracle, registry

QUERIES, ORACLE = registry.build(), oracle.build()


@pytest.fixture(scope="module")
def con():
    return oracle_connection(SF_SMALL)


def test_every_answer_has_its_query():
    assert set(ORACLE) <= set(QUERIES)
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF_SMALL), con, ORACLE[name]) is None


def test_entry_offers_every_query():
    assert set(QUERIES) <= set(entry_points.queries())
    assert ORACLE.items() <= entry_points.oracle_sql().items()


def test_entry(spark):
    assert entry_points.entry(spark).count() == 5


def test_fingerprint_counts_rows(spark):
    rows = {r["name"]: r for r in QUERIES["table_fingerprint"](spark, SF_SMALL).collect()}
    assert rows["lineitem.parquet"].row_count == 6000
    assert rows["events.parquet"].header_column_count == 6
