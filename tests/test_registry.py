"""Every registered query against its SQL, on whole tables."""

import pytest
from compare import connect, duckdb_rows, spark_rows

import __spark_entry__ as entry_points
from tiercast.plans import oracle, registry

QUERIES = registry.queries()
ORACLE = oracle.oracle_sql()


@pytest.fixture(scope="module")
def duck(check_dir):
    return connect(check_dir)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, check_dir, name):
    result = QUERIES[name](spark, check_dir)
    names, expected = duckdb_rows(duck, ORACLE[name])
    assert sorted(result.columns) == names
    rows = spark_rows(result)
    assert rows
    assert rows == expected


def test_entry_points_hold_all_of_them():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLE) <= set(entry_points.oracle_sql())


def test_entry_point(spark):
    assert entry_points.entry(spark).count() == 150
