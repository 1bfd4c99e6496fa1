"""Every catalogued query with an SQL twin equals DuckDB on the same tables."""

import pytest

from lodestar.plans.catalogue import CATALOGUE
from tests.conftest import SF_ORACLE
from tests.oracle_harness import compare

WITH_SQL = sorted(k for k, (_, sql) in CATALOGUE.items() if sql is not None)
ROWS_ONLY = sorted(k for k, (_, sql) in CATALOGUE.items() if sql is None)


@pytest.mark.parametrize("key", WITH_SQL)
def test_matches_duckdb(spark, duck, key):
    fn, sql = CATALOGUE[key]
    out = compare(spark, duck, key, fn, sql, SF_ORACLE)
    assert "error" not in out, out
    assert out["spark_rows"] == out["duck_rows"]


@pytest.mark.parametrize("key", ROWS_ONLY)
def test_rows_only_runs(spark, key):
    fn, _ = CATALOGUE[key]
    df = fn(spark, SF_ORACLE)
    assert df.count() > 0


def test_entry_contract(spark):
    import __spark_entry__ as entry

    df = entry.entry(spark)
    assert df.count() == 24
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert len(entry.queries()) >= 90
