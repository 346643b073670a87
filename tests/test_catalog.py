"""Every registered query with SQL gives the SQL's result."""

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SMALL
from tools.check import TABLES, compare

SQL = entry.oracle_sql()
QUERIES = entry.queries()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    error, _ = compare(QUERIES[name](spark, SMALL), duck, SQL[name])
    assert error is None, error


# slow model fits are exercised in test_models
@pytest.mark.parametrize("name", ["pacf", "qq_normal", "bootstrap", "vif_n", "full_summary", "order_grid", "trend_season_holidays"])
def test_query_runs(spark, name):
    assert QUERIES[name](spark, SMALL).count() > 0


def test_entry_has_a_stable_schema(spark):
    df = entry.entry(spark)
    assert df.columns == ["series_id", "ts", "step", "forecast", "lower", "upper", "model", "fallback", "horizon_label"]


def test_every_query_is_listed():
    assert set(SQL) <= set(QUERIES)
    assert len(QUERIES) >= 150
