"""Every SQL-expressible query equals its DuckDB oracle on sf0.001 (exact values)."""

import datetime as dt

import duckdb
import pytest

import __spark_entry__ as E
from shelfcast.plans.oracle_queries import statements
from shelfcast.plans.queries import registry
from shelfcast.sources.storage import TESTDATA_TABLES

from .conftest import SF_SMALL

# values of the trained model: no oracle
BOOSTED = {"gradient_boosting", "gradient_boosting_curve", "model_scorecard_all", "forecast_models", "forecast_daily_all", "forecast_worst_all",
           "forecast_daily_by_model_all", "best_model_all", "reorder_outlook_all"}
KEYS = sorted(set(statements()) - {"gradient_boosting_rows"})


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TESTDATA_TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF_SMALL}/{t}.parquet'")
    return c


def _canon(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        return x.isoformat() if isinstance(x, (dt.date, dt.datetime)) else repr(x)

    return sorted(tuple(v(r[i]) for i in order) for r in rows)


def test_every_query_has_an_oracle_or_is_model():
    assert set(registry()) - set(statements()) == BOOSTED
    assert set(registry()) <= set(E.queries()) and set(statements()) <= set(E.oracle_sql())


def test_boosted_rows_match_oracle_after_two_rounds(spark, con, monkeypatch):
    from shelfcast.plans import queries

    real = queries.gradient_boosting
    monkeypatch.setattr(queries, "gradient_boosting", lambda s, d: real(s, d, max_iter=2))
    df = queries.gradient_boosting_rows(spark, SF_SMALL)
    rel = con.sql(statements()["gradient_boosting_rows"])
    assert _canon(df.columns, [tuple(r) for r in df.collect()]) == _canon(rel.columns, rel.fetchall())


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = E.queries()[key](spark, SF_SMALL)
    rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[key])
    orows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    assert len(rows) == len(orows)
    assert _canon(df.columns, rows) == _canon(rel.columns, orows)


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["cat_id", "total_units", "pct_of_all_units", "pct_of_all_revenue"]
    assert df.count() == 3
