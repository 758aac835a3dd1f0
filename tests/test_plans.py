"""Plan properties: native expressions only, pruning/pushdown at the scan, calendar broadcast."""

import pytest

import __spark_entry__ as E

from shelfcast.plans.queries import registry
from shelfcast.sources import fixture

from .conftest import SF_SMALL

PY_NODES = ("BatchEvalPython", "ArrowEvalPython", "PythonUDF", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


MODEL_KEYS = ("gradient_boosting", "gradient_boosting_curve", "model_scorecard_all", "gradient_boosting_rows")


@pytest.mark.parametrize("key", sorted(k for k in registry() if k not in MODEL_KEYS))
def test_no_python_in_plans(spark, key):
    plan = _plan(E.queries()[key](spark, SF_SMALL))
    assert not any(n in plan for n in PY_NODES), key


def test_no_python_in_the_build(spark):
    first, days = fixture.calendar_bounds(spark, SF_SMALL)
    daily = fixture.daily_units(spark, SF_SMALL, first)
    for df in (fixture.sales_wide_lines(daily, days), fixture.prices(spark, SF_SMALL, daily, days), fixture.calendar(spark, first, days)):
        plan = _plan(df)
        assert not any(n in plan for n in PY_NODES) and "CartesianProduct" not in plan


def test_baselines_read_the_fact_twice(spark):
    from shelfcast.operators import forecast
    from shelfcast.plans.queries import _cutoff, fact

    plan = _plan(forecast.baseline_predictions(fact(spark, SF_SMALL), cutoff=_cutoff(spark, SF_SMALL)))
    assert plan.count("Scan parquet") <= 3 and "Exchange hashpartitioning" not in plan


def test_state_filter_prunes_partitions(spark):
    plan = _plan(E.queries()["price_decile_demand"](spark, SF_SMALL))
    assert "PartitionFilters: [isnotnull(state_id" in plan and "(state_id#" in plan


def test_threshold_pushed_to_parquet(spark):
    plan = _plan(E.queries()["outlier_scan"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(units_sold), GreaterThan(units_sold,60)]" in plan


def test_column_pruning(spark):
    plan = _plan(E.queries()["weekday_seasonality"](spark, SF_SMALL))
    assert "ReadSchema: struct<weekday:string,wday:int,units_sold:int>" in plan


def test_calendar_is_broadcast(spark):
    plan = _plan(E.queries()["fact_enriched"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in plan and "[d#" in plan


def test_multi_distinct_has_no_expand(spark):
    for key in ("rows_by_state", "grand_total_check", "scope_profile"):
        assert "Expand" not in _plan(E.queries()[key](spark, SF_SMALL)), key


def test_bucketed_fact_removes_series_shuffles(spark):
    """The fact is bucketed by (store_id, item_id): series windows and aggregates need no exchange."""
    for key in ("lag_features", "pk_duplicates", "naive_last_value"):
        plan = _plan(E.queries()[key](spark, SF_SMALL))
        assert "Exchange hashpartitioning" not in plan, key
        assert "bucketed" in plan.lower() or "SelectedBucketsCount" in plan, key
