
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
from hypothesis import assume, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import __spark_entry__ as E
from shelfcast.functions import round_ratio

from .conftest import SF_SMALL


def _q(spark, key):
    return E.queries()[key](spark, SF_SMALL)


def test_states_sum_to_total(spark):
    by_state = sum(r["row_count"] for r in _q(spark, "rows_by_state").collect())
    total = _q(spark, "grand_total_check").first()
    assert by_state == total["actual_rows"] == total["expected_rows"] and total["passed"]


def test_quality_summary_agrees_with_intermittency(spark):
    cats = _q(spark, "intermittency").collect()
    zero, days = sum(r["zero_days"] for r in cats), sum(r["item_days"] for r in cats)
    summary = {r["check_name"]: r for r in _q(spark, "quality_summary").collect()}
    assert summary["total_rows"]["metric"] == days
    expected = float((Decimal(100 * zero) / Decimal(days)).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))
    assert summary["pct_zero_sales_days"]["metric"] == expected
    nulls = sum(r["null_price_rows"] for r in _q(spark, "null_price_by_year").collect())
    assert _q(spark, "null_quality_row").first()["null_price_expected"] == nulls


def test_curated_rollup_reaggregates_to_store_category_totals(spark):
    daily = _q(spark, "daily_sales_agg").groupBy("state_id", "store_id", "cat_id").agg(
        F.sum("total_units").alias("u"), F.sum("items_with_sales").alias("w"))
    got = {(r[0], r[1], r[2]): r[3] for r in daily.collect()}
    want = {(r["state_id"], r["store_id"], r["cat_id"]): r["total_units"]
            for r in _q(spark, "sales_by_category_store").collect()}
    assert got == want
    weekly = _q(spark, "weekly_item_agg").agg(F.sum("weekly_units")).first()[0]
    assert weekly == sum(want.values())


def test_scorecard_matches_numpy(spark):
    pred = _q(spark, "predictions").toPandas()
    card = {r["model_name"]: r for r in _q(spark, "model_scorecard").collect()}
    for model, g in pred.groupby("model_name"):
        a, f = g["actual_units"].to_numpy(float), g["forecast_units"].to_numpy(float)
        assert abs(card[model]["rmse"] - np.sqrt(np.mean((a - f) ** 2))) < 5.1e-5
        assert abs(card[model]["mae"] - np.mean(np.abs(a - f))) < 5.1e-5
        assert abs(card[model]["bias"] - np.mean(f - a)) < 5.1e-5
        assert card[model]["predictions"] == len(g)


@settings(max_examples=60, deadline=None)
@given(st.integers(-10**15, 10**15), st.integers(1, 10**9), st.integers(0, 4))
def test_round_ratio_property(spark, num, den, digits):
    assume(abs(num) * 10**digits // den < 2**53)  # where a double holds every digit of the result
    got = spark.range(1).select(round_ratio(F.lit(num), F.lit(den), digits)).first()[0]
    want = (Decimal(num) / Decimal(den)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP)
    assert got == float(want)


def test_round_ratio_large_values_do_not_overflow(spark):
    num = 922_337_203_685_478_000
    got = spark.range(1).select(round_ratio(F.lit(num), F.lit(7), 4)).first()[0]
    assert abs(got - num / 7) / (num / 7) < 1e-15


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(st.integers(0, 500), min_size=5, max_size=5), min_size=1, max_size=6))
def test_melt_property(spark, rows):
    """Melting any wide frame gives series x days rows, keeps every value, and pivots back to itself."""
    from pyspark.sql import types as T

    from shelfcast.operators.reshape import melt

    ids = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ids]
                          + [T.StructField(f"d_{i}", T.IntegerType()) for i in range(1, 6)])
    data = [(f"s{k}", f"i{k}", "D", "C", "S", "X", *r) for k, r in enumerate(rows)]
    wide = spark.createDataFrame(data, schema)
    long = melt(wide)
    got = long.collect()
    assert len(got) == 5 * len(rows)
    assert sum(r["units_sold"] for r in got) == sum(map(sum, rows))
    back = long.groupBy("id").pivot("d", [f"d_{i}" for i in range(1, 6)]).agg(F.first("units_sold"))
    assert sorted(map(tuple, back.collect())) == sorted((d[0], *d[6:]) for d in data)
