import datetime as dt

from shelfcast.operators import checks, effects, forecast, scoring
from shelfcast.schemas import PREDICTIONS_SCHEMA

from .frames import fact_rows, series


def test_fact_checks_pass_on_dense_unique(spark):
    f = series(spark, [0, 1, 2, 0]).unionByName(series(spark, [3, 0, 0, 1], item="FOODS_1_002"))
    rows = {r["check_name"]: r for r in checks.fact_checks(f, 2, 4).collect()}
    assert all(r["passed"] for r in rows.values())
    assert rows["row_count_matches_series_x_days"]["actual"] == "8"
    assert rows["zero_sales_intermittency"]["actual"] == "50.0% of item-days"


def test_duplicate_pk_detected(spark):
    f = series(spark, [1, 2, 3])
    dup = f.unionByName(f.where("day_num = 2"))
    rows = {r["check_name"]: r for r in checks.fact_checks(dup, 1, 3).collect()}
    assert not rows["primary_key_unique"]["passed"] and rows["primary_key_unique"]["actual"] == "1"
    assert not rows["row_count_matches_series_x_days"]["passed"]
    assert [tuple(r) for r in checks.pk_duplicates(dup).collect()] == [("FOODS_1_001", "CA_1", "d_2", 2)]
    assert checks.hard_failures(list(rows.values()))


def test_series_coverage_reports_gap(spark):
    # the global day check passes (another series has day 30); only the per-series check sees the gap
    f = series(spark, list(range(60)), skip=(30,)).unionByName(series(spark, [1] * 60, item="FOODS_1_002"))
    got = [tuple(r) for r in checks.series_coverage(f).collect()]
    assert got == [("FOODS_1_001", "CA_1", 59, 1, 60, 60)]
    cov = checks.calendar_coverage(f).first()
    assert cov["distinct_days"] == 60 and cov["no_gaps"]


def test_grand_total_and_rows_by_state(spark):
    f = series(spark, [1, 2]).unionByName(series(spark, [1, 2], store="CA_2"))
    g = checks.grand_total_check(f).first()
    assert (g["actual_rows"], g["expected_rows"], g["passed"]) == (4, 4, True)
    s = checks.rows_by_state(f).first()
    assert (s["row_count"], s["distinct_items"], s["distinct_stores"], s["distinct_days"]) == (4, 1, 2, 2)


def test_lag_features_are_date_based_on_sparse_series(spark):
    vals = list(range(1, 61))
    f = series(spark, vals, skip=(5,))
    rows = {r["day_num"]: r for r in forecast.lag_features(f).collect()}
    assert rows[33]["lag_28"] is None          # day 5 is missing: a row shift would return day 4
    assert rows[34]["lag_28"] == 6 and rows[40]["lag_35"] is None and rows[41]["lag_35"] == 6
    assert rows[28]["lag_28"] is None and rows[28]["roll_28"] is None
    assert rows[29]["roll_28"] == 1.0
    # days 1..28 minus day 5 -> mean of 27 values
    expect = (sum(range(1, 29)) - 5) / 27
    assert abs(rows[56]["roll_28"] - expect) < 1e-12


def _two_series(spark, tail_a, tail_b, n=60):
    a = series(spark, [1] * (n - 28) + tail_a)
    b = series(spark, [0] * (n - 28) + tail_b, item="FOODS_1_002")
    return a.unionByName(b)


def test_no_leakage_from_holdout(spark):
    f1 = _two_series(spark, [5] * 28, [7] * 28)
    f2 = _two_series(spark, [50] * 28, [0] * 28)
    cut = forecast.holdout_cutoff(f1)
    assert cut == forecast.holdout_cutoff(f2)
    p1 = forecast.baseline_predictions(f1, cutoff=cut).select("date", "item_id", "model_name", "forecast_units")
    p2 = forecast.baseline_predictions(f2, cutoff=cut).select("date", "item_id", "model_name", "forecast_units")
    assert sorted(map(tuple, p1.collect())) == sorted(map(tuple, p2.collect()))
    assert p1.count() == 2 * 28 * 3


def test_series_starting_in_holdout_defaults_to_zero(spark):
    old = series(spark, [2] * 60)
    new = series(spark, [4] * 10, item="FOODS_1_009", start_day=51)
    p = forecast.baseline_predictions(old.unionByName(new))
    new_preds = p.where("item_id = 'FOODS_1_009'")
    assert new_preds.count() == 3 * 10
    assert {r["forecast_units"] for r in new_preds.collect()} == {0.0}
    assert {r["forecast_units"] for r in p.where("item_id = 'FOODS_1_001'").collect()} == {2.0}


def test_holdout_has_horizon_dates(spark):
    f = series(spark, list(range(40)))
    cut = forecast.holdout_cutoff(f)
    forecast.check_holdout(forecast.split(f, cut)[1])
    s = {r["split"]: r for r in forecast.holdout_summary(f, cut).collect()}
    assert s["test"]["dates"] == 28 and s["train"]["dates"] == 12


def test_scorecard_all_zero_actuals_total_ratio_null(spark):
    d = dt.date(2020, 1, 1)
    rows = [(d + dt.timedelta(days=i), "CA_1", "FOODS", "X", 0.0, 1.0, "m") for i in range(5)]
    card = scoring.model_scorecard(spark.createDataFrame(rows, PREDICTIONS_SCHEMA)).first()
    assert card["total_ratio"] is None and card["rmse"] == 1.0 and card["bias"] == 1.0 and card["predictions"] == 5


def test_moving_average_null_until_full_window(spark):
    f = series(spark, [1] * 28)
    ma = effects.daily_total_ma28(f.where("day_num <= 27")).collect()
    assert all(r["ma_28"] is None for r in ma)
    ma = effects.daily_total_ma28(f).collect()
    assert ma[-1]["ma_28"] == 1.0 and all(r["ma_28"] is None for r in ma[:-1])


def test_price_decile_ties_broken_by_day(spark):
    f = fact_rows(spark, [{"day_num": i, "sell_price": 1.0, "units_sold": i} for i in range(1, 21)])
    d = {r["price_decile"]: r["avg_daily_units"] for r in __import__("shelfcast.operators.price", fromlist=["x"])
         .price_decile_demand(f).collect()}
    assert d[1] == 1.5 and d[10] == 19.5


def test_gradient_boosting_small(spark):
    f = series(spark, [i % 7 for i in range(120)]).unionByName(
        series(spark, [(i * 3) % 5 for i in range(120)], item="FOODS_1_002"))
    cut = forecast.holdout_cutoff(f)
    p = forecast.gradient_boosting(f, cut, max_iter=3)
    rows = p.collect()
    assert len(rows) == 56 and min(r["forecast_units"] for r in rows) >= 0.0
    assert {r["model_name"] for r in rows} == {"gradient_boosting"}


def test_daily_agg_pk_shortcut_equals_distinct(spark):
    from shelfcast.operators import curate

    f = series(spark, [1, 0, 2]).unionByName(series(spark, [0, 0, 5], item="FOODS_1_002"))
    fast = sorted(map(tuple, curate.daily_sales_agg(f, pk_unique=True).collect()))
    exact = sorted(map(tuple, curate.daily_sales_agg(f).collect()))
    assert fast == exact and {r[-3] for r in fast} == {2}


def test_dense_and_range_lags_agree_on_dense_series(spark):
    f = series(spark, [(i * 7) % 11 for i in range(90)]).unionByName(
        series(spark, [(i * 3) % 5 for i in range(90)], item="FOODS_1_002"))
    cols = ["item_id", "day_num", "lag_28", "lag_35", "roll_28"]
    dense = sorted(map(tuple, forecast.lag_features(f, dense=True).select(*cols).collect()))
    rng = sorted(map(tuple, forecast.lag_features(f).select(*cols).collect()))
    assert dense == rng
