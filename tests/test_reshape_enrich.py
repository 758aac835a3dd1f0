import datetime as dt

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.enrich import ValidationError, assert_unique_keys, enrich, resolve_snap
from shelfcast.operators.reshape import day_columns, melt
from shelfcast.plans.fact_job import validate
from shelfcast.schemas import CALENDAR_COLS

from .frames import WIDE_SCHEMA


def _wide(spark):
    return spark.createDataFrame([
        ("A_CA_1", "A", "FOODS_1", "FOODS", "CA_1", "CA", 1, 0, 3, 2),
        ("B_ZZ_1", "B", "FOODS_1", "FOODS", "ZZ_1", "ZZ", 0, 0, 0, 0),
    ], WIDE_SCHEMA)


def _calendar(spark, days=4, drop=()):
    rows = []
    for n in range(1, days + 1):
        if n in drop:
            continue
        d = dt.date(2020, 1, 3) + dt.timedelta(days=n - 1)
        rows.append((f"d_{n}", d, 1, "x", 1, 1, 2020, "Ev" if n == 2 else None, "T" if n == 2 else None,
                     None, None, 1, 0, 1))
    return spark.createDataFrame(rows, "d string, date date, wm_yr_wk int, weekday string, wday int, month int, "
                                       "year int, event_name_1 string, event_type_1 string, event_name_2 string, "
                                       "event_type_2 string, snap_CA int, snap_TX int, snap_WI int").select(*CALENDAR_COLS)


def _prices(spark, dup=False, from_week=1):
    rows = [("CA_1", "A", 1, 2.5)] if from_week <= 1 else []
    if dup:
        rows.append(("CA_1", "A", 1, 2.6))
    return spark.createDataFrame(rows or [("CA_1", "A", 9, 1.0)], "store_id string, item_id string, wm_yr_wk int, sell_price double")


def test_day_columns_and_melt(spark):
    wide = _wide(spark)
    assert day_columns(wide.columns) == ["d_1", "d_2", "d_3", "d_4"]
    long = melt(wide)
    assert long.count() == 8
    got = {(r["id"], r["d"], r["day_num"], r["units_sold"]) for r in long.collect()}
    assert ("A_CA_1", "d_3", 3, 3) in got and ("B_ZZ_1", "d_4", 4, 0) in got


def test_melt_then_pivot_is_identity(spark):
    wide = _wide(spark)
    back = melt(wide).groupBy("id").pivot("d", ["d_1", "d_2", "d_3", "d_4"]).agg(F.first("units_sold"))
    assert sorted(map(tuple, back.collect())) == sorted(
        tuple(r) for r in wide.select("id", "d_1", "d_2", "d_3", "d_4").collect())


def test_melt_non_contiguous_header(spark):
    wide = _wide(spark).select("id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d_2", "d_4")
    rows = melt(wide).where("id = 'A_CA_1'").orderBy("day_num").collect()
    assert [(r["d"], r["day_num"], r["units_sold"]) for r in rows] == [("d_2", 2, 0), ("d_4", 4, 2)]


def test_enrich_keeps_rows_null_price_and_snap(spark):
    fact = enrich(melt(_wide(spark)), _calendar(spark), _prices(spark, from_week=2))
    rows = fact.collect()
    assert len(rows) == 8
    assert all(r["sell_price"] is None and r["revenue"] == 0.0 for r in rows)
    # state outside CA/TX/WI gets flag 0; CA takes snap_CA
    assert {r["snap_flag"] for r in rows if r["state_id"] == "ZZ"} == {0}
    assert {r["snap_flag"] for r in rows if r["state_id"] == "CA"} == {1}
    assert {r["has_event"] for r in rows if r["d"] == "d_2"} == {1}


def test_revenue_uses_price(spark):
    fact = enrich(melt(_wide(spark)), _calendar(spark), _prices(spark))
    r = fact.where("id = 'A_CA_1' AND d = 'd_3'").first()
    assert r["sell_price"] == 2.5 and r["revenue"] == 7.5


def test_duplicate_price_key_raises(spark):
    with pytest.raises(ValidationError):
        assert_unique_keys(_prices(spark, dup=True), ["store_id", "item_id", "wm_yr_wk"], "sell_prices")
    with pytest.raises(ValidationError):
        enrich(melt(_wide(spark)), _calendar(spark), _prices(spark, dup=True))


def test_missing_calendar_day_fails_validation(spark):
    fact = enrich(melt(_wide(spark)), _calendar(spark, drop=(3,)), _prices(spark))
    with pytest.raises(ValidationError, match="calendar_join_complete"):
        validate(fact, 2, 4)


def test_resolve_snap_drops_state_columns(spark):
    df = spark.createDataFrame([("TX", 0, 1, 0)], "state_id string, snap_CA int, snap_TX int, snap_WI int")
    out = resolve_snap(df)
    assert out.columns == ["state_id", "snap_flag"] and out.first()["snap_flag"] == 1


def test_series_price_attach_matches_long_join(spark):
    from shelfcast.operators.enrich import attach_prices, number_weeks
    from shelfcast.operators.enrich import PRICE_COLS
    from shelfcast.schemas import ID_COLS

    wide, cal, prices = _wide(spark), _calendar(spark), _prices(spark)
    weeks = number_weeks(cal)
    a = enrich(melt(attach_prices(wide, prices, weeks), id_cols=ID_COLS + PRICE_COLS), weeks)
    b = enrich(melt(wide), cal, prices)
    assert a.columns == b.columns
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def test_series_price_attach_fails_on_duplicate_key(spark):
    from shelfcast.operators.enrich import attach_prices, number_weeks
    from shelfcast.operators.enrich import PRICE_COLS
    from shelfcast.schemas import ID_COLS

    weeks = number_weeks(_calendar(spark))
    fact = enrich(melt(attach_prices(_wide(spark), _prices(spark, dup=True), weeks), id_cols=ID_COLS + PRICE_COLS), weeks)
    with pytest.raises(Exception, match="duplicate"):
        fact.collect()


def test_read_sales_wide_variant_from_header(spark, tmp_path):
    """A1/A4: the number of days comes from the header (evaluation vs shorter validation file)."""
    from shelfcast.sources.readers import read_sales_wide

    for n_days in (4, 3):
        p = tmp_path / f"wide{n_days}"
        p.mkdir()
        header = "id,item_id,dept_id,cat_id,store_id,state_id," + ",".join(f"d_{i}" for i in range(1, n_days + 1))
        body = ["A_CA_1,A,FOODS_1,FOODS,CA_1,CA," + ",".join(str(i) for i in range(n_days))]
        (p / "part-0.csv").write_text("\n".join([header] + body) + "\n")
        wide = read_sales_wide(spark, str(p))
        assert day_columns(wide.columns) == [f"d_{i}" for i in range(1, n_days + 1)]
        assert dict(wide.dtypes)["d_1"] == "int"
        assert melt(wide).count() == n_days


def test_raw_zone_shapes(spark):
    """The derived raw files: 250 series x 2,499 day columns, dense calendar, prices after first sale."""
    from shelfcast.plans import fact_job
    from shelfcast.sources.readers import read_calendar, read_prices, read_sales_wide

    from .conftest import SF_SMALL

    b = fact_job.stage(spark, SF_SMALL)
    wide = read_sales_wide(spark, b.sales_wide)
    assert wide.count() == 250 and len(day_columns(wide.columns)) == b.n_days == 2499
    cal = read_calendar(spark, b.calendar)
    assert cal.count() == 2499 and cal.select("d").distinct().count() == 2499
    assert cal.where("d = 'd_1'").first()["weekday"] == "Monday"
    prices = read_prices(spark, b.prices)
    assert prices.groupBy("store_id", "item_id", "wm_yr_wk").count().where("count > 1").count() == 0


def test_series_price_with_gap_and_jumping_week_keys(spark):
    """Weeks are looked up by their number in the calendar: gaps in a series and jumps in the keys are fine."""
    from shelfcast.operators.enrich import PRICE_COLS, attach_prices, number_weeks
    from shelfcast.schemas import ID_COLS

    prices = spark.createDataFrame([("CA_1", "A", 11152, 2.5), ("CA_1", "A", 11202, 3.0), ("CA_1", "A", 99999, 9.0)],
                                   "store_id string, item_id string, wm_yr_wk int, sell_price double")
    key = F.element_at(F.array(*[F.lit(k) for k in (11152, 11201, 11202, 11203)]), F.col("d").substr(3, 1).cast("int"))
    cal = _calendar(spark, days=4).withColumn("wm_yr_wk", key)  # week = day
    weeks = number_weeks(cal)
    fact = enrich(melt(attach_prices(_wide(spark), prices, weeks), id_cols=ID_COLS + PRICE_COLS), weeks)
    got = {r["d"]: r["sell_price"] for r in fact.where("id = 'A_CA_1'").collect()}
    assert got == {"d_1": 2.5, "d_2": None, "d_3": 3.0, "d_4": None}
    long = enrich(melt(_wide(spark)), cal, prices)
    assert sorted(map(tuple, fact.collect())) == sorted(map(tuple, long.collect()))
