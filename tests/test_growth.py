"""The fact at part grain (one item per part: it grows with the input) against DuckDB over the raw files."""

import uuid

import duckdb
import pytest

from shelfcast.operators import checks, forecast, price, volume
from shelfcast.plans import fact_job
from shelfcast.session import work_root
from shelfcast.sources.readers import read_fact

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def part(spark):
    base = f"{work_root(spark)}/tests/part-{uuid.uuid4().hex[:8]}"
    b = fact_job.build_into(spark, SF_SMALL, base, grain="part")
    con = duckdb.connect()
    con.sql(f"""CREATE TABLE d AS SELECT p_partkey AS part, l_suppkey % 10 AS store, CAST(l_shipdate AS DATE) AS date, CAST(sum(l_quantity) AS BIGINT) AS units
                FROM '{SF_SMALL}/lineitem.parquet' JOIN '{SF_SMALL}/part.parquet' ON l_partkey = p_partkey GROUP BY ALL""")
    return read_fact(spark, b.fact), b, con


def test_rows_units_and_checks(spark, part):
    fact, b, con = part
    n_series, units = con.sql("SELECT count(DISTINCT (part, store)), sum(units) FROM d").fetchall()[0]
    assert b.n_series == n_series > 250
    assert fact.count() == n_series * b.n_days
    assert {r["check_name"]: r["passed"] for r in checks.fact_checks(fact, b.n_series, b.n_days).collect()} == dict.fromkeys(checks.CHECK_NAMES, True)
    assert fact.agg({"units_sold": "sum"}).first()[0] == units
    by_state = {r["state_id"]: r["row_count"] for r in checks.rows_by_state(fact).collect()}
    want = con.sql("SELECT CASE WHEN store < 4 THEN 'CA' WHEN store < 7 THEN 'TX' ELSE 'WI' END, count(DISTINCT (part, store)) FROM d GROUP BY 1").fetchall()
    assert by_state == {s: n * b.n_days for s, n in want}


def test_top_items_lags_and_price_moves(spark, part):
    fact, b, con = part
    top = [(int(r["item_id"].rsplit("_", 1)[1]), r["total_units"]) for r in volume.top_items(fact, 10).collect()]
    assert sorted(u for _, u in top) == sorted(r[0] for r in con.sql("SELECT sum(units) FROM d GROUP BY part ORDER BY 1 DESC LIMIT 10").fetchall())
    lags = forecast.lag_features(fact.select("item_id", "store_id", "date", "day_num", "units_sold"), dense=True)
    got = lags.agg({"lag_28": "sum"}).first()[0]
    want = con.sql("SELECT sum(units) FROM d WHERE date <= (SELECT max(date) FROM d) - 28").fetchall()[0][0]
    assert got == want
    assert price.price_change_lift(fact, "CA").count() > 0


def test_one_pass_baselines_equal_the_single_models(spark, part):
    fact, b, _ = part
    few = fact.where("store_id in ('CA_1', 'WI_2')").cache()
    cutoff = forecast.holdout_cutoff(few)
    train, test = forecast.split(few, cutoff)
    single = (forecast.naive_last_value(train, test).unionByName(forecast.seasonal_naive(few, test, cutoff)).unionByName(forecast.weekday_mean(train, test)))
    both = forecast.baseline_predictions(few, cutoff=cutoff)
    assert both.exceptAll(single).count() == 0 == single.exceptAll(both).count() and both.count() > 0
    few.unpersist()
