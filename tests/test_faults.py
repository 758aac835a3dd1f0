"""Data faults of the first round, each shown on data that had hit it."""

import datetime as dt
import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfcast.functions import avg_money_rounded, money_rounded, money_sum
from shelfcast.operators import curate
from shelfcast.operators.enrich import ValidationError
from shelfcast.operators.reshape import melt, melt_units
from shelfcast.plans import fact_job, queries
from shelfcast.session import work_root
from shelfcast.sources import catalog, storage
from shelfcast.sources.fixture import padded
from shelfcast.sources.readers import read_calendar, read_prices, read_sales_lines, read_sales_wide

from .conftest import SF_SMALL


def _folder(spark, name):
    return f"{work_root(spark)}/tests/{name}-{uuid.uuid4().hex[:8]}".removeprefix("file://").removeprefix("file:")


def _text(spark, path, *lines):
    spark.createDataFrame([(x,) for x in lines], "v string").coalesce(1).write.text(path)


def test_long_item_keys_stay_whole(spark):
    keys = spark.createDataFrame([("7",), ("123456",), ("1234567",), ("1234568",)], "k string")
    assert [r[0] for r in keys.select(padded(F.col("k"), 6)).collect()] == ["000007", "123456", "1234567", "1234568"]


def test_money_is_summed_before_it_is_rounded(spark):
    df = spark.range(1000).select(F.lit(0.004).alias("m"))
    got = df.agg(money_rounded(money_sum("m"), 2).alias("s"), avg_money_rounded("m", 3).alias("a")).first()
    assert (got["s"], got["a"]) == (4.0, 0.004)
    with pytest.raises(PySparkException, match="decimals"):
        spark.range(3).select(F.lit(0.00001).alias("m")).agg(money_sum("m")).collect()
    assert spark.range(2).select(F.lit(None).cast("double").alias("m")).agg(money_sum("m").alias("s")).first()["s"] is None


@pytest.mark.parametrize("change", ["rewritten", "added"])
def test_fingerprint_follows_the_files_of_a_folder(spark, change):
    base = _folder(spark, "finger")
    path = f"{base}/lineitem.parquet"
    spark.range(10).coalesce(1).write.parquet(path)
    spark.range(5).write.parquet(f"{base}/part.parquet")
    key = lambda d: storage.build_dir(spark, d)
    before = key(base), key(f"file://{base}")
    assert before == (key(base), key(f"file://{base}"))
    spark.range(10, 20).coalesce(1).write.mode("overwrite" if change == "rewritten" else "append").parquet(path)
    assert key(base) != before[0] and key(f"file://{base}") != before[1]


def test_items_active_counts_distinct_items_by_default(spark):
    fact = fact_job.sales_long(spark, SF_SMALL).where("store_id = 'CA_1' and day_num = 30")
    doubled = fact.unionByName(fact)
    pick = lambda df: {r["dept_id"]: r["items_active"] for r in df.select("dept_id", "items_active").collect()}
    assert pick(curate.daily_sales_agg(doubled)) == pick(curate.daily_sales_agg(fact, pk_unique=True))


def test_derived_tables_depend_on_the_label_module(spark, monkeypatch):
    import inspect

    b = fact_job.stage(spark, SF_SMALL)
    before = queries._versioned(b, "x")
    real = inspect.getsource
    monkeypatch.setattr(inspect, "getsource", lambda m: real(m) + ("# changed" if m is queries.labels else ""))
    assert queries._versioned(b, "x") != before


def test_readers_go_by_name(spark):
    base = _folder(spark, "named")
    _text(spark, f"{base}/cal", "date,extra,wm_yr_wk,weekday,wday,month,year,d,event_type_1,event_name_1,event_name_2,event_type_2,snap_WI,snap_TX,snap_CA",
          "2011-01-29,z,11101,Saturday,1,1,2011,d_1,,,,,0,1,0")
    r = read_calendar(spark, f"{base}/cal").first()
    assert (r["d"], r["date"], r["wm_yr_wk"], r["snap_TX"], r["event_name_1"]) == ("d_1", dt.date(2011, 1, 29), 11101, 1, None)
    _text(spark, f"{base}/prices", "sell_price,item_id,note,store_id,wm_yr_wk", "9.58,HOBBIES_1_001,x,CA_1,11325")
    assert tuple(read_prices(spark, f"{base}/prices").first()) == ("CA_1", "HOBBIES_1_001", 11325, 9.58)
    _text(spark, f"{base}/bad", "store_id,item_id,sell_price", "CA_1,A,1.0")
    with pytest.raises(ValueError, match="wm_yr_wk"):
        read_prices(spark, f"{base}/bad")


def test_line_melt_equals_column_melt(spark):
    base = _folder(spark, "lines")
    head = "state_id,id,item_id,dept_id,cat_id,store_id,d_1,d_2,d_3"
    _text(spark, f"{base}/plain", head, "CA,a_CA_1,a,D,C,CA_1,0,5,12", "TX,b_TX_1,b,D,C,TX_1,3,,7", 'WI,"c,1_WI_1","c x, 1",D,C,WI_1,1,2,3')
    key = ["id", "day_num"]
    columns = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "day_num", "units_sold"]
    wide = melt(read_sales_wide(spark, f"{base}/plain")).select(*columns).orderBy(*key).collect()
    lines = melt_units(*read_sales_lines(spark, f"{base}/plain")).select(*columns).orderBy(*key).collect()
    assert wide == lines and len(lines) == 9
    _text(spark, f"{base}/mixed", "d_2,id,item_id,x,dept_id,cat_id,store_id,state_id,d_1", "5,i,a,q,D,C,CA_1,CA,4")
    got = melt_units(*read_sales_lines(spark, f"{base}/mixed")).orderBy("day_num").collect()
    assert [(r["d"], r["units_sold"]) for r in got] == [("d_1", 4), ("d_2", 5)]


def test_failed_checks_leave_no_table_and_skip_write_writes_nothing(spark):
    b = fact_job.stage(spark, SF_SMALL)
    out = _folder(spark, "job")
    bad = f"{out}/sales"
    lines = spark.read.text(b.sales_wide)
    lines.select(F.when(F.col("value").startswith("FOODS_1_003_CA_1"), F.regexp_replace("value", ",[0-9]+$", ",-4")).otherwise(F.col("value")).alias("value")).write.text(bad)
    with pytest.raises(ValidationError, match="non_negative"):
        fact_job.run_job(spark, bad, b.calendar, b.prices, f"{out}/failed")
    failed = fact_job.Build(f"{out}/failed", None, 0, 0)
    names = [t.name for t in spark.catalog.listTables(catalog.DATABASE)]
    assert failed.fact_table not in names and f"staging_{failed.fact_table}" not in names
    assert not storage.path_exists(spark, f"{out}/failed/processed/meta/_SUCCESS")
    rows, n_series, _, _ = fact_job.run_job(spark, b.sales_wide, b.calendar, b.prices, f"{out}/skipped", stores=["TX_2"], skip_write=True)
    assert n_series == 25 and all(r["passed"] for r in rows) and not storage.path_exists(spark, f"{out}/skipped")
    _, n_series, n_days, buckets = fact_job.run_job(spark, b.sales_wide, b.calendar, b.prices, f"{out}/scoped", states=["WI"])
    assert spark.table(catalog.qualified(fact_job.Build(f"{out}/scoped", None, 0, 0, buckets).fact_table)).count() == n_series * n_days


def test_buckets_grow_with_the_fact():
    counts = [fact_job.bucket_count(n, 2000, 8) for n in (10, 30_000, 3_000_000)]
    assert counts == [8, 12, 1200]


def test_missing_checkpoint_folder_is_refused_off_local_masters(spark, monkeypatch):
    from shelfcast import session

    class Context:
        master = "yarn"

        @staticmethod
        def getCheckpointDir():
            return None

        @staticmethod
        def getConf():
            return {}

    class Session:
        sparkContext = Context()

        class conf:  # noqa: N801
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.work_root(Session())
