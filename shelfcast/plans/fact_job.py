"""The fact build job: raw zone -> melt -> joins -> staged Parquet -> checks -> publish.

Same fail-before-publish contract as the reference's transform, without
recomputing the plan per check: the fact is written once (partitioned by state),
the checks run on the staged Parquet (a cheap columnar scan), and only when no
hard check fails is the ``meta`` marker written.  Readers use a build only if
its marker exists, so a failed or half-written run is never read.

Everything lives under the session's shared checkpoint folder, keyed by the
input files and the build code, so later queries (and other sessions) reuse the
published build; each build has its own folder and is published by a pointer.
"""

from __future__ import annotations

import datetime as dt
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import checks
from ..operators.enrich import PRICE_COLS, ValidationError, attach_prices, enrich, number_weeks, require_rows, scope
from ..operators.reshape import melt_units
from ..schemas import FACT_SCHEMA, ID_COLS
from ..session import parallelism
from ..sources import catalog, fixture
from ..sources.readers import read_calendar, read_fact, read_prices, read_sales_lines, scope_fact
from ..sources.storage import build_dir, path_exists
from ..sources.writers import BUCKET_COLS, write_fact, write_small_csv

_META_SCHEMA = T.StructType([
    T.StructField("first_day", T.DateType()),
    T.StructField("n_days", T.IntegerType()),
    T.StructField("n_series", T.LongType()),
    T.StructField("n_buckets", T.IntegerType()),
])

_LOCK = threading.Lock()
_MEMO: dict[str, "Build"] = {}


@dataclass(frozen=True)
class Build:
    base: str
    first_day: dt.date
    n_days: int
    n_series: int
    n_buckets: int = 0

    @property
    def raw(self) -> str:
        return f"{self.base}/raw"

    @property
    def sales_wide(self) -> str:
        return f"{self.raw}/sales_wide"

    @property
    def calendar(self) -> str:
        return f"{self.raw}/calendar"

    @property
    def prices(self) -> str:
        return f"{self.raw}/sell_prices"

    @property
    def fact(self) -> str:
        return f"{self.base}/processed/sales_long"

    @property
    def checks(self) -> str:
        return f"{self.base}/processed/validation_summary"

    def curated(self, name: str) -> str:
        return f"{self.base}/curated/{name}"

    @property
    def fact_table(self) -> str:
        import hashlib

        return "sales_long_" + hashlib.sha1(self.base.encode()).hexdigest()[:12]


# Rows of the fact per bucket, about (a bucketed scan reads one bucket per task).
ROWS_PER_BUCKET = 5_000_000


def bucket_count(n_series: int, n_days: int, cores: int, rows_per_bucket: int = ROWS_PER_BUCKET) -> int:
    """Buckets of the fact: from its size (series x days), at least one per core."""
    return max(cores, -(-n_series * n_days // rows_per_bucket), 1)


def transform(spark: SparkSession, sales_wide_path: str, calendar_path: str, prices_path: str,
              states=None, stores=None, price_join: str = "series", width: int | None = None
              ) -> tuple[DataFrame, int, int]:
    """The transform proper: read the three raw files, melt, enrich. Returns (fact, n_series, n_days).

    ``price_join="series"`` (default) attaches each series' weekly prices to
    its wide row before the melt, so only series-level rows are shuffled;
    ``"long"`` is the melt-then-join plan (shuffles every fact row).
    ``width`` is the number of partitions (by default :func:`bucket_count`).
    """
    lines, days = read_sales_lines(spark, sales_wide_path)
    wide = scope(lines, states, stores)
    if states or stores:
        require_rows(wide)
    n_series, n_days = wide.select("store_id").count(), len(days)
    calendar, prices = read_calendar(spark, calendar_path), read_prices(spark, prices_path)
    if price_join == "series":
        # Sorting the wide rows (one per series) orders the melted rows by
        # (state, store, item, day) inside each task for the price of a
        # series-level sort, so written files carry tight item/store statistics.
        # Wide rows are small in bytes but each expands to n_days fact rows, so
        # file splits are a poor unit of work: hash them by series (the
        # partitioning the price join and the bucketed write need anyway).
        calendar = number_weeks(calendar)
        wide = wide.repartition(width or bucket_count(n_series, n_days, parallelism(spark)), *BUCKET_COLS)
        series = attach_prices(wide, prices, calendar).sortWithinPartitions("state_id", "store_id", "item_id")
        fact = enrich(melt_units(series, days, ID_COLS + PRICE_COLS), calendar)
    else:
        fact = enrich(melt_units(wide, days), calendar, prices)
    return fact, n_series, n_days


def validate(fact: DataFrame, n_series: int, n_days: int) -> list:
    """F29 on a (staged) fact; raises ValidationError on any hard failure."""
    rows = checks.fact_checks(fact, n_series, n_days).collect()
    bad = checks.hard_failures(rows)
    if bad:
        raise ValidationError("hard validation failure: " + ", ".join(f"{r['check_name']}={r['actual']}" for r in bad))
    return rows


def validate_only(spark: SparkSession, sales_wide_path: str, calendar_path: str, prices_path: str,
                  states=None, stores=None) -> list:
    """A7 ``--skip-write``: run the (optionally scoped) transform and its checks without writing."""
    fact, n_series, n_days = transform(spark, sales_wide_path, calendar_path, prices_path, states, stores)
    return validate(fact, n_series, n_days)


def _read_meta(spark: SparkSession, base: str) -> Build | None:
    meta = f"{base}/processed/meta"
    if not path_exists(spark, f"{meta}/_SUCCESS"):
        return None
    row = spark.read.schema(_META_SCHEMA).json(meta).first()
    if row is None:
        return None
    return Build(base, row["first_day"], row["n_days"], row["n_series"], row["n_buckets"] or 0)


def run_job(spark: SparkSession, sales: str, calendar: str, prices: str, out: str, states=None, stores=None,
            skip_write: bool = False, timings: dict | None = None) -> tuple[list, int, int, int]:
    """The whole job over raw files: transform, staged write, checks once, then published under ``out``.

    Returns (check rows, series, days, buckets).  With ``skip_write`` only the
    checks run.  The fact becomes visible in the catalog (and its ``meta`` marker
    is written) only after every hard check passed; else ``ValidationError``.
    """
    import time

    t = time.time()
    if skip_write:
        fact, n_series, n_days = transform(spark, sales, calendar, prices, states, stores)
        return validate(fact, n_series, n_days), n_series, n_days, 0
    lines, days = read_sales_lines(spark, sales)
    width = bucket_count(scope(lines, states, stores).select("store_id").count(), len(days), parallelism(spark))
    fact, n_series, n_days = transform(spark, sales, calendar, prices, states, stores, width=width)
    here = Build(out, None, n_days, n_series, width)
    staging = f"staging_{here.fact_table}"
    try:
        write_fact(fact, here.fact, buckets=width, table=staging)
    finally:
        catalog.drop_table(spark, staging)  # the files stay; nothing unchecked is visible
    t_write = time.time()
    rows = validate(read_fact(spark, here.fact), n_series, n_days)
    if timings is not None:
        timings.update(transform_write=round(t_write - t, 3), checks=round(time.time() - t_write, 3),
                       rows=n_series * n_days, series=n_series, buckets=width)
    write_small_csv(spark.createDataFrame(rows), here.checks)
    # input series per store (expected rows of the per-store checks), counted once here
    (scope(lines, states, stores).groupBy("store_id").agg(F.count(F.lit(1)).alias("n_series"))
        .coalesce(1).write.mode("overwrite").parquet(f"{out}/processed/series_per_store"))
    first_day = read_calendar(spark, calendar).where(F.col("d") == days[0]).select("date").first()[0]
    meta = spark.createDataFrame([(first_day, n_days, n_series, width)], _META_SCHEMA)
    meta.coalesce(1).write.mode("overwrite").json(f"{out}/processed/meta")
    fact_table(spark, here)
    return rows, n_series, n_days, width


def build_into(spark: SparkSession, sf_dir: str, base: str, grain: str = "brand", timings: dict | None = None) -> Build:
    """Raw zone from the given tables into ``base``, then :func:`run_job` over it."""
    import time

    t = time.time()
    info = fixture.write_raw_zone(spark, sf_dir, f"{base}/raw", grain)
    if timings is not None:
        timings["raw_zone"] = round(time.time() - t, 3)
    raw = Build(base, info["first_day"], info["n_days"], 0)
    _, n_series, n_days, width = run_job(spark, raw.sales_wide, raw.calendar, raw.prices, base, timings=timings)
    return Build(base, info["first_day"], n_days, n_series, width)


_POINTER_SCHEMA = T.StructType([T.StructField("base", T.StringType())])


def _read_pointer(spark: SparkSession, key: str) -> Build | None:
    pointer = f"{key}/current"
    if not path_exists(spark, f"{pointer}/_SUCCESS"):
        return None
    row = spark.read.schema(_POINTER_SCHEMA).json(pointer).first()
    return _read_meta(spark, row["base"]) if row is not None else None


def stage(spark: SparkSession, sf_dir: str, base: str | None = None) -> Build:
    """Build (once) and publish the raw zone and the validated ``sales_long`` fact for ``sf_dir``.

    Each build writes into its own folder under the input-keyed folder; only
    after its checks pass is ``<key>/current`` pointed at it.  A killed build
    is never read, and two processes building at once each publish a complete
    build.  ``base`` forces a fresh build into that folder (benchmarks).
    """
    import uuid

    key = build_dir(spark, sf_dir)
    with _LOCK:
        if base is None and key in _MEMO:
            return _MEMO[key]
        build = None if base is not None else _read_pointer(spark, key)
        if build is None:
            build = _read_meta(spark, base) if base is not None else None
        if build is None:
            build = build_into(spark, sf_dir, base or f"{key}/{uuid.uuid4().hex[:12]}")
            if base is None:
                spark.createDataFrame([(build.base,)], _POINTER_SCHEMA).coalesce(1).write.mode(
                    "overwrite").json(f"{key}/current")
        _MEMO[key] = build
        return build


def fact_table(spark: SparkSession, b: Build) -> str:
    """The published fact as a bucketed external table in this session's catalog (registered once)."""
    with catalog._DDL_LOCK:
        if not catalog.table_exists(spark, b.fact_table):
            catalog.register_external(spark, b.fact_table, b.fact, FACT_SCHEMA, ["state_id"],
                                      bucket_by=(b.n_buckets, BUCKET_COLS))
    return catalog.qualified(b.fact_table)


def sales_long(spark: SparkSession, sf_dir: str, columns=None, states=None, categories=None) -> DataFrame:
    """The published fact as a DataFrame (partition + column pruning applied at the scan).

    Read through its bucketed table, so plans grouped, windowed or joined by
    series can use the bucketing instead of a shuffle (Spark only scans by
    bucket when that removes an exchange; otherwise it splits files as usual).
    """
    b = stage(spark, sf_dir)
    if not b.n_buckets:
        return read_fact(spark, b.fact, columns=columns, states=states, categories=categories)
    return scope_fact(spark.table(fact_table(spark, b)), columns, states, categories)


def series_per_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input series per store (expected rows of F39 = series x days), counted at build time."""
    b = stage(spark, sf_dir)
    return spark.read.parquet(f"{b.base}/processed/series_per_store")
