"""Query registry: name -> callable(spark, sf_dir) -> DataFrame.

Every query reads the published ``sales_long`` fact (or tables Spark derived
from it: curated rollups, predictions), which the fact job builds once per
input directory from ``lineitem`` + ``part``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas
from ..functions import labels, numeric
from ..operators import checks, curate, effects, enrich, forecast, price, quality, scoring, volume
from ..operators.reshape import melt_units
from ..schemas import FACT_SCHEMA, PREDICTIONS_SCHEMA
from ..sources import catalog, versions, writers
from ..sources.readers import read_fact, read_predictions, read_sales_lines
from ..sources.storage import path_exists
from ..sources.versions import Versioned
from ..sources.writers import write_fact, write_predictions, write_small_csv
from . import fact_job, rerun

Query = Callable[[SparkSession, str], DataFrame]

# ---- fixed values: literals of the reference statements, re-aimed at the fixture ----
PRICE_STATE = "CA"            # state of the price / lifecycle analyses
DEEP_DIVE_ITEM = "FOODS_1_003"  # single-series price deep dive
DEEP_DIVE_STORE = "CA_3"
EVENT_CATEGORY = "FOODS"      # category of the benefit-day-by-weekday and named-event analyses
OUTLIER_THRESHOLD = 60        # units per item-day (200 on the original data; fixture max is ~150)
ROUNDTRIP_STATES = ["CA"]     # scope written and read back by the round-trip query
ROUNDTRIP_CATEGORIES = ["FOODS"]
NOTEBOOK_SCOPE = {"states": ["CA"], "categories": ["FOODS"]}  # the reference notebook's modelling scope
NOTEBOOK_COLUMNS = ["item_id", "store_id", "state_id", "cat_id", "dept_id", "date", "day_num", "wday", "weekday",
                    "month", "year", "units_sold", "sell_price", "snap_flag", "has_event"]
# --------------------------------------------------------------------------------------


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fact_job.sales_long(spark, sf_dir)


def _on_fact(fn) -> Query:
    return lambda spark, sf_dir: fn(fact(spark, sf_dir))


# ---------------------------------------------------------------- fact build covering keys

def melt_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw wide sales file read by its header and melted."""
    b = fact_job.stage(spark, sf_dir)
    return melt_units(*read_sales_lines(spark, b.sales_wide)).select(
        "id", "item_id", "dept_id", "cat_id", "store_id", "state_id", "d", "day_num", "units_sold")


def fact_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The transform plan from the three raw files (not the staged copy)."""
    b = fact_job.stage(spark, sf_dir)
    df, _, _ = fact_job.transform(spark, b.sales_wide, b.calendar, b.prices)
    return df


def fact_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A state-scoped transform written with dynamic partition overwrite, read back scoped.

    The scoped output is partitioned by state *and* store, so a store- or
    state-scoped rerun replaces only its own directories.
    """
    b = fact_job.stage(spark, sf_dir)
    path = f"{b.base}/processed/sales_long_scoped"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        df, _, _ = fact_job.transform(spark, b.sales_wide, b.calendar, b.prices, states=ROUNDTRIP_STATES)
        write_fact(df, path, dynamic=True, partition_cols=("state_id", "store_id"))
    back = spark.read.schema(_partitions_last(FACT_SCHEMA, ["state_id", "store_id"])).parquet(path)
    return back.where(F.col("state_id").isin(ROUNDTRIP_STATES) & F.col("cat_id").isin(ROUNDTRIP_CATEGORIES)).select(
        *NOTEBOOK_COLUMNS)


def _partitions_last(schema: T.StructType, partition_cols: list[str]) -> T.StructType:
    """The fact schema with the given partition columns moved to the end (directory order)."""
    return T.StructType([f for f in schema.fields if f.name not in partition_cols]
                        + [schema[c] for c in partition_cols])


def catalog_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Register the fact as an external partitioned table and list its partitions."""
    b = fact_job.stage(spark, sf_dir)
    catalog.ensure_external(spark, "sales_long", b.fact, FACT_SCHEMA, ["state_id"])
    return catalog.show_partitions(spark, "sales_long")


# ---------------------------------------------------------------- checks

def fact_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fact_job.stage(spark, sf_dir)
    return checks.fact_checks(fact(spark, sf_dir), b.n_series, b.n_days)


def checks_by_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fact_job.stage(spark, sf_dir)
    return checks.checks_by_store(fact(spark, sf_dir), fact_job.series_per_store(spark, sf_dir), b.n_days)


def quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = fact_job.stage(spark, sf_dir)
    return checks.quality_summary(fact(spark, sf_dir), b.n_series * b.n_days, b.n_series)


# ---------------------------------------------------------------- curated tables

DERIVED_MODULES = (curate, forecast, scoring, checks, enrich, labels, numeric, schemas, writers, rerun, versions)


def _versioned(b, name: str) -> str:
    """Output folder of a derived table, keyed by the source of every module its result may depend on."""
    import hashlib
    import inspect

    h = hashlib.sha1("".join(inspect.getsource(m) for m in DERIVED_MODULES).encode()).hexdigest()[:10]
    return b.curated(f"{name}-{h}")


def published(spark: SparkSession, key: str, write: Callable[[str], None]) -> str:
    """Folder of a derived output, written once: into a folder of its own, then ``<key>/current`` points at it.

    Two processes that write at once each finish a complete output and one of
    them is pointed at; nobody overwrites files that others read.
    """
    pointer = f"{key}/current"
    if not path_exists(spark, f"{pointer}/_SUCCESS"):
        out = f"{key}/{uuid.uuid4().hex[:12]}"
        write(out)
        spark.createDataFrame([(out,)], "path string").coalesce(1).write.mode("overwrite").json(pointer)
    return spark.read.schema("path string").json(pointer).first()[0]


def data_quality_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five quality rows as a curated table (CTAS)."""
    b = fact_job.stage(spark, sf_dir)
    df = checks.quality_summary(fact(spark, sf_dir), b.n_series * b.n_days, b.n_series).select("check_name", "metric_value", "expected_value")
    path = published(spark, _versioned(b, "data_quality_summary"), lambda out: catalog.ctas(spark, df, "data_quality_summary", out))
    return spark.read.schema(df.schema).parquet(path)


def raw_files_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1-A7 over a user's raw files: the job run on files with columns in another order, extra columns and
    week keys that jump at a new year; the published fact per store and month."""
    b = fact_job.stage(spark, sf_dir)

    def write(out: str) -> None:
        cal = spark.read.option("header", True).csv(b.calendar)
        keys = cal.groupBy("wm_yr_wk").agg(F.min("date").alias("date")).select(F.col("wm_yr_wk").alias("old"), (F.year("date") * 10000 + F.col("wm_yr_wk").cast("int")).alias("new"))
        shuffled = ["weekday", "wm_yr_wk", "date", "snap_TX", "extra", *[c for c in cal.columns if c not in ("weekday", "wm_yr_wk", "date", "snap_TX")]]
        numbered = cal.join(F.broadcast(keys), cal["wm_yr_wk"] == keys["old"]).drop("old", "wm_yr_wk").withColumnRenamed("new", "wm_yr_wk")
        numbered.withColumn("extra", F.lit("x")).select(*shuffled).coalesce(1).write.option("header", True).csv(f"{out}/in/calendar")
        prices = spark.read.option("header", True).csv(b.prices)
        (prices.join(F.broadcast(keys), prices["wm_yr_wk"] == keys["old"])
         .select("sell_price", F.lit("y").alias("note"), F.col("new").alias("wm_yr_wk"), "item_id", "store_id").write.option("header", True).csv(f"{out}/in/sell_prices"))
        fact_job.run_job(spark, b.sales_wide, f"{out}/in/calendar", f"{out}/in/sell_prices", f"{out}/job")

    out = published(spark, _versioned(b, "raw_files_job"), write)
    f = read_fact(spark, f"{out}/job/processed/sales_long")
    return f.groupBy("store_id", "year", "month").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("units_sold").cast("long").alias("total_units"),
        numeric.money_rounded(numeric.money_sum("revenue"), 2).alias("total_revenue"),
        F.count("sell_price").alias("priced_rows"), F.countDistinct("wm_yr_wk").alias("weeks"))


def _curated(spark: SparkSession, sf_dir: str, name: str, build, partition_cols=()) -> DataFrame:
    """CTAS into the catalog (A10/A11); the result is read back by path with the table's schema."""
    b = fact_job.stage(spark, sf_dir)
    df = build(fact(spark, sf_dir))
    path = _versioned(b, name)
    path = published(spark, path, lambda out: catalog.ctas(spark, df, name, out, partition_cols))
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


def daily_sales_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    # the published fact is checked unique on (item, store, day)
    return _curated(spark, sf_dir, "daily_sales_agg", lambda f: curate.daily_sales_agg(f, pk_unique=True), ["state_id"])


def weekly_item_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _curated(spark, sf_dir, "weekly_item_agg", curate.weekly_item_agg)


def curated_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return curate.curated_row_count(daily_sales_agg(spark, sf_dir))


# ---------------------------------------------------------------- forecasting

def _cutoff(spark: SparkSession, sf_dir: str):
    """First holdout date from the build metadata: every series of the published fact spans
    the whole calendar (checked before publishing), so its last date is the calendar's —
    no scan of the fact is needed."""
    import datetime as dt

    b = fact_job.stage(spark, sf_dir)
    return b.first_day + dt.timedelta(days=b.n_days - forecast.HORIZON)


def holdout_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = fact(spark, sf_dir)
    cutoff = _cutoff(spark, sf_dir)
    forecast.check_holdout(forecast.split(f, cutoff)[1])
    return forecast.holdout_summary(f, cutoff)


def lag_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M5 on the published fact, which is checked dense (row offsets = days, like the reference's shift)."""
    f = fact(spark, sf_dir).select("item_id", "store_id", "date", "day_num", "units_sold")
    return forecast.lag_features(f, dense=True)


# ---------------------------------------------------------------- versioned partitions

RESTATED_STATES, RESTATED_STORES = ["CA"], ["TX_2"]  # scopes of the two reruns


def _restated_sales(spark: SparkSession, b, out: str) -> None:
    """Stand-in for a corrected raw file: one unit more on every day of the rerun's stores (and of nobody else)."""
    lines, days = read_sales_lines(spark, b.sales_wide)
    hit = F.col("state_id").isin(RESTATED_STATES) | F.col("store_id").isin(RESTATED_STORES)
    units = F.when(hit, F.transform("units", lambda x: (x.cast("int") + 1).cast("string"))).otherwise(F.col("units"))
    header = ",".join([*schemas.ID_COLS, *days])
    lines.select(F.concat_ws(",", *schemas.ID_COLS, units).alias(header)).write.option("header", True).option("sep", "\t").csv(out)


def _rerun_fact(spark: SparkSession, sf_dir: str):
    """The published fact as a versioned table after a state's and a store's rerun from the corrected raw file (made once)."""
    b = fact_job.stage(spark, sf_dir)

    def write(out: str) -> None:
        _restated_sales(spark, b, f"{out}/in/sales_wide")
        table = rerun.versioned_fact(spark, b, f"{out}/table")
        for scope in ({"states": RESTATED_STATES}, {"stores": RESTATED_STORES}):
            rerun.rerun(spark, table, b, f"{out}/in/sales_wide", b.calendar, b.prices, **scope)

    return rerun.versioned_fact(spark, b, published(spark, _versioned(b, "fact_rerun"), write) + "/table")


def fact_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published fact per store after the reruns, with the version that its partition is of (1: untouched)."""
    table = _rerun_fact(spark, sf_dir)
    f = table.read(spark).groupBy("state_id", "store_id").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("units_sold").cast("long").alias("total_units"),
        numeric.money_rounded(numeric.money_sum("revenue"), 2).alias("total_revenue"))
    return f.join(F.broadcast(rerun.by_version(spark, table)), "state_id").select("state_id", "store_id", F.col("since").alias("version"), "n_rows", "total_units", "total_revenue")


def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact's partitions in the catalog, in storage, and as the input series name them."""
    b = fact_job.stage(spark, sf_dir)
    catalog.ensure_external(spark, "sales_long", b.fact, FACT_SCHEMA, ["state_id"])
    lines, _ = read_sales_lines(spark, b.sales_wide)
    expected = [r[0] for r in lines.select("state_id").distinct().collect()]  # a row a state
    return catalog.partition_inventory(spark, "sales_long", "state_id", expected, [b.fact])


def _baseline(model: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = fact(spark, sf_dir)
        cutoff = _cutoff(spark, sf_dir)
        train, test = forecast.split(f, cutoff)
        if model == "naive_last_value":
            return forecast.naive_last_value(train, test)
        if model == "seasonal_naive_28d":
            return forecast.seasonal_naive(f, test, cutoff)
        return forecast.weekday_mean(train, test)
    return run


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Baseline predictions written once (partitioned by model) and read as an external table."""
    b = fact_job.stage(spark, sf_dir)

    def write(out: str) -> None:
        f = fact(spark, sf_dir)
        cutoff = _cutoff(spark, sf_dir)
        forecast.check_holdout(forecast.split(f, cutoff)[1])
        write_predictions(forecast.baseline_predictions(f, cutoff=cutoff), out)

    path = published(spark, _versioned(b, "forecast_vs_actual"), write)
    catalog.ensure_external(spark, "forecast_vs_actual", path, PREDICTIONS_SCHEMA, ["model_name"])
    return read_predictions(spark, path)


def gradient_boosting(spark: SparkSession, sf_dir: str, max_iter: int = 300) -> DataFrame:
    """M6: boosted-tree predictions on the modelling scope, written once per build (training is the expensive part)."""
    return read_predictions(spark, _scoped_boosting(spark, sf_dir, max_iter, **NOTEBOOK_SCOPE))


def gradient_boosting_curve(spark: SparkSession, sf_dir: str, max_iter: int = 300) -> DataFrame:
    """M6: held-out error of every tree prefix, and the one that was kept."""
    return spark.read.schema(forecast.CURVE).parquet(f"{_scoped_boosting(spark, sf_dir, max_iter, **NOTEBOOK_SCOPE)}_curve")


def _scoped_boosting(spark: SparkSession, sf_dir: str, max_iter: int, states=None, categories=None) -> str:
    """Folder of the predictions of a model trained and applied on one scope (the reference models FOODS in CA)."""
    b = fact_job.stage(spark, sf_dir)
    scope = "_".join([*(states or ["all"]), *(categories or ["all"])])
    path = _versioned(b, f"gbt_predictions_{max_iter}_{scope}")

    def write(out: str) -> None:
        f = fact_job.sales_long(spark, sf_dir, columns=NOTEBOOK_COLUMNS, states=states, categories=categories)
        made, curve = forecast.boosting(f, _cutoff(spark, sf_dir), max_iter=max_iter, dense=True, frame_path=f"{out}_frame")
        curve.coalesce(1).write.parquet(f"{out}_curve")
        write_predictions(made, out)

    return published(spark, path, write)


def gradient_boosting_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is determined of M6: one row per test row of the scope, its actual units, and that no forecast is negative."""
    p = gradient_boosting(spark, sf_dir)
    return p.select("date", "store_id", "cat_id", "item_id", "actual_units", "model_name", (F.col("forecast_units") >= 0).alias("not_negative"))


def model_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D8 + C13 on the modelling scope: training rows with both lags, test rows with missing lag features as 0."""
    f = fact_job.sales_long(spark, sf_dir, columns=NOTEBOOK_COLUMNS, **NOTEBOOK_SCOPE)
    train, test = forecast.model_frames(f.select("item_id", "store_id", "date", "day_num", "units_sold"), _cutoff(spark, sf_dir), dense=True)
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


def notebook_scorecard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F26 for the three baselines on the notebook's scope (FOODS in CA), read with partition + column pruning."""
    f = fact_job.sales_long(spark, sf_dir, columns=NOTEBOOK_COLUMNS, **NOTEBOOK_SCOPE)
    return scoring.model_scorecard(forecast.baseline_predictions(f, cutoff=_cutoff(spark, sf_dir)))


def _on_predictions(fn) -> Query:
    return lambda spark, sf_dir: fn(predictions(spark, sf_dir))


def _forecast_table(spark: SparkSession, sf_dir: str) -> Versioned:
    """``forecast_vs_actual`` of all four models on the modelling scope: a partition per model, each published on its own."""
    b = fact_job.stage(spark, sf_dir)

    def write(out: str) -> None:
        f = fact_job.sales_long(spark, sf_dir, columns=NOTEBOOK_COLUMNS, **NOTEBOOK_SCOPE)
        cutoff = _cutoff(spark, sf_dir)
        test = forecast.split(f, cutoff)[1]
        forecast.check_holdout(test)
        table, expected = forecast_versions(out), test.count()
        publish_models(spark, table, forecast.baseline_predictions(f, cutoff=cutoff), forecast.BASELINES, expected)
        publish_models(spark, table, gradient_boosting(spark, sf_dir), [forecast.MODEL_NAMES[3]], expected)

    return forecast_versions(published(spark, _versioned(b, "forecast_models"), write))


def forecast_versions(root: str) -> Versioned:
    return Versioned(f"{root}/table", "forecast_models", "model_name", PREDICTIONS_SCHEMA)


def publish_models(spark: SparkSession, table: Versioned, made: DataFrame, models: list[str], expected: int) -> int:
    """The models' predictions as new versions of their partitions; other models' files stay as they are.

    Raises (and publishes nothing) unless each model has ``expected`` rows, all with a forecast that isn't negative.
    """
    out, base = table.new_folder(), table.version(spark)
    write_predictions(made.where(F.col("model_name").isin(models)), out)
    good = F.sum(F.when(F.col("forecast_units") >= 0, 1).otherwise(0))
    found = {r[0]: (r[1], r[2]) for r in read_predictions(spark, out).groupBy("model_name").agg(F.count(F.lit(1)), good).collect()}
    wrong = [m for m in models if found.get(m) != (expected, expected)]
    if wrong:
        raise enrich.ValidationError(f"predictions of {wrong}: {[found.get(m) for m in wrong]} rows and good rows instead of {expected}")
    return table.publish(spark, {m: f"{out}/model_name={m}" for m in models}, base=base)


def all_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four models' predictions on the modelling scope, through the external table."""
    return _forecast_table(spark, sf_dir).read(spark)


def _on_all_models(fn) -> Query:
    return lambda spark, sf_dir: fn(all_predictions(spark, sf_dir))


def forecast_models_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is determined of the four models' table: every key and actual, the baselines' forecasts, no negative forecast."""
    p = all_predictions(spark, sf_dir)
    given = F.when(F.col("model_name").isin(forecast.BASELINES), F.col("forecast_units"))
    return p.select("date", "store_id", "cat_id", "item_id", "actual_units", "model_name", given.alias("baseline_units"), (F.col("forecast_units") >= 0).alias("not_negative"))


def model_scorecard_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F26 over all four models on the modelling scope, from its one-file CSV next to the predictions."""
    b = fact_job.stage(spark, sf_dir)
    card = scoring.model_scorecard(all_predictions(spark, sf_dir))
    path = published(spark, _versioned(b, "model_scorecard_csv"), lambda out: write_small_csv(card, out))
    return spark.read.schema(card.schema).option("header", True).csv(path)


def _on_scope(fn) -> Query:
    """The exploratory queries on the modelling scope, as the reference runs them."""
    return lambda spark, sf_dir: fn(fact_job.sales_long(spark, sf_dir, **NOTEBOOK_SCOPE))


SCOPED = {"scope_profile": checks.scope_profile, "daily_total_ma28": effects.daily_total_ma28,
          "weekday_mean_units": effects.weekday_mean_units, "units_histogram_capped": effects.units_histogram_capped,
          "zero_share": checks.zero_share, "snap_overall_lift": effects.snap_overall_lift}


def registry() -> dict[str, Query]:
    return {
        # F31-F36 on the modelling scope
        **{f"{name}_scoped": _on_scope(fn) for name, fn in SCOPED.items()},
        # F — checks on the fact
        "rows_by_state": _on_fact(checks.rows_by_state),
        "grand_total_check": _on_fact(checks.grand_total_check),
        "pk_duplicates": _on_fact(checks.pk_duplicates),
        # F — analysis
        "sales_by_category_store": _on_fact(volume.sales_by_category_store),
        "category_share": _on_fact(volume.category_share),
        "top_items": _on_fact(volume.top_items),
        "price_decile_demand": _on_fact(lambda f: price.price_decile_demand(f, PRICE_STATE)),
        "item_price_points": _on_fact(lambda f: price.item_price_points(f, DEEP_DIVE_ITEM, DEEP_DIVE_STORE)),
        "price_change_lift": _on_fact(lambda f: price.price_change_lift(f, PRICE_STATE)),
        "snap_averages": _on_fact(effects.snap_averages),
        "snap_lift": _on_fact(effects.snap_lift),
        "snap_by_weekday": _on_fact(lambda f: effects.snap_by_weekday(f, EVENT_CATEGORY)),
        "event_day_by_category": _on_fact(effects.event_day_by_category),
        "event_type_effect": _on_fact(effects.event_type_effect),
        "named_event_effect": _on_fact(lambda f: effects.named_event_effect(f, EVENT_CATEGORY)),
        "weekday_seasonality": _on_fact(effects.weekday_seasonality),
        "intermittency": _on_fact(quality.intermittency),
        "null_price_by_year": _on_fact(quality.null_price_by_year),
        "item_lifecycle": _on_fact(lambda f: quality.item_lifecycle(f, PRICE_STATE)),
        "outlier_scan": _on_fact(lambda f: quality.outlier_scan(f, OUTLIER_THRESHOLD)),
        "calendar_coverage": _on_fact(checks.calendar_coverage),
        "series_coverage": _on_fact(checks.series_coverage),
        "quality_summary": quality_summary,
        # curated
        "daily_sales_agg": daily_sales_agg,
        "curated_row_count": curated_row_count,
        "weekly_item_agg": weekly_item_agg,
        # scores
        "model_scorecard": _on_predictions(scoring.model_scorecard),
        "forecast_daily": _on_predictions(scoring.forecast_daily),
        "forecast_worst": _on_predictions(scoring.forecast_worst),
        # transform checks
        "fact_checks": fact_checks,
        "null_quality_row": _on_fact(checks.null_quality_row),
        "scope_profile": _on_fact(checks.scope_profile),
        "daily_total_ma28": _on_fact(effects.daily_total_ma28),
        "weekday_mean_units": _on_fact(effects.weekday_mean_units),
        "units_histogram_capped": _on_fact(effects.units_histogram_capped),
        "zero_share": _on_fact(checks.zero_share),
        "fact_preview": _on_fact(checks.fact_preview),
        "snap_overall_lift": _on_fact(effects.snap_overall_lift),
        "forecast_daily_by_model": _on_predictions(lambda p: scoring.forecast_daily_by_model(p, forecast.BASELINES)),
        "best_model": _on_predictions(lambda p: scoring.best_model(scoring.model_scorecard(p))),
        "checks_by_store": checks_by_store,
        "reorder_outlook": _on_predictions(scoring.reorder_outlook),
        # operator-covering keys
        "melt_long": melt_long,
        "fact_enriched": fact_enriched,
        "fact_roundtrip": fact_roundtrip,
        "catalog_partitions": catalog_partitions,
        "holdout_split": holdout_split,
        "lag_features": lag_features,
        "naive_last_value": _baseline("naive_last_value"),
        "seasonal_naive_28d": _baseline("seasonal_naive_28d"),
        "weekday_mean": _baseline("weekday_mean"),
        "predictions": predictions,
        "notebook_scorecard": notebook_scorecard,
        "gradient_boosting": gradient_boosting,
        "model_scorecard_all": model_scorecard_all,
        "gradient_boosting_rows": gradient_boosting_rows,
        "gradient_boosting_curve": gradient_boosting_curve,
        # all four models on the modelling scope
        "forecast_models": all_predictions,
        "forecast_models_rows": forecast_models_rows,
        "forecast_daily_all": _on_all_models(scoring.forecast_daily),
        "forecast_worst_all": _on_all_models(scoring.forecast_worst),
        "forecast_daily_by_model_all": _on_all_models(lambda p: scoring.forecast_daily_by_model(p, forecast.MODEL_NAMES)),
        "best_model_all": _on_all_models(lambda p: scoring.best_model(scoring.model_scorecard(p))),
        "reorder_outlook_all": _on_all_models(scoring.reorder_outlook),
        "fact_rerun": fact_rerun,
        "partition_inventory": partition_inventory,
        "model_frames": model_frames,
        "raw_files_job": raw_files_job,
        "data_quality_summary": data_quality_summary,
    }

