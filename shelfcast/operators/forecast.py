"""Backtest of 28-day forecasts: M1 split, M2-M4 baselines, M5 lag features, M6 boosting, M7 predictions.

Baselines are lookups built from map-side partial aggregates over the training
rows (one small row per series: a value, or at most 7 / 28 entries),
joined to the test rows on the series key alone — the bucketed fact co-locates
both sides, and the whole fact is never sorted for them.  Lag features
need every training row, so they are one window pass partitioned by series
(at most one row per day per series) with date-based RANGE frames, which stay
correct on sparse series where row-based shifts would not.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import clip_lower, safe_div
from ..schemas import SERIES_KEY
from ..session import parallelism
from .enrich import ValidationError

# fixed values: horizon, model and feature names of the reference
HORIZON = 28
MODEL_NAMES = ["naive_last_value", "seasonal_naive_28d", "weekday_mean", "gradient_boosting"]
BASELINES = MODEL_NAMES[:3]
LAG_FEATURES = ["lag_28", "lag_35", "roll_28"]
FEATURES = ["wday", "month", "snap_flag", "has_event", "sell_price"] + LAG_FEATURES


# ---------------------------------------------------------------- M1 split

def holdout_cutoff(fact: DataFrame, horizon: int = HORIZON) -> dt.date:
    """First holdout date = last date - (horizon - 1); one aggregate row to the driver."""
    last = fact.agg(F.max("date").alias("m")).first()["m"]
    if last is None:
        raise ValidationError("empty fact: no holdout")
    return last - dt.timedelta(days=horizon - 1)


def split(fact: DataFrame, cutoff: dt.date) -> tuple[DataFrame, DataFrame]:
    """Train ``date < cutoff``, test ``date >= cutoff`` (same cutoff for every series)."""
    c = F.lit(cutoff)
    return fact.where(F.col("date") < c), fact.where(F.col("date") >= c)


def check_holdout(test: DataFrame, horizon: int = HORIZON) -> None:
    """The holdout must hold exactly ``horizon`` distinct dates."""
    n = test.select("date").distinct().count()
    if n != horizon:
        raise ValidationError(f"holdout has {n} dates, expected {horizon}")


def holdout_summary(fact: DataFrame, cutoff: dt.date) -> DataFrame:
    """M1 as a table: rows, dates and date range per side of the cutoff."""
    side = F.when(F.col("date") < F.lit(cutoff), "train").otherwise("test")
    per_date = fact.groupBy(side.alias("split"), "date").agg(F.count(F.lit(1)).alias("n"))
    return per_date.groupBy("split").agg(
        F.sum("n").alias("rows"), F.count(F.lit(1)).alias("dates"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    ).orderBy("split")


def _prediction(test: DataFrame, forecast, model: str) -> DataFrame:
    return test.select(
        "date", "store_id", "cat_id", "item_id",
        F.col("units_sold").cast("double").alias("actual_units"),
        forecast.cast("double").alias("forecast_units"),
        F.lit(model).alias("model_name"),
    )


# ---------------------------------------------------------------- M2-M4 baselines

def naive_last_value(train: DataFrame, test: DataFrame) -> DataFrame:
    """M2: each series' last observed training value (non-null), 0 when the series has none."""
    last = train.where(F.col("units_sold").isNotNull()).groupBy(*SERIES_KEY).agg(
        F.max_by("units_sold", "date").alias("last_value"))
    joined = test.join(last, SERIES_KEY, "left")
    return _prediction(joined, F.coalesce(F.col("last_value").cast("double"), F.lit(0.0)), MODEL_NAMES[0])


def seasonal_naive(fact: DataFrame, test: DataFrame, cutoff: dt.date, horizon: int = HORIZON,
                   lag_days: int = 28) -> DataFrame:
    """M3: the value ``lag_days`` calendar days earlier (date-based, sparse-safe), 0 when absent.

    Only the ``horizon`` days the test window looks back to are read (pushed-down
    date filter); they are collected per series into a ``date -> units`` map
    (at most ``horizon`` entries) and joined on the series key alone, which the
    bucketed fact co-locates (no shuffle).
    """
    lo = cutoff - dt.timedelta(days=lag_days)
    hi = cutoff + dt.timedelta(days=horizon - 1 - lag_days)
    hist = fact.where((F.col("date") >= F.lit(lo)) & (F.col("date") <= F.lit(hi))).groupBy(*SERIES_KEY).agg(
        F.map_from_entries(F.collect_list(F.struct(F.date_add("date", lag_days), F.col("units_sold")))).alias("hist"))
    joined = test.join(hist, SERIES_KEY, "left")
    value = F.try_element_at(F.col("hist"), F.col("date"))
    return _prediction(joined, F.coalesce(value.cast("double"), F.lit(0.0)), MODEL_NAMES[1])


def weekday_mean(train: DataFrame, test: DataFrame) -> DataFrame:
    """M4: training mean per series and weekday, 0 when the series has no such day.

    The (at most 7) means of a series are collected into a ``wday -> mean`` map
    and joined on the series key alone (co-located by the bucketed fact).
    """
    means = train.groupBy(*SERIES_KEY, "wday").agg(
        (F.sum("units_sold").cast("double") / F.count("units_sold").cast("double")).alias("wday_mean"))
    by_series = means.groupBy(*SERIES_KEY).agg(
        F.map_from_entries(F.collect_list(F.struct("wday", "wday_mean"))).alias("wday_means"))
    joined = test.join(by_series, SERIES_KEY, "left")
    value = F.try_element_at(F.col("wday_means"), F.col("wday"))
    return _prediction(joined, F.coalesce(value, F.lit(0.0)), MODEL_NAMES[2])


def series_history(fact: DataFrame, cutoff: dt.date, horizon: int = HORIZON, lag_days: int = 28) -> DataFrame:
    """Per series, in one aggregate over the fact: ``last_value``, ``wday_means`` (7) and ``seasonal`` (``horizon`` values).

    Only conditional sums and maxima of fixed number, so it aggregates map-side
    and, on the bucketed fact, without a shuffle.
    """
    units, train = F.col("units_sold"), F.col("date") < F.lit(cutoff)
    means = []
    for w in range(1, 8):
        mine = F.when(train & (F.col("wday") == w), units)
        means.append(safe_div(F.sum(mine), F.count(mine)))
    back = F.datediff("date", F.lit(cutoff - dt.timedelta(days=lag_days)))
    return fact.groupBy(*SERIES_KEY).agg(
        F.max_by(units, F.when(train & units.isNotNull(), F.col("date"))).alias("last_value"),
        F.array(*means).alias("wday_means"),
        F.array(*[F.max(F.when(back == k, units)) for k in range(horizon)]).alias("seasonal"))


def baseline_predictions(fact: DataFrame, horizon: int = HORIZON, cutoff: dt.date | None = None) -> DataFrame:
    """M7 for the three baselines, stacked (I3): one history aggregate, one join, three rows per test row.

    The fact is read twice (history, test rows).  Same values as M2-M4 above for a
    fact with at most one row per series and day.
    """
    cutoff = cutoff or holdout_cutoff(fact, horizon)
    _, test = split(fact, cutoff)
    joined = test.select("date", "wday", "store_id", "cat_id", "item_id", "units_sold").join(series_history(fact, cutoff, horizon), SERIES_KEY, "left")
    ahead = F.datediff("date", F.lit(cutoff))
    values = [F.col("last_value").cast("double"), F.get("seasonal", ahead).cast("double"), F.get("wday_means", F.col("wday") - 1)]
    models = F.array(*[F.struct(F.coalesce(v, F.lit(0.0)).alias("forecast_units"), F.lit(m).alias("model_name")) for v, m in zip(values, BASELINES, strict=True)])
    return joined.select("date", "store_id", "cat_id", "item_id", F.col("units_sold").cast("double").alias("actual_units"), F.inline(models))


# ---------------------------------------------------------------- M5 lag features

def lag_features(fact: DataFrame, dense: bool = False) -> DataFrame:
    """lag_28, lag_35 (value 28/35 days earlier) and roll_28 (mean of days t-55..t-28).

    One window spec (partition series, order day_num): one Window operator, one
    sort, and no shuffle on the bucketed fact.  ``roll_28`` is a difference of
    two running sums / counts (incremental frames, O(1) per row) instead of a
    28-row sliding frame that Spark re-aggregates for every row; it is NULL when
    the window is empty, like a rolling mean with ``min_periods=1`` over a
    shifted series.

    ``dense=True`` (every series has every day once — what the transform checks
    before publishing) uses row offsets, as the reference's shift does; the
    default uses RANGE frames on ``day_num`` so sparse series get the value
    exactly k days earlier.
    """
    w = Window.partitionBy(*SERIES_KEY).orderBy("day_num")
    start = Window.unboundedPreceding
    frame = w.rowsBetween if dense else w.rangeBetween
    units = F.col("units_sold")
    if dense:
        lag_28, lag_35 = F.lag(units, 28).over(w), F.lag(units, 35).over(w)
    else:
        lag_28, lag_35 = F.max(units).over(w.rangeBetween(-28, -28)), F.max(units).over(w.rangeBetween(-35, -35))
    upto_28, upto_56 = frame(start, -28), frame(start, -56)
    total = F.sum(units).over(upto_28) - F.coalesce(F.sum(units).over(upto_56), F.lit(0))
    count = F.count(units).over(upto_28) - F.count(units).over(upto_56)
    return fact.select("*", lag_28.alias("lag_28"), lag_35.alias("lag_35"), safe_div(total, count).alias("roll_28"))


def model_frames(fact: DataFrame, cutoff: dt.date, dense: bool = False) -> tuple[DataFrame, DataFrame]:
    """D8 + C13: training rows need both lags; test rows get missing lag features as 0."""
    feats = lag_features(fact, dense)
    train, test = split(feats, cutoff)
    return train.dropna(subset=["lag_28", "lag_35"]), test.fillna(0, subset=LAG_FEATURES)


# ---------------------------------------------------------------- M6 gradient boosting

PATIENCE = 10         # fixed value: trees without improvement after which boosting has ended
VALIDATION = 10       # one training row in so many validates (seeded hash of series and day)
FIRST_STAGE = 32      # trees of the first staged fit; each later one has twice as many
NO_PRICE = -1.0       # below every price, so that a split can part items that are not carried from all others


def chosen_trees(errors: Sequence[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """Trees kept for a validation curve, and whether ``patience`` trees after them brought nothing.

    The curve is read like a training run: it ends at the first tree that is ``patience`` trees past the best.
    """
    best, kept = float("inf"), 0
    for trees, error in enumerate(errors, 1):
        if error < best:
            best, kept = error, trees
        elif trees - kept >= patience:
            return kept, True
    return kept, False


def boosting(fact: DataFrame, cutoff: dt.date, max_iter: int = 300, step_size: float = 0.08, seed: int = 42, max_depth: int = 5,
             max_bins: int = 64, dense: bool = False, frame_path: str | None = None, patience: int = PATIENCE) -> tuple[DataFrame, DataFrame]:
    """M6: (predictions, validation curve) of boosted trees on calendar, price and lag features.

    Staged evaluation: one training row in ``VALIDATION`` is held out by a seeded hash; ensembles of 32, 64, ..
    up to ``max_iter`` trees are fitted on the others until the held-out error of every tree prefix (one pass)
    shows ``patience`` trees without improvement after the best prefix.  The model is then fitted on all training
    rows with that number of trees; forecasts are clipped at 0.  Boosting is sequential, so the time follows the
    trees that help instead of ``max_iter``: all stages together fit at most four times the trees looked at last.

    A NULL ``sell_price`` (item not yet carried) is the value ``NO_PRICE``: MLlib takes no NULLs, and a split below all
    prices treats them apart.  Depth/leaf settings approximate a 31-leaf histogram booster.
    The boosting state is checkpointed to the shared checkpoint folder every 25
    trees, so a lost executor replays at most 25 iterations (node-id caching is
    off: at depth 5 it doubled the per-tree cost).
    """
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    train, test = model_frames(fact, cutoff, dense)

    def prep(df: DataFrame) -> DataFrame:
        return df.select(
            "date", "store_id", "cat_id", "item_id", "units_sold",
            *[F.coalesce(F.col(c).cast("double"), F.lit(NO_PRICE if c == "sell_price" else None)).alias(c) for c in FEATURES],
        ).withColumn("label", F.col("units_sold").cast("double"))

    held = F.pmod(F.xxhash64(*SERIES_KEY, "date", F.lit(seed)), F.lit(VALIDATION)) == 0
    tr, te = prep(train).withColumn("side", F.when(held, "validation").otherwise("train")), prep(test).withColumn("side", F.lit("test"))
    if frame_path:
        both = tr.unionByName(te)
        both.write.mode("overwrite").partitionBy("side").parquet(frame_path)
        back = fact.sparkSession.read.schema(both.schema).parquet(frame_path)
        tr, te = back.where(F.col("side") != "test"), back.where(F.col("side") == "test")
    assembler = VectorAssembler(inputCols=FEATURES, outputCol="features", handleInvalid="keep")
    cores = parallelism(fact.sparkSession)
    rows = assembler.transform(tr).select("side", "label", "features")

    def fit(data: DataFrame, trees: int):
        gbt = GBTRegressor(featuresCol="features", labelCol="label", maxIter=trees, stepSize=step_size,
                           seed=seed, maxDepth=max_depth, maxBins=max_bins, minInstancesPerNode=20,
                           checkpointInterval=25, cacheNodeIds=False)
        return gbt.fit(data.repartition(cores) if frame_path else data)

    fitting, checking = (rows.where(F.col("side") == x).select("label", "features") for x in ("train", "validation"))
    trees, errors = min(FIRST_STAGE, max_iter), []
    if checking.isEmpty() or fitting.isEmpty():  # too few rows to hold any out
        kept = max_iter
    else:
        while True:
            errors = fit(fitting, trees).evaluateEachIteration(checking, "squared")
            kept, ended = chosen_trees(errors, patience)
            if ended or trees >= max_iter:
                break
            trees = min(2 * trees, max_iter)
    scored = fit(rows.select("label", "features"), kept).transform(assembler.transform(te))
    curve = fact.sparkSession.createDataFrame([(i, float(e), i == kept) for i, e in enumerate(errors, 1)], CURVE)
    return scored.select(
        "date", "store_id", "cat_id", "item_id",
        F.col("units_sold").cast("double").alias("actual_units"),
        clip_lower(F.col("prediction"), 0.0).alias("forecast_units"),
        F.lit(MODEL_NAMES[3]).alias("model_name"),
    ), curve


CURVE = "trees int, validation_mse double, kept boolean"


def gradient_boosting(fact: DataFrame, cutoff: dt.date, **options) -> DataFrame:
    """M6: the predictions of :func:`boosting`."""
    return boosting(fact, cutoff, **options)[0]
