"""Scores over the predictions table: F26-F28, F37, F38, F40."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import safe_div


def _err():
    return F.col("actual_units") - F.col("forecast_units")


def _r(c, digits: int = 4):
    return F.round(c, digits)


def model_scorecard(pred: DataFrame) -> DataFrame:
    """predictions, RMSE, MAE, bias (forecast - actual) and total ratio per model."""
    return pred.groupBy("model_name").agg(
        F.count(F.lit(1)).alias("predictions"),
        _r(F.sqrt(F.avg(F.pow(_err(), 2)))).alias("rmse"),
        _r(F.avg(F.abs(_err()))).alias("mae"),
        _r(F.avg(F.col("forecast_units") - F.col("actual_units"))).alias("bias"),
        _r(safe_div(F.sum("forecast_units"), F.sum("actual_units"))).alias("total_ratio"),
    ).orderBy("rmse", "model_name")


def forecast_daily(pred: DataFrame) -> DataFrame:
    """actual vs forecast per date, store, category and model."""
    return pred.groupBy("date", "store_id", "cat_id", "model_name").agg(
        _r(F.sum("actual_units")).alias("actual_units"),
        _r(F.sum("forecast_units")).alias("forecast_units"),
        _r(F.sum("forecast_units") - F.sum("actual_units")).alias("error"),
    ).orderBy("date", "store_id", "cat_id", "model_name")


def forecast_worst(pred: DataFrame) -> DataFrame:
    """RMSE and mean actual per category and model."""
    return pred.groupBy("cat_id", "model_name").agg(
        _r(F.sqrt(F.avg(F.pow(_err(), 2)))).alias("rmse"),
        _r(F.avg("actual_units"), 3).alias("avg_actual"),
    ).orderBy("cat_id", "rmse", "model_name")


def forecast_daily_by_model(pred: DataFrame, models: Sequence[str]) -> DataFrame:
    """per date, the actual total and one forecast total column per model (explicit pivot)."""
    first = models[0]
    return pred.groupBy("date").agg(
        _r(F.sum(F.when(F.col("model_name") == first, F.col("actual_units")))).alias("actual_units"),
        *[_r(F.sum(F.when(F.col("model_name") == m, F.col("forecast_units")))).alias(m) for m in models],
    ).orderBy("date")


def best_model(scorecard: DataFrame) -> DataFrame:
    """the model with the lowest RMSE (name breaks ties)."""
    return scorecard.orderBy("rmse", "model_name").limit(1).select("model_name", "rmse")


def reorder_outlook(pred: DataFrame) -> DataFrame:
    """forecast total over the horizon per store, item and model (what a stock planner compares)."""
    return pred.groupBy("store_id", "item_id", "model_name").agg(
        F.count(F.lit(1)).alias("horizon_days"),
        _r(F.sum("forecast_units")).alias("forecast_total_units"),
        _r(F.sum("actual_units")).alias("actual_total_units"),
    )
