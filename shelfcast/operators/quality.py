"""Data characteristics: F17 intermittency, F18 null_price_by_year, F19 item_lifecycle, F20 outlier_scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import avg_rounded, event_label, lifecycle_bucket, pct_rounded, round_ratio
from ..functions.labels import NO_EVENT_OUTLIER
from ..schemas import SERIES_KEY


def _count_if(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def intermittency(fact: DataFrame) -> DataFrame:
    """zero-sale item-days per category."""
    zero = _count_if(F.col("units_sold") == 0)
    return fact.groupBy("cat_id").agg(
        F.count(F.lit(1)).alias("item_days"),
        zero.alias("zero_days"),
        pct_rounded(zero, F.count(F.lit(1)), 1).alias("pct_zero_days"),
        avg_rounded("units_sold", 3).alias("avg_units"),
        F.max("units_sold").alias("max_units"),
    ).orderBy(F.desc("pct_zero_days"), "cat_id")


def null_price_by_year(fact: DataFrame) -> DataFrame:
    """rows without a price per year (expected early in an item's life)."""
    nulls = _count_if(F.col("sell_price").isNull())
    return fact.groupBy("year").agg(
        F.count(F.lit(1)).alias("rows_in_year"),
        nulls.alias("null_price_rows"),
        pct_rounded(nulls, F.count(F.lit(1)), 1).alias("pct_null_price"),
    ).orderBy("year")


def item_lifecycle(fact: DataFrame, state: str = "CA") -> DataFrame:
    """series by the day of their first sale, with the average first priced day."""
    first = fact.where(F.col("state_id") == state).groupBy(*SERIES_KEY).agg(
        F.min(F.when(F.col("units_sold") > 0, F.col("day_num"))).alias("first_sale_day"),
        F.min(F.when(F.col("sell_price").isNotNull(), F.col("day_num"))).alias("first_price_day"),
    )
    return first.groupBy(lifecycle_bucket(F.col("first_sale_day")).alias("lifecycle_bucket")).agg(
        F.count(F.lit(1)).alias("item_store_series"),
        round_ratio(F.sum("first_price_day"), F.count("first_price_day"), 0).alias("avg_first_price_day"),
    ).orderBy(F.desc("item_store_series"), "lifecycle_bucket")


def outlier_scan(fact: DataFrame, threshold: int = 200, k: int = 25) -> DataFrame:
    """the k largest single-day sales above ``threshold`` (filter pushed to Parquet, TakeOrdered)."""
    return fact.where(F.col("units_sold") > threshold).select(
        "item_id", "store_id", "date", "units_sold", "sell_price",
        event_label("event_name_1", NO_EVENT_OUTLIER).alias("event"),
    ).orderBy(F.desc("units_sold"), "item_id", "store_id", "date").limit(k)
