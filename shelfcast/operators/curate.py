"""Curated serving tables: F23 daily_sales_agg, F24 curated_row_count, F25 weekly_item_agg."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import avg_money_rounded, event_label, money_rounded, money_sum
from ..functions.labels import NO_EVENT_CURATED

DAILY_KEYS = ["date", "year", "month", "wday", "weekday", "store_id", "cat_id", "dept_id", "snap_flag", "has_event"]


def daily_sales_agg(fact: DataFrame, pk_unique: bool = False) -> DataFrame:
    """day x store x department rollup for dashboards; partition key ``state_id`` last.

    ``items_active`` is COUNT(DISTINCT item_id), right for any input.  The groups
    fix date and store, so on a fact that is unique on (item_id, store_id, d) it
    equals COUNT(item_id), which aggregates map-side instead of shuffling every
    fact row on the 12 keys + item_id.  ``pk_unique=True`` is the caller's
    assertion of that uniqueness; only the published fact, whose job checks it,
    should make it.
    """
    items = F.count("item_id") if pk_unique else F.countDistinct("item_id")
    return fact.groupBy(*DAILY_KEYS, event_label("event_name_1", NO_EVENT_CURATED).alias("event_name"), "state_id").agg(
        F.sum("units_sold").cast("long").alias("total_units"),
        money_rounded(money_sum("revenue"), 2).alias("total_revenue"),
        avg_money_rounded("sell_price", 2).alias("avg_price"),
        items.alias("items_active"),
        F.sum(F.when(F.col("units_sold") > 0, 1).otherwise(0)).cast("long").alias("items_with_sales"),
    ).select(*DAILY_KEYS, "event_name", "total_units", "total_revenue", "avg_price", "items_active",
             "items_with_sales", "state_id")


def curated_row_count(daily: DataFrame) -> DataFrame:
    """rows of the curated daily table."""
    return daily.agg(F.count(F.lit(1)).alias("agg_rows"))


def weekly_item_agg(fact: DataFrame) -> DataFrame:
    """item x store x week rollup (weekly grain for modelling)."""
    return fact.groupBy("item_id", "store_id", "state_id", "cat_id", "wm_yr_wk").agg(
        F.min("date").alias("week_start"),
        F.sum("units_sold").cast("long").alias("weekly_units"),
        F.max("sell_price").alias("sell_price"),
        F.sum("snap_flag").cast("long").alias("snap_days_in_week"),
        F.sum("has_event").cast("long").alias("event_days_in_week"),
    )
