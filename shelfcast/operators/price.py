"""Price response: F7 price_decile_demand, F8 item_price_points, F9 price_change_lift.

Windows partition by series (item_id, store_id); a series has at most one row
per calendar day, so no window partition grows with the data volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_money_rounded, avg_rounded, price_move, round_ratio
from ..schemas import SERIES_KEY


def price_decile_demand(fact: DataFrame, state: str = "CA") -> DataFrame:
    """NTILE(10) of each series' own prices (day_num breaks ties), then demand per decile."""
    priced = fact.where((F.col("state_id") == state) & F.col("sell_price").isNotNull())
    w = Window.partitionBy(*SERIES_KEY).orderBy("sell_price", "day_num")
    deciles = priced.select("sell_price", "units_sold", F.ntile(10).over(w).alias("price_decile"))
    return deciles.groupBy("price_decile").agg(
        avg_money_rounded("sell_price", 2).alias("avg_price_in_decile"),
        avg_rounded("units_sold", 3).alias("avg_daily_units"),
        F.count(F.lit(1)).alias("observations"),
    ).orderBy("price_decile")


def item_price_points(fact: DataFrame, item_id: str, store_id: str) -> DataFrame:
    """F8: one series' distinct prices with days, avg units, first and last date."""
    one = fact.where((F.col("item_id") == item_id) & (F.col("store_id") == store_id) & F.col("sell_price").isNotNull())
    return one.groupBy("sell_price").agg(
        F.count(F.lit(1)).alias("days_at_this_price"),
        avg_rounded("units_sold", 2).alias("avg_daily_units"),
        F.min("date").alias("first_seen"),
        F.max("date").alias("last_seen"),
    ).orderBy("sell_price")


def weekly_prices(fact: DataFrame, state: str = "CA") -> DataFrame:
    """Weekly max price and units per series for priced rows (partial aggregation map-side)."""
    return fact.where((F.col("state_id") == state) & F.col("sell_price").isNotNull()).groupBy(
        *SERIES_KEY, "wm_yr_wk"
    ).agg(F.max("sell_price").alias("price"), F.sum("units_sold").cast("long").alias("weekly_units"))


def price_change_lift(fact: DataFrame, state: str = "CA") -> DataFrame:
    """bucket week-over-week price moves (previous *observed* week) and compare units.

    Both LAGs share one window (one sort per series partition).
    """
    w = Window.partitionBy(*SERIES_KEY).orderBy("wm_yr_wk")
    changes = weekly_prices(fact, state).select(
        "price", "weekly_units",
        F.lag("price", 1).over(w).alias("prev_price"),
        F.lag("weekly_units", 1).over(w).alias("prev_units"),
    ).where(F.col("prev_price").isNotNull())
    return changes.groupBy(price_move(F.col("price"), F.col("prev_price")).alias("price_move")).agg(
        F.count(F.lit(1)).alias("week_count"),
        avg_rounded("weekly_units", 2).alias("avg_units_that_week"),
        avg_rounded("prev_units", 2).alias("avg_units_prior_week"),
        round_ratio(F.sum("weekly_units") - F.sum("prev_units"), F.count(F.lit(1)), 2).alias("unit_lift"),
    ).orderBy("price_move")
