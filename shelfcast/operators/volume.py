"""Volume and share: F4 sales_by_category_store, F5 category_share, F6 top_items."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_money_rounded, avg_rounded, money_rounded, money_sum, pct_rounded


def sales_by_category_store(fact: DataFrame) -> DataFrame:
    """units, revenue (0 dp), avg units per item-day (3 dp), items carried by state/store/category."""
    return fact.groupBy("state_id", "store_id", "cat_id").agg(
        F.sum("units_sold").cast("long").alias("total_units"),
        money_rounded(money_sum("revenue"), 0).alias("total_revenue"),
        avg_rounded("units_sold", 3).alias("avg_units_per_item_day"),
        F.countDistinct("item_id").alias("items_carried"),
    ).orderBy("state_id", "store_id", F.desc("total_units"), "cat_id")


def category_share(fact: DataFrame) -> DataFrame:
    """units and revenue share of the total (1 dp).

    The grand total is ``SUM(..) OVER ()`` on the *grouped* rows (one per
    category), so the un-partitioned window only ever sees a handful of rows.
    """
    g = fact.groupBy("cat_id").agg(
        F.sum("units_sold").cast("long").alias("total_units"),
        money_sum("revenue").alias("rev"),
    )
    everything = Window.partitionBy()
    return g.select(
        "cat_id",
        "total_units",
        pct_rounded(F.col("total_units"), F.sum("total_units").over(everything), 1).alias("pct_of_all_units"),
        pct_rounded(F.col("rev"), F.sum("rev").over(everything), 1).alias("pct_of_all_revenue"),
    ).orderBy(F.desc("total_units"), "cat_id")


def top_items(fact: DataFrame, k: int = 15) -> DataFrame:
    """the k items with most units (TakeOrdered; item_id breaks ties)."""
    return fact.groupBy("item_id", "cat_id").agg(
        F.sum("units_sold").cast("long").alias("total_units"),
        F.countDistinct("store_id").alias("stores_carrying"),
        avg_money_rounded("sell_price", 2).alias("avg_price"),
    ).orderBy(F.desc("total_units"), "item_id").limit(k)
