"""Calendar and event effects: F10-F16, F32-F34, F36.

Lifts compare two conditional averages of integer units; they are computed from
the four integer aggregates (sums and counts) so the percentage is an exact ratio.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import avg_rounded, clip_upper, event_label, round_ratio, safe_div
from ..functions.labels import NO_EVENT_TYPE


def _cond_sum(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("units_sold"))).cast("long")


def _cond_count(cond: Column) -> Column:
    return F.count(F.when(cond, F.col("units_sold")))


def _lift(s1: Column, c1: Column, s0: Column, c0: Column, digits: int = 1) -> Column:
    """100 * (s1/c1 - s0/c0) / (s0/c0) as an exact ratio: 100 (s1 c0 - s0 c1) / (c1 s0)."""
    num = (s1.cast("decimal(38,0)") * c0 - s0.cast("decimal(38,0)") * c1) * 100
    return round_ratio(num, c1.cast("decimal(38,0)") * s0, digits)


def snap_averages(fact: DataFrame) -> DataFrame:
    """avg units, item-days and units by state, category and benefit-day flag."""
    return fact.groupBy("state_id", "cat_id", "snap_flag").agg(
        avg_rounded("units_sold", 4).alias("avg_daily_units"),
        F.count(F.lit(1)).alias("item_days"),
        F.sum("units_sold").cast("long").alias("total_units"),
    ).orderBy("state_id", "cat_id", "snap_flag")


def snap_lift(fact: DataFrame) -> DataFrame:
    """benefit-day vs normal-day average and % lift per state and category."""
    snap, normal = F.col("snap_flag") == 1, F.col("snap_flag") == 0
    g = fact.groupBy("state_id", "cat_id").agg(
        _cond_sum(snap).alias("s1"), _cond_count(snap).alias("c1"),
        _cond_sum(normal).alias("s0"), _cond_count(normal).alias("c0"))
    s1, c1, s0, c0 = (F.col(c) for c in ("s1", "c1", "s0", "c0"))
    return g.select(
        "state_id", "cat_id",
        round_ratio(s1, c1, 4).alias("avg_units_snap_day"),
        round_ratio(s0, c0, 4).alias("avg_units_normal_day"),
        _lift(s1, c1, s0, c0).alias("pct_lift"),
    ).orderBy(F.desc_nulls_last("pct_lift"), "state_id", "cat_id")


def snap_by_weekday(fact: DataFrame, category: str = "FOODS") -> DataFrame:
    """one category's avg units by weekday and benefit-day flag."""
    return fact.where(F.col("cat_id") == category).groupBy("weekday", "snap_flag").agg(
        avg_rounded("units_sold", 4).alias("avg_daily_units"),
        F.count(F.lit(1)).alias("item_days"),
    ).orderBy("weekday", "snap_flag")


def event_day_by_category(fact: DataFrame) -> DataFrame:
    """event days vs other days per category."""
    return fact.groupBy("cat_id", "has_event").agg(
        avg_rounded("units_sold", 4).alias("avg_daily_units"),
        F.count(F.lit(1)).alias("item_days"),
    ).orderBy("cat_id", "has_event")


def event_type_effect(fact: DataFrame) -> DataFrame:
    """avg units by event type (NULL -> 'No event') and category."""
    return fact.groupBy(event_label("event_type_1", NO_EVENT_TYPE).alias("event_type"), "cat_id").agg(
        avg_rounded("units_sold", 4).alias("avg_daily_units"),
        F.count(F.lit(1)).alias("item_days"),
    ).orderBy("cat_id", F.desc("avg_daily_units"), "event_type")


def named_event_effect(fact: DataFrame, category: str = "FOODS") -> DataFrame:
    """each named event against the category's no-event baseline.

    The baseline is the NULL-event group of the *same* aggregate, spread to the
    event rows by a window over the grouped rows (events + 1): one scan, no
    scalar subquery, no cross join.
    """
    g = fact.where(F.col("cat_id") == category).groupBy("event_name_1").agg(
        F.max("event_type_1").alias("event_type"),
        F.sum("units_sold").cast("long").alias("s"),
        F.count("units_sold").alias("c"),
        F.countDistinct("date").alias("occurrences"),
    )
    everything = Window.partitionBy()
    base_s = F.max(F.when(F.col("event_name_1").isNull(), F.col("s"))).over(everything)
    base_c = F.max(F.when(F.col("event_name_1").isNull(), F.col("c"))).over(everything)
    with_base = g.select("*", base_s.alias("s0"), base_c.alias("c0")).where(F.col("event_name_1").isNotNull())
    s, c, s0, c0 = (F.col(x) for x in ("s", "c", "s0", "c0"))
    return with_base.select(
        F.col("event_name_1").alias("event_name"),
        "event_type",
        round_ratio(s, c, 4).alias("avg_units_on_event"),
        round_ratio(s0, c0, 4).alias("avg_units_normal"),
        _lift(s, c, s0, c0).alias("pct_vs_normal"),
        "occurrences",
    ).orderBy(F.desc_nulls_last("pct_vs_normal"), "event_name")


def weekday_seasonality(fact: DataFrame) -> DataFrame:
    """F16: avg units per wday with its weekday name."""
    return fact.groupBy("wday").agg(
        F.max("weekday").alias("weekday_name"),
        avg_rounded("units_sold", 4).alias("avg_daily_units"),
    ).orderBy("wday")


def daily_total_ma28(fact: DataFrame, window_days: int = 28) -> DataFrame:
    """F32: total units per date and its trailing moving average (NULL until the window is full).

    The un-partitioned window runs over one row per date (bounded by the calendar).
    """
    daily = fact.groupBy("date").agg(F.sum("units_sold").cast("long").alias("daily_units"))
    w = Window.orderBy("date").rowsBetween(-(window_days - 1), 0)
    n = F.count("daily_units").over(w)
    ma = F.sum("daily_units").over(w).cast("double") / n.cast("double")
    return daily.select("date", "daily_units", F.when(n == window_days, ma).alias("ma_28")).orderBy("date")


def weekday_mean_units(fact: DataFrame) -> DataFrame:
    """mean units by weekday, Monday first (wday 3) ... Sunday last (wday 2)."""
    g = fact.groupBy("weekday", "wday").agg(
        (F.sum("units_sold").cast("double") / F.count("units_sold").cast("double")).alias("mean_units"))
    return g.select("weekday", "mean_units", F.pmod(F.col("wday") - 3, F.lit(7)).alias("weekday_order")).orderBy("weekday_order")


def units_histogram_capped(fact: DataFrame, cap: int = 10) -> DataFrame:
    """item-days per units value, values above ``cap`` counted at ``cap``."""
    return fact.groupBy(clip_upper("units_sold", cap).alias("units_capped")).agg(
        F.count(F.lit(1)).alias("item_days")).orderBy("units_capped")


def snap_overall_lift(fact: DataFrame) -> DataFrame:
    """mean units on benefit days vs normal days and the % lift (1 dp)."""
    snap, normal = F.col("snap_flag") == 1, F.col("snap_flag") == 0
    g = fact.agg(_cond_sum(snap).alias("s1"), _cond_count(snap).alias("c1"),
                 _cond_sum(normal).alias("s0"), _cond_count(normal).alias("c0"))
    s1, c1, s0, c0 = (F.col(c) for c in ("s1", "c1", "s0", "c0"))
    return g.select(
        safe_div(s1, c1).alias("mean_snap_day"),
        safe_div(s0, c0).alias("mean_normal_day"),
        _lift(s1, c1, s0, c0).alias("pct_lift"),
    )
