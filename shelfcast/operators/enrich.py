"""Fact enrichment: scope (D1/D2), lookup joins (E1-E3), derived columns."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schemas import FACT_COLS

SNAP_STATES = ["CA", "TX", "WI"]


class ValidationError(RuntimeError):
    """A hard check failed; the output must not be published."""


def scope(wide: DataFrame, states: Iterable[str] | None = None, stores: Iterable[str] | None = None) -> DataFrame:
    """``state_id IN`` / ``store_id IN`` on the input series (pushed to the scan)."""
    if states:
        wide = wide.where(F.col("state_id").isin(list(states)))
    if stores:
        wide = wide.where(F.col("store_id").isin(list(stores)))
    return wide


def require_rows(df: DataFrame, what: str = "scope") -> DataFrame:
    """A scope that matches zero rows is an error (one-row probe, not a count)."""
    if df.isEmpty():
        raise ValidationError(f"{what} matched zero rows")
    return df


def assert_unique_keys(dim: DataFrame, keys: Sequence[str], name: str) -> None:
    """E3 guard: a lookup dimension must be unique on its join keys, else the left join fans out."""
    dup = dim.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    if not dup.isEmpty():
        raise ValidationError(f"{name} has duplicate keys {list(keys)}; the join would change the row count")


def lookup_left(fact: DataFrame, dim: DataFrame, keys: Sequence[str], name: str, broadcast: bool = False,
                guard: bool = True) -> DataFrame:
    """Left join that must not change the fact's row count.

    ``broadcast`` only for dimensions with a proven size bound (the calendar:
    one row per day); otherwise the planner/AQE chooses from runtime sizes.
    """
    if guard:
        assert_unique_keys(dim, keys, name)
    right = F.broadcast(dim) if broadcast else dim
    return fact.join(right, list(keys), "left")


def resolve_snap(df: DataFrame) -> DataFrame:
    """Keep the benefit-day flag of the row's own state; 0 for other states."""
    flag = F.lit(0)
    expr = None
    for st in SNAP_STATES:
        expr = (F.when(F.col("state_id") == st, F.col(f"snap_{st}")) if expr is None
                else expr.when(F.col("state_id") == st, F.col(f"snap_{st}")))
    return df.withColumn("snap_flag", expr.otherwise(flag).cast("int")).drop(*[f"snap_{s}" for s in SNAP_STATES])


def derive_columns(df: DataFrame) -> DataFrame:
    """C4/C5 (+C3 already from the melt): has_event 0/1 and revenue = units x coalesce(price, 0)."""
    return df.select(
        "*",
        F.col("event_name_1").isNotNull().cast("int").alias("has_event"),
        (F.col("units_sold") * F.coalesce(F.col("sell_price"), F.lit(0.0))).alias("revenue"),
    )


PRICE_KEYS = ["store_id", "item_id", "wm_yr_wk"]
DUPLICATE_PRICE_MSG = "sell_prices has duplicate (store_id, item_id, wm_yr_wk) keys; the join would change the row count"


PRICE_COLS = ["price_w0", "price_by_pos"]


def number_weeks(calendar: DataFrame) -> DataFrame:
    """The calendar plus ``week_no``: 1 for its first week key, without gaps (week keys may jump, e.g. at a new year)."""
    weeks = calendar.select("wm_yr_wk").where(F.col("wm_yr_wk").isNotNull()).distinct()  # one row per week
    numbered = weeks.withColumn("week_no", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("wm_yr_wk")))
    return calendar.join(F.broadcast(numbered), "wm_yr_wk", "left")


def prices_by_series(prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """One row per series with its weekly prices by week number, from ``price_w0`` on (null in gaps).

    The array is bounded by the calendar's weeks and looked up by position.  The
    E3 guard is folded into the same aggregation: a repeated week raises inside
    the job (``raise_error``), so no extra pass is needed and nothing is published.
    Prices of weeks outside the calendar cannot meet a fact row.
    """
    weeks = calendar.select("wm_yr_wk", "week_no").distinct()  # one row per week of the calendar
    g = prices.join(F.broadcast(weeks), "wm_yr_wk", "left").groupBy("store_id", "item_id").agg(
        F.count(F.lit(1)).alias("n"), F.size(F.collect_set("wm_yr_wk")).alias("keys"), F.count(F.when(F.col("wm_yr_wk").isNull(), 1)).alias("no_week"),
        F.min("week_no").alias("price_w0"), F.max("week_no").alias("w1"),
        F.array_sort(F.collect_list(F.when(F.col("week_no").isNotNull(), F.struct("week_no", "sell_price")))).alias("entries"))
    dense = F.size("entries") == F.col("w1") - F.col("price_w0") + 1
    filled = F.transform(F.sequence("price_w0", "w1"), lambda w: F.try_element_at(F.map_from_entries("entries"), w))
    by_pos = F.when(F.col("n") != F.col("keys") + F.col("no_week"), F.raise_error(F.lit(DUPLICATE_PRICE_MSG))).when(
        F.col("price_w0").isNull(), F.array().cast("array<double>")).when(dense, F.transform("entries", lambda e: e["sell_price"])).otherwise(filled)
    return g.select("store_id", "item_id", "price_w0", by_pos.alias("price_by_pos"))


def attach_prices(wide: DataFrame, prices: DataFrame, calendar: DataFrame) -> DataFrame:
    """E2 at series grain: wide rows (one per series) left-joined 1:1 with their weekly prices."""
    return wide.join(prices_by_series(prices, calendar), ["store_id", "item_id"], "left")


def series_price(week_no: F.Column) -> F.Column:
    """Price of a week number from the columns attached by :func:`attach_prices` (NULL before the first week)."""
    pos = week_no - F.col("price_w0") + 1
    return F.when(pos >= 1, F.try_element_at(F.col("price_by_pos"), pos))


def enrich(long_df: DataFrame, calendar: DataFrame, prices: DataFrame | None = None) -> DataFrame:
    """Calendar (broadcast, bounded by #days), prices, derived columns, 23-column order.

    With ``prices`` the price lookup is a shuffle join of the long rows on the
    three keys (melt-then-join).  Without it, ``long_df`` must carry the
    series prices attached before the melt (:func:`attach_prices`), the calendar its
    week numbers (:func:`number_weeks`), and the
    price is a positional lookup in the same stage — the long fact is never shuffled.
    """
    df = lookup_left(long_df, calendar, ["d"], "calendar", broadcast=True)
    df = resolve_snap(df)
    if prices is not None:
        df = lookup_left(df, prices.select(*PRICE_KEYS, "sell_price"), PRICE_KEYS, "sell_prices")
    else:
        df = df.withColumn("sell_price", series_price(F.col("week_no")))
    return derive_columns(df).select(*FACT_COLS)
