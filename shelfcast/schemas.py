"""Declared schemas (no inference pass anywhere) and column orders."""

from __future__ import annotations

from pyspark.sql import types as T

# ---- fixed values: column names and orders of the files and tables (all lists below) ----
ID_COLS = ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]
SERIES_KEY = ["item_id", "store_id"]
FACT_PK = ["item_id", "store_id", "d"]

# Calendar columns the transform keeps (C1), in file order.
CALENDAR_COLS = [
    "d", "date", "wm_yr_wk", "weekday", "wday", "month", "year",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_CA", "snap_TX", "snap_WI",
]

CALENDAR_SCHEMA = T.StructType([
    T.StructField("d", T.StringType()),
    T.StructField("date", T.StringType()),  # parsed with to_date (C6)
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("weekday", T.StringType()),
    T.StructField("wday", T.IntegerType()),
    T.StructField("month", T.IntegerType()),
    T.StructField("year", T.IntegerType()),
    T.StructField("event_name_1", T.StringType()),
    T.StructField("event_type_1", T.StringType()),
    T.StructField("event_name_2", T.StringType()),
    T.StructField("event_type_2", T.StringType()),
    T.StructField("snap_CA", T.IntegerType()),
    T.StructField("snap_TX", T.IntegerType()),
    T.StructField("snap_WI", T.IntegerType()),
])

PRICES_SCHEMA = T.StructType([
    T.StructField("store_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("wm_yr_wk", T.IntegerType()),
    T.StructField("sell_price", T.DoubleType()),
])

# sales_long: 23 columns, partition key last.
FACT_COLS = [
    "id", "item_id", "dept_id", "cat_id", "store_id",
    "d", "day_num", "date", "wm_yr_wk", "weekday", "wday", "month", "year",
    "units_sold", "sell_price", "revenue",
    "event_name_1", "event_type_1", "event_name_2", "event_type_2",
    "snap_flag", "has_event",
    "state_id",
]

_FACT_TYPES = {
    "day_num": T.IntegerType(), "date": T.DateType(), "wm_yr_wk": T.IntegerType(),
    "wday": T.IntegerType(), "month": T.IntegerType(), "year": T.IntegerType(),
    "units_sold": T.IntegerType(), "sell_price": T.DoubleType(), "revenue": T.DoubleType(),
    "snap_flag": T.IntegerType(), "has_event": T.IntegerType(),
}
FACT_SCHEMA = T.StructType([T.StructField(c, _FACT_TYPES.get(c, T.StringType())) for c in FACT_COLS])

# forecast_vs_actual (A13): DATE, not TIMESTAMP.
PREDICTIONS_SCHEMA = T.StructType([
    T.StructField("date", T.DateType()),
    T.StructField("store_id", T.StringType()),
    T.StructField("cat_id", T.StringType()),
    T.StructField("item_id", T.StringType()),
    T.StructField("actual_units", T.DoubleType()),
    T.StructField("forecast_units", T.DoubleType()),
    T.StructField("model_name", T.StringType()),
])


def sales_wide_schema(header: list[str]) -> T.StructType:
    """Schema of the wide sales file from its header: ids as strings, day columns as ints."""
    return T.StructType([
        T.StructField(c, T.IntegerType() if c.startswith("d_") else T.StringType()) for c in header
    ])
