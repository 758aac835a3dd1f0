"""Hand-made frames (FIXTURES.md 2.6) for operator unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from shelfcast.schemas import FACT_COLS, FACT_SCHEMA

D0 = dt.date(2020, 1, 4)  # a Saturday -> wday 1


def fact_rows(spark, rows: list[dict]):
    """A sales_long frame from partial dicts; missing columns get neutral defaults."""
    full = []
    for r in rows:
        day = r.get("day_num", 1)
        date = r.get("date", D0 + dt.timedelta(days=day - 1))
        base = {
            "id": f"{r.get('item_id', 'FOODS_1_001')}_{r.get('store_id', 'CA_1')}",
            "item_id": "FOODS_1_001", "dept_id": "FOODS_1", "cat_id": "FOODS", "store_id": "CA_1",
            "d": f"d_{day}", "day_num": day, "date": date, "wm_yr_wk": (day - 1) // 7 + 1,
            "weekday": "Saturday", "wday": (day - 1) % 7 + 1, "month": date.month if date else 1,
            "year": date.year if date else 2020, "units_sold": 0, "sell_price": 1.0, "revenue": 0.0,
            "event_name_1": None, "event_type_1": None, "event_name_2": None, "event_type_2": None,
            "snap_flag": 0, "has_event": 0, "state_id": "CA",
        }
        base.update(r)
        if "revenue" not in r:
            base["revenue"] = base["units_sold"] * (base["sell_price"] or 0.0)
        full.append(tuple(base[c] for c in FACT_COLS))
    return spark.createDataFrame(full, FACT_SCHEMA)


def series(spark, values: list[int | None], item="FOODS_1_001", store="CA_1", start_day=1, skip=()):
    """One dense series (day_num = start_day..), optionally skipping some days."""
    rows = []
    for i, v in enumerate(values):
        day = start_day + i
        if day in skip:
            continue
        rows.append({"item_id": item, "store_id": store, "day_num": day, "units_sold": v})
    return fact_rows(spark, rows)


WIDE_SCHEMA = T.StructType(
    [T.StructField(c, T.StringType()) for c in ["id", "item_id", "dept_id", "cat_id", "store_id", "state_id"]]
    + [T.StructField(f"d_{i}", T.IntegerType()) for i in range(1, 5)]
)
