"""Label and bucketing expressions (C9, C11) — order of the WHEN chain matters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: labels used by the analysis queries --------------------
NO_EVENT_TYPE = "No event"      # event-type report default
NO_EVENT_OUTLIER = "none"       # outlier report default
NO_EVENT_CURATED = "None"       # curated daily rollup default

PRICE_MOVES = [
    "1. price cut >10%",
    "2. price cut <10%",
    "3. no change",
    "4. price rise <10%",
    "5. price rise >10%",
]

LIFECYCLE_BUCKETS = [
    "Sold from day 1",
    "First sale within 100 days",
    "First sale day 101-500",
    "First sale day 501-1000",
    "NEVER sold",
    "First sale after day 1000",
]
# ---------------------------------------------------------------------------


def event_label(c: Column | str, default: str) -> Column:
    """``COALESCE(event, default)``."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(default))


def price_move(price: Column, prev: Column) -> Column:
    """C11: bucket a weekly price against the previous observed week's price.

    0.9x and 1.1x borders are exclusive; the last bucket is the fall-through.
    """
    cut_big, cut, same, rise, rise_big = PRICE_MOVES
    return (
        F.when(price < prev * F.lit(0.9), cut_big)
        .when(price < prev, cut)
        .when(price == prev, same)
        .when(price > prev * F.lit(1.1), rise_big)
        .otherwise(rise)
    )


def lifecycle_bucket(first_sale_day: Column) -> Column:
    """C11: bucket of the first day with a sale; NULL (never sold) falls through to its branch."""
    day1, d100, d500, d1000, never, later = LIFECYCLE_BUCKETS
    return (
        F.when(first_sale_day <= 1, day1)
        .when(first_sale_day <= 100, d100)
        .when(first_sale_day <= 500, d500)
        .when(first_sale_day <= 1000, d1000)
        .when(first_sale_day.isNull(), never)
        .otherwise(later)
    )
