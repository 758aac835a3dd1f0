"""Wide -> long melt as one narrow Generate (no shuffle)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import ID_COLS

DAY_PREFIX = "d_"


def day_columns(columns: list[str]) -> list[str]:
    """B1: day columns are the ones named ``d_<n>``, in header order."""
    return [c for c in columns if c.startswith(DAY_PREFIX)]


def melt(wide: DataFrame, id_cols: list[str] | None = None) -> DataFrame:
    """(ids..., d_1..d_N) -> (ids..., d, day_num, units_sold int).

    ``posexplode`` over one array of the day columns: per input row it emits N
    rows inside the scan stage.  When the header is exactly ``d_1..d_N`` the day
    name is rebuilt from the position; otherwise it is looked up from the names.
    """
    ids = [c for c in (id_cols or ID_COLS) if c in wide.columns]
    days = day_columns(wide.columns)
    exploded = wide.select(*ids, F.posexplode(F.array(*[F.col(c) for c in days])).alias("pos", "units_sold"))
    if days == [f"{DAY_PREFIX}{i}" for i in range(1, len(days) + 1)]:
        d = F.concat(F.lit(DAY_PREFIX), (F.col("pos") + 1).cast("string"))
    else:
        d = F.element_at(F.array(*[F.lit(c) for c in days]), F.col("pos") + 1)
    return exploded.select(
        *ids,
        d.alias("d"),
        day_number(d).alias("day_num"),
        F.col("units_sold").cast("int").alias("units_sold"),
    )


def melt_units(lines: DataFrame, days: list[str], id_cols: list[str] | None = None, units: str = "units") -> DataFrame:
    """The same melt from one array of day values (text, in the order of ``days``) per row.

    The plan has one Generate and no column per day.  Text that is no whole
    number becomes null, which the checks count.
    """
    ids = [c for c in (id_cols or ID_COLS) if c in lines.columns]
    exploded = lines.select(*ids, F.posexplode(units).alias("pos", "value"))
    if days == [f"{DAY_PREFIX}{i}" for i in range(1, len(days) + 1)]:
        d, number = F.concat(F.lit(DAY_PREFIX), (F.col("pos") + 1).cast("string")), F.col("pos") + 1
    else:
        d = F.element_at(F.array(*[F.lit(c) for c in days]), F.col("pos") + 1)
        number = day_number(d)
    return exploded.select(*ids, d.alias("d"), number.cast("int").alias("day_num"), F.trim("value").try_cast("int").alias("units_sold"))


def day_number(d) -> F.Column:
    """``d_<n>`` -> n."""
    return F.regexp_replace(d, f"^{DAY_PREFIX}", "").cast("int")
