"""Raw zone derived from the given tables (lineitem joined with part).

The reference reads three files: a wide sales file (one row per item-store series,
one column per day), a calendar and weekly prices.  Here the same shapes are
derived by Spark from ``lineitem`` + ``part`` so that the work grows
with the input: at part grain the fact has one item per part; at brand grain (the FIXTURES
grain) it always has 250 series, whose units and totals grow:

* series: brand number ``bn`` (from ``p_brand``) x store number ``sn = l_suppkey % 10``
* units: ``sum(l_quantity)`` per series and ship day, 0 on days without lines
* calendar: one row per day between the first and last ship day
* prices: one row per series and week, from the week of its first sale on

Every step is a DataFrame plan; the only driver round trip is the pair of
calendar bounds (one aggregate row).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import idiv
from ..schemas import CALENDAR_COLS, ID_COLS
from ..session import parallelism
from .storage import read_table

# ---- fixed values of the raw-zone rules ------------------------------------
# wday numbering: 1 = Saturday ... 7 = Friday; a known Saturday anchors it.
WEEKDAY_NAMES = ["Saturday", "Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday"]
SATURDAY_ANCHOR = "1994-12-31"
# (month, day, event_name_1, event_type_1)
EVENTS_1 = [
    (12, 25, "Christmas", "National"),
    (7, 4, "IndependenceDay", "National"),
    (2, 14, "ValentinesDay", "Cultural"),
]
# second event on 07-04 of even years
EVENT_2 = (7, 4, "IndependenceDayObserved", "National")
# store number 0-9 -> (state, first store number of that state); CA 4, TX 3, WI 3 stores
STATES = [("CA", 0), ("TX", 4), ("WI", 7)]
# brand number -> category: <= 12 FOODS, <= 18 HOBBIES, else HOUSEHOLD
CATEGORY_LIMITS = [(12, "FOODS"), (18, "HOBBIES")]
OTHER_CATEGORY = "HOUSEHOLD"
# -----------------------------------------------------------------------------


GRAINS = ("brand", "part")


def line_units(spark: SparkSession, sf_dir: str, grain: str = "brand") -> DataFrame:
    """(ik, bn, sn, dt, q) per line; pruned to 4 + 2 columns at the scans.

    ``ik`` is the item key: the brand number (the FIXTURES grain, 25 items) or,
    with ``grain="part"``, the part key (one item per part: at sf0.01 a grid the size of the
    reference's full fact).
    """
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}")
    li = read_table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    ik = brand_number(F.col("p_brand")) if grain == "brand" else F.col("p_partkey").cast("long")
    return li.join(part, li.l_partkey == part.p_partkey).select(
        ik.cast("long").alias("ik"),
        brand_number(F.col("p_brand")).alias("bn"),
        F.pmod(F.col("l_suppkey"), F.lit(10)).cast("int").alias("sn"),
        F.col("l_shipdate").cast("date").alias("dt"),
        F.col("l_quantity").cast("int").alias("q"),
    )


def brand_number(brand: Column) -> Column:
    return F.regexp_extract(brand, r"([0-9]+)", 1).cast("int")


def calendar_bounds(spark: SparkSession, sf_dir: str) -> tuple[dt.date, int]:
    """First ship day and number of calendar days (one aggregate row to the driver)."""
    li = read_table(spark, sf_dir, "lineitem")
    row = li.agg(F.min("l_shipdate").cast("date").alias("lo"), F.max("l_shipdate").cast("date").alias("hi")).first()
    return row["lo"], (row["hi"] - row["lo"]).days + 1


def padded(text: Column, width: int) -> Column:
    """Zero-padded to ``width``; longer text stays whole (``lpad`` alone would cut it)."""
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def series_ids(bn: Column, sn: Column, ik: Column | None = None, width: int = 3) -> list[Column]:
    """id, item_id, dept_id, cat_id, store_id, state_id from (bn, sn) and the item key (default: bn)."""
    cat = F.when(bn <= CATEGORY_LIMITS[0][0], CATEGORY_LIMITS[0][1])
    for limit, name in CATEGORY_LIMITS[1:]:
        cat = cat.when(bn <= limit, name)
    cat = cat.otherwise(OTHER_CATEGORY)
    dept_k = F.when(cat == CATEGORY_LIMITS[0][1], F.pmod(bn, F.lit(3)) + 1).otherwise(F.pmod(bn, F.lit(2)) + 1)
    dept = F.concat_ws("_", cat, dept_k.cast("string"))
    item = F.concat_ws("_", dept, padded((bn if ik is None else ik).cast("string"), width))
    (s1, o1), (s2, o2), (s3, o3) = STATES
    state = F.when(sn < o2, s1).when(sn < o3, s2).otherwise(s3)
    store_no = F.when(sn < o2, sn - o1).when(sn < o3, sn - o2).otherwise(sn - o3) + 1
    store = F.concat_ws("_", state, store_no.cast("string"))
    return [
        F.concat_ws("_", item, store).alias("id"),
        item.alias("item_id"),
        dept.alias("dept_id"),
        cat.alias("cat_id"),
        store.alias("store_id"),
        state.alias("state_id"),
    ]


def calendar(spark: SparkSession, first_day: dt.date, n_days: int) -> DataFrame:
    """One row per day, the reference calendar's 14 kept columns (dates as text, like the CSV)."""
    n = F.col("id").cast("int")
    date = F.date_add(F.lit(first_day), n - 1)
    month, dom, year = F.month(date), F.dayofmonth(date), F.year(date)
    wday = F.pmod(F.datediff(date, F.lit(SATURDAY_ANCHOR).cast("date")), F.lit(7)) + 1
    weekday = F.element_at(F.array(*[F.lit(w) for w in WEEKDAY_NAMES]), wday)

    def on(m: int, d: int) -> Column:
        return (month == m) & (dom == d)

    ev_name = ev_type = None
    for m, d, name, typ in EVENTS_1:
        ev_name = (F.when(on(m, d), name) if ev_name is None else ev_name.when(on(m, d), name))
        ev_type = (F.when(on(m, d), typ) if ev_type is None else ev_type.when(on(m, d), typ))
    m2, d2, name2, type2 = EVENT_2
    second = on(m2, d2) & (F.pmod(year, F.lit(2)) == 0)
    return spark.range(1, n_days + 1).select(
        F.concat(F.lit("d_"), n.cast("string")).alias("d"),
        F.date_format(date, "yyyy-MM-dd").alias("date"),
        (idiv(n - 1, 7) + 1).cast("int").alias("wm_yr_wk"),
        weekday.alias("weekday"),
        wday.cast("int").alias("wday"),
        month.alias("month"),
        year.alias("year"),
        ev_name.alias("event_name_1"),
        ev_type.alias("event_type_1"),
        F.when(second, name2).alias("event_name_2"),
        F.when(second, type2).alias("event_type_2"),
        (dom <= 10).cast("int").alias("snap_CA"),
        ((dom <= 15) & (F.pmod(dom, F.lit(2)) == 1)).cast("int").alias("snap_TX"),
        ((dom <= 15) & (F.pmod(dom, F.lit(3)) != 1)).cast("int").alias("snap_WI"),
    ).select(*CALENDAR_COLS)


def daily_units(spark: SparkSession, sf_dir: str, first_day: dt.date, grain: str = "brand") -> DataFrame:
    """Sparse (ik, bn, sn, day_num, units): map-side partial sums, one shuffle on the day key."""
    lines = line_units(spark, sf_dir, grain)
    return lines.groupBy(
        "ik", "bn", "sn", (F.datediff("dt", F.lit(first_day)) + 1).cast("int").alias("day_num")
    ).agg(F.sum("q").cast("int").alias("units"))


def _ids(grain: str) -> list[Column]:
    ik = None if grain == "brand" else F.col("ik")
    return series_ids(F.col("bn"), F.col("sn"), ik, 3 if grain == "brand" else 6)


def sales_wide_lines(daily: DataFrame, n_days: int, grain: str = "brand") -> DataFrame:
    """One CSV line per series: six ids then the units of days 1..n_days (0 where no line shipped).

    Every day with units becomes the zeros since the day before it and its own
    value; the pieces of a series (at most one per calendar day) are joined in
    day order.  All native; the grouping reuses the window's partitioning.
    """
    key = ["ik", "bn", "sn"]
    gap = F.col("day_num") - F.coalesce(F.lag("day_num").over(Window.partitionBy(*key).orderBy("day_num")), F.lit(0)) - 1
    pieces = daily.select(*key, "day_num", F.concat(F.repeat(F.lit(",0"), gap.cast("int")), F.lit(","), F.col("units").cast("string")).alias("piece"))
    lines = pieces.groupBy(*key).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("day_num", "piece"))), lambda e: e["piece"]), "").alias("head"),
        F.max("day_num").alias("last"))
    units = F.concat("head", F.repeat(F.lit(",0"), (F.lit(n_days) - F.col("last")).cast("int")))
    return lines.select(*_ids(grain), F.substring(units, 2, 1 << 30).alias("units_csv"))


def prices(spark: SparkSession, sf_dir: str, daily: DataFrame, n_days: int, grain: str = "brand") -> DataFrame:
    """Weekly price per series from the week of its first sale to the last week.

    base = avg retail price of the brand (cents, half-up); the week's price steps
    down by 0-20 % with ``step = (floor(wk/4)^2 + bn + sn) % 5``; all in integer cents.
    """
    part = read_table(spark, sf_dir, "part").select("p_brand", "p_retailprice")
    base = part.groupBy(brand_number(F.col("p_brand")).alias("bn")).agg(
        F.sum(F.round(F.col("p_retailprice") * 100).cast("long")).alias("s"),
        F.count(F.lit(1)).alias("c"),
    ).select("bn", idiv(F.col("s") * 2 + F.col("c"), F.col("c") * 2).alias("base_cents"))
    n_weeks = (n_days - 1) // 7 + 1
    first_week = daily.groupBy("ik", "bn", "sn").agg((idiv(F.min("day_num") - 1, 7) + 1).cast("int").alias("fw"))
    weeks = first_week.select("ik", "bn", "sn", F.explode(F.sequence(F.col("fw"), F.lit(n_weeks))).alias("wm_yr_wk"))
    wk4 = idiv(F.col("wm_yr_wk"), 4)
    step = F.pmod(wk4 * wk4 + F.col("bn") + F.col("sn"), F.lit(5))
    price_cents = idiv(F.col("base_cents") * (F.lit(100) - step * 5) * 2 + 100, 200)
    ids = _ids(grain)
    return weeks.join(F.broadcast(base), "bn").select(  # one row per brand
        ids[4], ids[1], F.col("wm_yr_wk").cast("int").alias("wm_yr_wk"),
        (price_cents.cast("double") / F.lit(100.0)).alias("sell_price"),
    )


def wide_header(n_days: int) -> list[str]:
    return ID_COLS + [f"d_{i}" for i in range(1, n_days + 1)]


def write_raw_zone(spark: SparkSession, sf_dir: str, raw_dir: str, grain: str = "brand") -> dict:
    """Write sales_wide (CSV with header), calendar (CSV) and sell_prices (CSV) under raw_dir.

    The wide file is written as one text column whose *name* is the CSV header and
    whose value is the comma-joined line, so no 2,500-column projection is planned.
    The daily sums feed both the wide file and the price weeks, so they are
    written once to the work folder and read back (no second lineitem scan).
    """
    first_day, n_days = calendar_bounds(spark, sf_dir)
    daily_units(spark, sf_dir, first_day, grain).write.mode("overwrite").parquet(f"{raw_dir}/daily_units")
    # The sparse sums are small in bytes but each series expands to n_days values
    # (and a price per week): spread the series over all cores explicitly, or AQE
    # would coalesce the tiny shuffle into one task.  The per-series grouping below
    # reuses this partitioning (no second shuffle).
    daily = spark.read.parquet(f"{raw_dir}/daily_units").repartition(parallelism(spark), "ik", "bn", "sn")
    header = ",".join(wide_header(n_days))
    wide = sales_wide_lines(daily, n_days, grain)
    line = F.concat_ws(",", *[F.col(c) for c in ID_COLS], F.col("units_csv"))
    (wide.select(line.alias(header)).write.mode("overwrite")
        .option("header", True).option("sep", "\t").csv(f"{raw_dir}/sales_wide"))
    (calendar(spark, first_day, n_days).coalesce(1).write.mode("overwrite")
        .option("header", True).csv(f"{raw_dir}/calendar"))
    (prices(spark, sf_dir, daily, n_days, grain).write.mode("overwrite")
        .option("header", True).csv(f"{raw_dir}/sell_prices"))
    return {"first_day": first_day, "n_days": n_days}
