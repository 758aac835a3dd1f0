"""Fact checks: F1-F3, F21, F21b, F22, F29, F30, F31, F35, F39.

Scale notes
* COUNT(DISTINCT a), COUNT(DISTINCT b), ... in one aggregate makes Catalyst
  ``Expand`` every row once per distinct column.  Here items and stores are
  counted from one row per series and days from one row per day: two scans, no
  fact row is multiplied.
* The transform checks group once by series and derive every metric, the
  primary-key check included (rows vs distinct days per series), from it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import pct_rounded
from ..schemas import FACT_PK, SERIES_KEY


def _int_sum(cond: Column) -> Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def _fmt_int(c: Column) -> Column:
    """``f"{x:,}"`` for integers."""
    return F.format_number(c.cast("long"), 0)


def _fmt1(c: Column) -> Column:
    return F.format_string("%.1f", c)


def series_members(fact: DataFrame, by: list[str]) -> DataFrame:
    """(by..., k, v, n): every item (k = 0) and store (k = 1) once, n = the item's rows (0 for stores).

    From one row per series (no shuffle on the bucketed fact), so both columns
    take one scan.
    """
    per_series = fact.groupBy(*by, *SERIES_KEY).agg(F.count(F.lit(1)).alias("n"))
    zero = F.lit(0).cast("long")
    pair = F.array(F.struct(F.lit(0).alias("k"), F.col("item_id").alias("v"), F.col("n").alias("n")),
                   F.struct(F.lit(1).alias("k"), F.col("store_id").alias("v"), zero.alias("n")))
    return per_series.select(*by, F.inline(pair)).groupBy(*by, "k", "v").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------------------
# F1 / F2 / F3
# ---------------------------------------------------------------------------

def rows_by_state(fact: DataFrame) -> DataFrame:
    """rows, distinct items/stores/days and date range per state."""
    per_day = fact.groupBy("state_id", "d").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"))
    days = per_day.groupBy("state_id").agg(
        F.sum("n").alias("row_count"), F.count(F.lit(1)).alias("distinct_days"),
        F.min("lo").alias("first_date"), F.max("hi").alias("last_date"))
    dims = series_members(fact, ["state_id"]).groupBy("state_id").agg(
        F.count(F.when(F.col("k") == 0, 1)).alias("distinct_items"),
        F.count(F.when(F.col("k") == 1, 1)).alias("distinct_stores"))
    return days.join(dims, "state_id").select(
        "state_id", "row_count", "distinct_items", "distinct_stores", "distinct_days", "first_date", "last_date"
    ).orderBy("state_id")


def grand_total_check(fact: DataFrame) -> DataFrame:
    """count(*) against distinct items x stores x days."""
    days = fact.groupBy(F.col("d").alias("v")).agg(F.lit(2).alias("k"), F.lit(0).cast("long").alias("n"))
    branches = series_members(fact, []).select("k", "v", "n").unionByName(days.select("k", "v", "n"))
    agg = branches.agg(
        F.sum("n").alias("actual_rows"),
        F.count(F.when(F.col("k") == 0, 1)).alias("items"),
        F.count(F.when(F.col("k") == 1, 1)).alias("stores"),
        F.count(F.when(F.col("k") == 2, 1)).alias("days"),
    )
    expected = F.col("items") * F.col("stores") * F.col("days")
    return agg.select("actual_rows", expected.alias("expected_rows"), (F.col("actual_rows") == expected).alias("passed"))


def pk_duplicates(fact: DataFrame, limit: int = 20) -> DataFrame:
    """primary-key groups with more than one row (the first ``limit``, in key order)."""
    return (fact.groupBy(*FACT_PK).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1).orderBy(*FACT_PK).limit(limit))


# ---------------------------------------------------------------------------
# F21 / F21b / F22 / F30 / F31 / F35
# ---------------------------------------------------------------------------

def calendar_coverage(fact: DataFrame) -> DataFrame:
    """distinct days, min/max day and whether the day range has no gaps (global)."""
    per_d = fact.groupBy("d").agg(F.min("day_num").alias("dn"))
    agg = per_d.agg(F.count(F.lit(1)).alias("distinct_days"), F.min("dn").alias("min_day"), F.max("dn").alias("max_day"))
    return agg.select("distinct_days", "min_day", "max_day",
                      ((F.col("max_day") - F.col("min_day") + 1) == F.col("distinct_days")).alias("no_gaps"))


def series_coverage(fact: DataFrame) -> DataFrame:
    """Series whose rows do not cover their own day span exactly once."""
    per = fact.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("days_present"), F.min("day_num").alias("first_day"), F.max("day_num").alias("last_day"))
    span = F.col("last_day") - F.col("first_day") + 1
    return per.select(*SERIES_KEY, "days_present", "first_day", "last_day", span.alias("span_days")).where(
        F.col("days_present") != F.col("span_days")).orderBy(*SERIES_KEY)


def quality_summary(fact: DataFrame, expected_rows: int, expected_series: int) -> DataFrame:
    """five checks as rows from ONE series-level aggregate (not five scans + UNION ALL).

    ``metric`` keeps the number; ``metric_value`` is its text (integers plain,
    percentages with two decimals).
    """
    per_series = fact.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        _int_sum(F.col("units_sold") == 0).alias("zero"),
        _int_sum(F.col("sell_price").isNull()).alias("null_price"),
        _int_sum(F.col("units_sold") < 0).alias("neg"),
    )
    one = per_series.agg(
        F.sum("n").alias("n"), F.sum("zero").alias("zero"), F.sum("null_price").alias("null_price"),
        F.sum("neg").alias("neg"), F.count(F.lit(1)).alias("series"))
    pct_zero = pct_rounded(F.col("zero"), F.col("n"), 2)
    pct_null = pct_rounded(F.col("null_price"), F.col("n"), 2)
    def row(name: str, metric: Column, text: Column, expected: str) -> Column:
        return F.struct(F.lit(name).alias("check_name"), metric.cast("double").alias("metric"),
                        text.alias("metric_value"), F.lit(expected).alias("expected_value"))

    rows = F.array(
        row("total_rows", F.col("n"), F.col("n").cast("string"), str(expected_rows)),
        row("pct_zero_sales_days", pct_zero, F.format_string("%.2f", pct_zero), "informational"),
        row("pct_null_sell_price", pct_null, F.format_string("%.2f", pct_null), "informational"),
        row("distinct_item_store_series", F.col("series"), F.col("series").cast("string"), str(expected_series)),
        row("negative_units_rows", F.col("neg"), F.col("neg").cast("string"), "0"),
    )
    return one.select(F.inline(rows))


def null_quality_row(fact: DataFrame) -> DataFrame:
    """the transform's one-row null / zero summary."""
    return fact.agg(
        _int_sum(F.col("units_sold").isNull()).alias("null_units"),
        _int_sum(F.col("date").isNull()).alias("null_date_calendar_join"),
        _int_sum(F.col("sell_price").isNull()).alias("null_price_expected"),
        _int_sum(F.col("units_sold") == 0).alias("zero_sales_rows"),
    )


def scope_profile(fact: DataFrame) -> DataFrame:
    """rows, distinct items and stores, date range of a scope.

    Series-level partials first; then one branch per item and one per store,
    unioned into a single final aggregate (no Expand, no join of one-row frames).
    """
    per_series = fact.groupBy("item_id", "store_id").agg(
        F.count(F.lit(1)).alias("n"), F.min("date").alias("lo"), F.max("date").alias("hi"))
    by_item = per_series.groupBy("item_id").agg(
        F.lit(0).alias("k"), F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    by_store = per_series.groupBy("store_id").agg(
        F.lit(1).alias("k"), F.lit(0).cast("long").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    cols = ["k", "n", "lo", "hi"]
    return by_item.select(*cols).unionByName(by_store.select(*cols)).agg(
        F.sum("n").alias("rows"),
        F.count(F.when(F.col("k") == 0, 1)).alias("items"),
        F.count(F.when(F.col("k") == 1, 1)).alias("stores"),
        F.min("lo").alias("first_date"),
        F.max("hi").alias("last_date"),
    )


PREVIEW_COLUMNS = ["item_id", "store_id", "date", "units_sold", "sell_price", "snap_flag", "has_event"]


def fact_preview(fact: DataFrame, n: int = 10) -> DataFrame:
    """The first ``n`` rows in fact order (store, item, day) — a TakeOrdered, not a sort of the fact."""
    return fact.orderBy("store_id", "item_id", "day_num").limit(n).select(*PREVIEW_COLUMNS)


def zero_share(fact: DataFrame) -> DataFrame:
    """percent of item-days with zero units (1 decimal)."""
    return fact.agg(pct_rounded(_int_sum(F.col("units_sold") == 0), F.count(F.lit(1)), 1).alias("pct_zero_days"))


# ---------------------------------------------------------------------------
# The transform's hard/informational checks
# ---------------------------------------------------------------------------

# fixed values: names of the checks
CHECK_NAMES = [
    "row_count_matches_series_x_days",
    "units_sold_has_no_nulls",
    "units_sold_non_negative",
    "calendar_join_complete",
    "sell_price_nulls_expected_early_period",
    "zero_sales_intermittency",
    "primary_key_unique",
]
INFO = "informational"


def _series_grouped(fact: DataFrame) -> DataFrame:
    """Per series: rows, distinct days and the null/zero/negative counts, in one aggregate.

    (item_id, store_id, d) is unique iff every series has as many distinct
    days as rows, so duplicate rows = rows - distinct days (``day_num`` is the
    number in ``d``).  The day set is built map-side and bounded by the calendar, so the shuffle carries one
    set per series instead of one row per item-day.
    """
    return fact.groupBy(*SERIES_KEY).agg(
        F.count(F.lit(1)).alias("n"),
        F.size(F.collect_set("day_num")).alias("distinct_d"),
        _int_sum(F.col("units_sold").isNull()).alias("null_units"),
        _int_sum(F.col("units_sold") < 0).alias("neg_units"),
        _int_sum(F.col("date").isNull()).alias("null_date"),
        _int_sum(F.col("sell_price").isNull()).alias("null_price"),
        _int_sum(F.col("units_sold") == 0).alias("zero_units"),
    )


def _check_rows(expected: Column) -> Column:
    rows, dup = F.col("rows"), F.col("dupes")
    null_pct = pct_rounded(F.col("null_price"), rows, 1)
    zero_pct = pct_rounded(F.col("zero_units"), rows, 1)

    def row(name: str, expected: Column, actual: Column, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), expected.alias("expected"),
                        actual.alias("actual"), passed.alias("passed"))

    def hard(name: str, actual: Column) -> Column:
        return row(name, F.lit("0"), _fmt_int(actual), actual == 0)

    return F.array(
        row(CHECK_NAMES[0], _fmt_int(expected), _fmt_int(rows), rows == expected),
        hard(CHECK_NAMES[1], F.col("null_units")),
        hard(CHECK_NAMES[2], F.col("neg_units")),
        hard(CHECK_NAMES[3], F.col("null_date")),
        row(CHECK_NAMES[4], F.lit(INFO),
            F.concat(_fmt_int(F.col("null_price")), F.lit(" ("), _fmt1(null_pct), F.lit("%)")), F.lit(True)),
        row(CHECK_NAMES[5], F.lit(INFO), F.concat(_fmt1(zero_pct), F.lit("% of item-days")), F.lit(True)),
        hard(CHECK_NAMES[6], dup),
    )


def _rollup(grouped: DataFrame, by: list[str]) -> DataFrame:
    return grouped.groupBy(*by).agg(
        F.sum("n").alias("rows"), F.sum(F.col("n") - F.col("distinct_d")).alias("dupes"),
        *[F.sum(c).alias(c) for c in ["null_units", "neg_units", "null_date", "null_price", "zero_units"]])


def fact_checks(fact: DataFrame, n_series: int, n_days: int) -> DataFrame:
    """seven checks (check_name, expected, actual, passed) in one pass over the series grouping."""
    agg = _rollup(_series_grouped(fact), [])
    return agg.select(F.posexplode(_check_rows(F.lit(n_series * n_days).cast("long")))).select(
        (F.col("pos") + 1).alias("check_no"), "col.*")


def checks_by_store(fact: DataFrame, series_per_store: DataFrame, n_days: int) -> DataFrame:
    """F29 per store in the same single pass (no store loop); expected from the input series."""
    agg = _rollup(_series_grouped(fact), ["store_id"]).join(series_per_store, "store_id", "left")
    expected = (F.coalesce(F.col("n_series"), F.lit(0)) * F.lit(n_days)).cast("long")
    return agg.select("store_id", F.posexplode(_check_rows(expected))).select(
        "store_id", (F.col("pos") + 1).alias("check_no"), "col.*")


def hard_failures(checks_rows: list) -> list:
    """Rows of a collected check table that fail and are not informational."""
    return [r for r in checks_rows if not r["passed"] and r["expected"] != INFO]
