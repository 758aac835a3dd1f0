"""Readers with declared schemas (A1-A5, A13).  No ``inferSchema`` pass anywhere."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import CALENDAR_COLS, CALENDAR_SCHEMA, FACT_COLS, FACT_SCHEMA, ID_COLS, PREDICTIONS_SCHEMA, PRICES_SCHEMA, sales_wide_schema


def header(spark: SparkSession, path: str) -> list[str]:
    """Column names of a CSV file or folder (the first line; no data pass)."""
    return spark.read.option("header", True).csv(path).columns


def _require(path: str, names: Iterable[str], found: Iterable[str]) -> None:
    missing = [n for n in names if n not in set(found)]
    if missing:
        raise ValueError(f"{path}: missing columns {missing}")


def read_by_name(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    """A CSV whose columns may come in any order, with extra ones: typed and selected by name.

    Every file's own header is held against the first one's (``enforceSchema`` off).
    """
    names = header(spark, path)
    _require(path, declared.fieldNames(), names)
    schema = T.StructType([declared[n] if n in declared.fieldNames() else T.StructField(n, T.StringType()) for n in names])
    return (spark.read.schema(schema).option("header", True).option("enforceSchema", False).csv(path)
            .select(*declared.fieldNames()))


def read_sales_wide(spark: SparkSession, path: str) -> DataFrame:
    """A1/A4: wide sales CSV; the day count (evaluation or validation variant) comes from the header.

    The header is read once (names only, all strings); the real read then uses a
    declared schema: six id strings + one int per ``d_`` column.
    """
    names = header(spark, path)
    _require(path, ID_COLS, names)
    return spark.read.schema(sales_wide_schema(names)).option("header", True).option("enforceSchema", False).csv(path)


UNITS = "units"
_QUOTED_SPLIT = ',(?=(?:[^"]*"[^"]*")*[^"]*$)'


def read_sales_lines(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """A1/A4 for the melt: six id columns + one array of day values (text), and the day names in order.

    Lines are split instead of parsed into a column per day, so the plan does
    not grow with the days.  Columns are found by header name (any order, extra
    columns ignored); fields may be quoted.  A missing field is a null.
    """
    names = header(spark, path)
    _require(path, ID_COLS, names)
    days = [n for n in names if n.startswith("d_")]
    at = {n: i for i, n in enumerate(names)}
    line = F.col("value")
    plain = F.split(line, ",")
    unquoted = F.transform(F.split(line, _QUOTED_SPLIT), lambda x: F.replace(F.regexp_replace(x, '^"|"$', ""), F.lit('""'), F.lit('"')))
    fields = F.when(line.contains('"'), unquoted).otherwise(plain)
    first, last = at[days[0]], at[days[-1]]
    if last - first + 1 == len(days):
        values = F.slice("fields", first + 1, len(days))
    else:
        values = F.transform(F.array(*[F.lit(at[d]) for d in days]), lambda i: F.get("fields", i))
    # the header line of every file: its id fields hold the column names
    rows = spark.read.text(path).select(fields.alias("fields")).where(
        ~F.get("fields", F.lit(at[ID_COLS[0]])).eqNullSafe(F.lit(ID_COLS[0])))
    return rows.select(*[F.get("fields", F.lit(at[c])).alias(c) for c in ID_COLS], values.alias(UNITS)), days


def read_calendar(spark: SparkSession, path: str) -> DataFrame:
    """A2 + C1 + C6: the 14 kept calendar columns by name, ``date`` parsed to DATE."""
    return read_by_name(spark, path, CALENDAR_SCHEMA).select(*CALENDAR_COLS).withColumn("date", F.to_date("date", "yyyy-MM-dd"))


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """A3: (store_id, item_id, wm_yr_wk int, sell_price double), by name."""
    return read_by_name(spark, path, PRICES_SCHEMA)


def read_fact(
    spark: SparkSession,
    path: str,
    columns: Iterable[str] | None = None,
    states: Iterable[str] | None = None,
    categories: Iterable[str] | None = None,
) -> DataFrame:
    """A5: projection + state/category scope of the partitioned fact.

    ``state_id`` is the partition column, so a state scope prunes directories;
    ``cat_id`` is pushed to the Parquet reader as a data filter.
    """
    return scope_fact(spark.read.schema(FACT_SCHEMA).parquet(path), columns, states, categories)


def scope_fact(df: DataFrame, columns: Iterable[str] | None = None, states: Iterable[str] | None = None,
               categories: Iterable[str] | None = None) -> DataFrame:
    """Projection + state/category scope on a fact frame (file path or catalog table)."""
    if states is not None:
        df = df.where(F.col("state_id").isin(list(states)))
    if categories is not None:
        df = df.where(F.col("cat_id").isin(list(categories)))
    return df.select(*(list(columns) if columns is not None else FACT_COLS))


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Prediction files under an explicit 7-column schema (partition dir model_name)."""
    return spark.read.schema(PREDICTIONS_SCHEMA).parquet(path).select(*PREDICTIONS_SCHEMA.fieldNames())
