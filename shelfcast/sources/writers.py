"""Sinks (A6, A14, A15): idempotent overwrite, files clustered for pruning."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

# Upper bound on rows per output file, so file size does not grow with a partition.
MAX_RECORDS_PER_FILE = 5_000_000


BUCKET_COLS = ["store_id", "item_id"]


def write_fact(df: DataFrame, path: str, dynamic: bool = False, partition_cols: Sequence[str] = ("state_id",),
               presorted: bool = True, buckets: int | None = None, table: str | None = None) -> None:
    """Snappy Parquet partitioned by state.

    No repartition by state (3 values, one of them 40 % of the rows): each task
    keeps its rows and writes at most one file per state directory, with one
    open writer per state instead of a sort of the fact rows.  Rows from the
    series-grain transform already arrive ordered by (state, store, item, day)
    (the wide rows are sorted before the melt), so files carry tight min/max
    statistics for item/store filters; ``presorted=False`` (rows from a
    shuffle) sorts them locally first.
    ``dynamic`` replaces only the partitions present in ``df`` (scoped reruns, A7).

    ``buckets`` writes an external table (``table``) bucketed by (store_id,
    item_id): when ``df`` is already hash-partitioned on those columns into the
    same number of partitions (the series-grain transform is), every task holds
    exactly one bucket, so bucketing costs no shuffle and later series-keyed
    aggregates, windows and joins can skip theirs.
    """
    spark = df.sparkSession
    key = "spark.sql.maxConcurrentOutputFileWriters"
    previous = spark.conf.get(key, "0")
    if not presorted:
        df = df.sortWithinPartitions(*partition_cols, "store_id", "item_id", "day_num")
    spark.conf.set(key, "16")
    try:
        writer = (df.write.mode("overwrite")
                  .option("partitionOverwriteMode", "dynamic" if dynamic else "static")
                  .option("compression", "snappy")
                  .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
                  .partitionBy(*partition_cols))
        if buckets:
            from . import catalog

            with catalog._DDL_LOCK:
                catalog.ensure_database(spark)
                catalog.drop_table(spark, table)
                writer.bucketBy(buckets, *BUCKET_COLS).option("path", path).saveAsTable(catalog.qualified(table))
        else:
            writer.parquet(path)
    finally:
        spark.conf.set(key, previous)


def write_predictions(df: DataFrame, path: str) -> None:
    """Dataset overwrite, Snappy, one directory per model."""
    (df.write.mode("overwrite").option("compression", "snappy")
       .option("maxRecordsPerFile", MAX_RECORDS_PER_FILE)
       .partitionBy("model_name").parquet(path))


def write_small_csv(df: DataFrame, path: str) -> None:
    """A check summary or scorecard (a handful of rows) as one CSV file with header."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
