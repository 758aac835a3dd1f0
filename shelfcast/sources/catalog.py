"""Catalog work (A8-A13): database, CTAS tables, external tables, partition inventory.

Tables are *external* (explicit LOCATION in the shared folder), so DROP TABLE
removes the catalog entry and leaves the files, as in the reference.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from .storage import list_files, path_exists

DATABASE = "retail_db"
_DDL_LOCK = threading.RLock()  # DROP + CREATE pairs must not interleave between threads
DATABASE_COMMENT = "Retail demand analytics: fact, curated rollups, forecasts"


def ensure_database(spark: SparkSession, location: str | None = None) -> None:
    """``CREATE DATABASE IF NOT EXISTS ... COMMENT``, located in the shared work folder.

    (Without a location the database would land in the session's default
    warehouse, a folder relative to the driver's working directory.)
    """
    from ..session import work_root

    loc = location or f"{work_root(spark)}/warehouse/{DATABASE}.db"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} COMMENT '{DATABASE_COMMENT}' LOCATION '{loc}'")


def qualified(name: str) -> str:
    return f"{DATABASE}.{name}"


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS`` (files of an external table stay)."""
    spark.sql(f"DROP TABLE IF EXISTS {qualified(name)}")


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)


def register_external(spark: SparkSession, name: str, path: str, schema: T.StructType,
                      partition_cols: Sequence[str] = (), bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """External Parquet table over existing files with a declared schema; partitions recovered.

    ``bucket_by=(n, cols)`` declares how the files were bucketed when written.
    """
    part = f" PARTITIONED BY ({', '.join(partition_cols)})" if partition_cols else ""
    if bucket_by:
        part += f" CLUSTERED BY ({', '.join(bucket_by[1])}) INTO {int(bucket_by[0])} BUCKETS"
    with _DDL_LOCK:
        ensure_database(spark)
        drop_table(spark, name)
        spark.sql(f"CREATE TABLE {qualified(name)} ({_ddl(schema)}) USING parquet{part} LOCATION '{path}'")
        if partition_cols:
            spark.sql(f"ALTER TABLE {qualified(name)} RECOVER PARTITIONS")


def ensure_external(spark: SparkSession, name: str, path: str, schema: T.StructType,
                    partition_cols: Sequence[str] = ()) -> None:
    """:func:`register_external`, unless the table already stands on ``path`` with these columns."""
    with _DDL_LOCK:
        if table_exists(spark, name):
            rows = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(name)}").collect()}
            location = (rows.get("Location") or "").removeprefix("file:").lstrip("/")
            if location == path.removeprefix("file:").lstrip("/") and spark.table(qualified(name)).columns == schema.fieldNames():
                return
        register_external(spark, name, path, schema, partition_cols)


def ctas(spark: SparkSession, df: DataFrame, name: str, path: str, partition_cols: Sequence[str] = ()) -> None:
    """CREATE TABLE AS SELECT to Snappy Parquet at an explicit location.

    An existing, complete output (``_SUCCESS``) is reused: the build is keyed by
    its inputs, so re-running the CTAS would write the same files.
    """
    if path_exists(spark, f"{path}/_SUCCESS"):
        register_external(spark, name, path, df.schema, partition_cols)
        return
    writer = df.write.format("parquet").mode("overwrite").option("compression", "snappy").option("path", path)
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    with _DDL_LOCK:
        ensure_database(spark)
        drop_table(spark, name)
        writer.saveAsTable(qualified(name))


def register_located(spark: SparkSession, name: str, schema: T.StructType, partition_col: str, locations: dict[str, str],
                     path: str, bucket_by: tuple[int, Sequence[str]] | None = None) -> None:
    """External Parquet table whose partitions each stand on a folder of their own (``locations``: value -> folder).

    An existing table keeps the partitions that are already there and gets the others set: one
    metadata change a partition, so a reader plans with the old or the new folder.
    """
    with _DDL_LOCK:
        ensure_database(spark)
        if not table_exists(spark, name):
            bucketed = f" CLUSTERED BY ({', '.join(bucket_by[1])}) INTO {int(bucket_by[0])} BUCKETS" if bucket_by else ""
            spark.sql(f"CREATE TABLE {qualified(name)} ({_ddl(schema)}) USING parquet PARTITIONED BY ({partition_col}){bucketed} LOCATION '{path}'")
        known = partition_locations(spark, name, partition_col)
        for value, folder in locations.items():
            spec = f"PARTITION ({partition_col}='{value}')"
            if value not in known:
                spark.sql(f"ALTER TABLE {qualified(name)} ADD IF NOT EXISTS {spec} LOCATION '{folder}'")
            elif known[value] != _plain_path(folder):
                spark.sql(f"ALTER TABLE {qualified(name)} {spec} SET LOCATION '{folder}'")
        spark.sql(f"REFRESH TABLE {qualified(name)}")


def _plain_path(path: str) -> str:
    return "/" + path.removeprefix("file:").strip("/") if path.startswith(("file:", "/")) else path.rstrip("/")


def partition_locations(spark: SparkSession, name: str, partition_col: str) -> dict[str, str]:
    """Partition value -> folder, as the catalog has them (one metadata lookup a partition)."""
    found = {}
    for row in show_partitions(spark, name).collect():
        value = row[0].split("=", 1)[1]
        about = spark.sql(f"DESCRIBE TABLE EXTENDED {qualified(name)} PARTITION ({partition_col}='{value}')").collect()
        # the partition's own location comes before the table's
        found[value] = _plain_path(next(r[1] for r in about if r[0] == "Location"))
    return found


def partition_inventory(spark: SparkSession, name: str, partition_col: str, expected: Sequence[str], roots: Sequence[str]) -> DataFrame:
    """(value, in_catalog, in_storage, expected) of every partition that any of the three knows.

    ``roots``: folders whose ``<partition_col>=<value>`` subfolders are the storage side; a folder counts when it holds a data file.
    """
    prefix = f"{partition_col}="
    catalogued = {r[0].split("=", 1)[1] for r in show_partitions(spark, name).collect()} if table_exists(spark, name) else set()
    stored = {part.removeprefix(prefix) for root in roots if path_exists(spark, root) for file, size, _ in list_files(spark, root)
              for part in file.split("/")[:-1] if part.startswith(prefix) and size and not file.rsplit("/", 1)[1].startswith(("_", "."))}
    rows = [(v, v in catalogued, v in stored, v in set(expected)) for v in sorted(catalogued | stored | set(expected))]
    return spark.createDataFrame(rows, f"{partition_col} string, in_catalog boolean, in_storage boolean, expected boolean")


def show_partitions(spark: SparkSession, name: str) -> DataFrame:
    """``SHOW PARTITIONS`` of a partitioned table."""
    return spark.sql(f"SHOW PARTITIONS {qualified(name)}")


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(qualified(name))


def show_create_table(spark: SparkSession, name: str) -> str:
    """The table's DDL (schema, format, partitioning, location)."""
    return spark.sql(f"SHOW CREATE TABLE {qualified(name)}").first()[0]


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(qualified(name))
