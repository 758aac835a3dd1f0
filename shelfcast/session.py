"""Spark session helpers and the shared work folder.

Staged and curated tables go under ``spark.checkpoint.dir`` (the shared folder
a cluster names for lineage cuts).  Only when the session has none — local runs
and tests — do we pick a folder of our own.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

_LOCAL_ROOT_ENV = "SHELFCAST_LOCAL_ROOT"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "shelfcast") -> SparkSession:
    """A local session tuned like the tests and bench expect (UI off, AQE on, UTC)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        # local sessions only: keep Spark's default database out of the working directory
        .config("spark.sql.warehouse.dir", os.path.join(tempfile.gettempdir(), "shelfcast-warehouse"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.parquet.compression.codec", "snappy")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # pragma: no cover - conf access differs by deploy mode
        value = None
    if not value:
        try:
            value = spark.sparkContext.getConf().get(key, None)
        except Exception:  # no SparkContext on a Connect session
            value = None
    return value or None


def parallelism(spark: SparkSession) -> int:
    """Cores of the cluster (falls back to the shuffle width where the context is not reachable)."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:
        try:
            return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
        except (TypeError, ValueError):
            return 200


def work_root(spark: SparkSession) -> str:
    """Shared folder for staged tables: ``spark.checkpoint.dir`` when the cluster sets it.

    When unset (local runs, tests) a folder of our own is chosen and registered as
    the session's checkpoint dir too, so ``DataFrame.checkpoint()`` and MLlib
    checkpoints land in the same place.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    if root:
        return root.rstrip("/")
    try:
        sc = spark.sparkContext
        current = sc.getCheckpointDir()
    except Exception:  # Connect session: no context to register with
        sc, current = None, None
    if current:
        # getCheckpointDir() returns <dir>/<uuid>; stage next to it.
        return current.rstrip("/").rsplit("/", 1)[0]
    master = sc.master if sc is not None else (_conf(spark, "spark.master") or "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    root = os.environ.get(_LOCAL_ROOT_ENV) or tempfile.mkdtemp(prefix="shelfcast-")
    os.makedirs(root, exist_ok=True)
    if sc is not None:
        sc.setCheckpointDir(root)
    return root
