"""Paths and existence checks in the shared work folder (works for any Hadoop FS)."""

from __future__ import annotations

import hashlib
import os

from pyspark.sql import SparkSession

from ..session import work_root

# Bump to force a rebuild; the source of the build modules is part of the key as well.
BUILD_VERSION = "5"
BUILD_MODULES = [
    "shelfcast.schemas", "shelfcast.sources.fixture", "shelfcast.sources.readers", "shelfcast.sources.writers",
    "shelfcast.operators.reshape", "shelfcast.operators.enrich", "shelfcast.operators.checks",
    "shelfcast.plans.fact_job", "shelfcast.functions.numeric",
]


def _code_fingerprint() -> str:
    import importlib
    import inspect

    h = hashlib.sha1()
    for name in BUILD_MODULES:
        h.update(inspect.getsource(importlib.import_module(name)).encode())
    return h.hexdigest()

TESTDATA_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(table_path(sf_dir, name))


def _input_fingerprint(spark: SparkSession, sf_dir: str, names: list[str]) -> str:
    h = hashlib.sha1()
    h.update(BUILD_VERSION.encode())
    h.update(_code_fingerprint().encode())
    h.update(os.path.abspath(sf_dir).encode() if "://" not in sf_dir else sf_dir.encode())
    for n in names:
        for name, length, modified in list_files(spark, table_path(sf_dir, n)):
            h.update(f"{n}:{name}:{length}:{modified}\n".encode())
    return h.hexdigest()[:16]


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path below ``path``, bytes, modification time) of every file, through the path's own Hadoop FS."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    top = jvm.org.apache.hadoop.fs.Path(path)
    fs = top.getFileSystem(conf)
    root = fs.getFileStatus(top).getPath().toString()
    files, found = fs.listFiles(top, True), []
    while files.hasNext():
        f = files.next()
        found.append((f.getPath().toString().removeprefix(root), f.getLen(), f.getModificationTime()))
    return sorted(found)


def build_dir(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the staged raw/processed/curated zones for one input directory."""
    return f"{work_root(spark)}/shelfcast/{_input_fingerprint(spark, sf_dir, ['lineitem', 'part'])}"


def path_exists(spark: SparkSession, path: str) -> bool:
    try:
        jvm = spark._jvm  # classic (non-Connect) session: ask the Hadoop FS directly
        conf = spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        return bool(p.getFileSystem(conf).exists(p))
    except Exception:
        if "://" in path and not path.startswith("file:"):
            raise
        return os.path.exists(path.replace("file:", "", 1))
