"""Versioned partitions: replace one partition of a published table without touching the others' files.

A versioned table has a manifest: which folder each partition value stands on.  A new version of a
partition is written to a folder of its own and checked there; publishing it writes the next
manifest, which differs in that partition only.  Manifests are numbered and never changed; one
counts from the moment it is complete, so a reader sees the old or the new state as a whole, and
files of replaced versions stay for queries that still read them.  Writers take turns: one that
finds the number after its base taken fails and changes nothing.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from . import catalog
from .storage import list_files, path_exists

MANIFEST = "value string, folder string, since int"


@dataclass(frozen=True)
class Versioned:
    """A table of ``schema`` below ``root``, partitioned by ``partition_col`` (and bucketed alike in every version)."""

    root: str
    name: str
    partition_col: str
    schema: T.StructType
    bucket_by: tuple[int, Sequence[str]] | None = None

    @property
    def table(self) -> str:
        return f"{self.name}_{hashlib.sha1(self.root.encode()).hexdigest()[:12]}"

    def _manifest(self, number: int) -> str:
        return f"{self.root}/manifest/{number:08d}"

    def version(self, spark: SparkSession) -> int:
        """Number of the newest complete manifest (0: none)."""
        top = f"{self.root}/manifest"
        if not path_exists(spark, top):
            return 0
        return max([int(file.strip("/").split("/")[0]) for file, _, _ in list_files(spark, top) if file.endswith("/_SUCCESS")], default=0)

    def partitions(self, spark: SparkSession, version: int | None = None) -> dict[str, tuple[str, int]]:
        """Partition value -> (folder, number of the version that it is of)."""
        number = self.version(spark) if version is None else version
        if not number:
            return {}
        return {r["value"]: (r["folder"], r["since"]) for r in spark.read.schema(MANIFEST).json(self._manifest(number)).collect()}

    def new_folder(self) -> str:
        """A folder for the files of a version to come."""
        return f"{self.root}/versions/{uuid.uuid4().hex[:12]}"

    def publish(self, spark: SparkSession, folders: dict[str, str], base: int | None = None) -> int:
        """The next manifest: ``folders`` replace their partitions of manifest ``base`` (the newest); returns its number.

        Raises when another writer published since ``base``.
        """
        known = self.version(spark) if base is None else base
        number = known + 1
        rows = self.partitions(spark, known) | {value: (folder, number) for value, folder in folders.items()}
        frame = spark.createDataFrame([(v, f, n) for v, (f, n) in sorted(rows.items())], MANIFEST)
        frame.coalesce(1).write.mode("error").json(self._manifest(number))
        return number

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest version, through the catalog's external table (its partitions are set to the manifest's folders)."""
        folders = {value: folder for value, (folder, _) in self.partitions(spark).items()}
        catalog.register_located(spark, self.table, self.schema, self.partition_col, folders, self.root, self.bucket_by)
        return spark.table(catalog.qualified(self.table)).select(*self.schema.fieldNames())
