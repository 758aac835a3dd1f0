"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import work_root

BATCH_BYTES = 4 << 20  # of an Arrow batch that a session sends to a Python worker
# fixed values: ASCII white space of the word definition (space, \t \n \v \f \r)
WHITE = r"[\x20\x09-\x0D]+"
# fixed value: separators of normalised words (anything but letters and digits)
NON_WORD = r"[^\p{L}\p{N}]+"


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` below ``spark.checkpoint.dir`` and read it back: cuts lineage, survives lost executors."""
    path = f"{work_root(df.sparkSession)}/shelfcast-llm/{name}-{uuid.uuid4().hex[:12]}"
    writer = df.write.partitionBy(*partition_by) if partition_by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bound_batches(df: DataFrame) -> None:
    """From here on the session's Arrow batches end at ``BATCH_BYTES``: both sides of a task hold a few of them, however long the rows."""
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def id_kind(rows: DataFrame, column: str = "doc_id") -> str:
    """The type that ids travel as: long for whole numbers, else text."""
    return "long" if isinstance(rows.select(column).schema[0].dataType, T.IntegralType) else "string"


def carried(docs: DataFrame, replaced: tuple[str, ...] = ()) -> Column:
    """All input columns as one struct (but those that an operator's output replaces)."""
    lowered = {r.lower() for r in replaced}
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns if c.lower() not in lowered])


def white_words(text: Column) -> Column:
    """Words separated by ASCII white space; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WHITE), "")


def normal_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits; null text has none."""
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), NON_WORD), "")


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row, however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def window_hashes(words: Column, k: int) -> Column:
    """64-bit hashes of all windows of ``k`` words, in order (empty when there are fewer words)."""
    none = F.array().cast("array<bigint>")

    def hashes(w: Column) -> Column:
        every = F.transform(F.sequence(F.lit(0), F.size(w) - k), lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(k)]))
        return F.when(F.size(w) >= k, every).otherwise(none)

    return bound(words, hashes)


def one_thread() -> None:
    """A task has one core: the tokenizers of its process start no threads of their own."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"


def small(df: DataFrame, max_rows: int) -> bool:
    """Whether a (staged) frame has at most ``max_rows`` rows: the check before a broadcast."""
    return df.limit(max_rows + 1).count() <= max_rows
