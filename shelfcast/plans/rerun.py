"""A7 on the published fact: a state's or store's rerun replaces its partitions only.

The scope is transformed from the raw files into bucketed files of its own, checked there alone, and
published by the next manifest (``sources/versions.py``).  A store's rerun carries the other stores of
its state over from the current version, bucket by bucket; other states are not read.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.enrich import ValidationError, scope
from ..schemas import FACT_COLS, FACT_SCHEMA, SERIES_KEY
from ..sources import catalog
from ..sources.readers import read_fact, read_sales_lines
from ..sources.versions import Versioned
from ..sources.writers import BUCKET_COLS, write_fact
from .fact_job import Build, transform, validate


def versioned_fact(spark: SparkSession, b: Build, root: str) -> Versioned:
    """The published fact ``b`` as a versioned table below ``root``; its first version stands on the fact's own files."""
    table = Versioned(root, "sales_long_versioned", "state_id", FACT_SCHEMA, (b.n_buckets, BUCKET_COLS))
    if not table.version(spark):
        states = read_fact(spark, b.fact).select("state_id").distinct().collect()  # a row a state
        table.publish(spark, {r[0]: f"{b.fact}/state_id={r[0]}" for r in states}, base=0)
    return table


def rerun(spark: SparkSession, table: Versioned, b: Build, sales: str, calendar: str, prices: str,
          states: Iterable[str] | None = None, stores: Iterable[str] | None = None) -> int:
    """Transform, check and publish the scope's partitions; the number of the new version.

    Nothing is published when a check fails (``ValidationError``).
    """
    states, stores = (list(x) if x is not None else None for x in (states, stores))
    base = table.version(spark)
    fact, n_series, n_days = transform(spark, sales, calendar, prices, states, stores, width=b.n_buckets)
    if n_days != b.n_days:
        raise ValidationError(f"the rerun has {n_days} days, the published fact {b.n_days}")
    lines, _ = read_sales_lines(spark, sales)
    touched = sorted(r[0] for r in scope(lines, states, stores).select("state_id").distinct().collect())
    if stores is not None:
        kept = table.read(spark).where(F.col("state_id").isin(touched) & ~F.col("store_id").isin(stores))
        n_series += kept.select(*SERIES_KEY).distinct().count()
        fact = fact.select(*FACT_COLS).unionByName(kept.select(*FACT_COLS))
    out = table.new_folder()
    staging = f"staging_{out.rsplit('/', 1)[1]}"
    try:
        write_fact(fact, out, buckets=b.n_buckets, table=staging)
    finally:
        catalog.drop_table(spark, staging)  # the files stay; nothing unchecked is visible
    written = read_fact(spark, out)
    validate(written, n_series, n_days)
    found = sorted(r[0] for r in written.select("state_id").distinct().collect())
    if found != touched:
        raise ValidationError(f"the rerun wrote {found} instead of {touched}")
    return table.publish(spark, {s: f"{out}/state_id={s}" for s in touched}, base=base)


def by_version(spark: SparkSession, table: Versioned) -> DataFrame:
    """(state_id, since): the version that each partition is of."""
    return spark.createDataFrame([(value, since) for value, (_, since) in sorted(table.partitions(spark).items())], "state_id string, since int")
