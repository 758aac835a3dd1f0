"""Scoped runs (A7), validate-only, dynamic partition overwrite and the catalog."""

import uuid

import pytest
from pyspark.sql import functions as F

from shelfcast.operators.enrich import ValidationError
from shelfcast.plans import fact_job
from shelfcast.schemas import FACT_SCHEMA
from shelfcast.session import work_root
from shelfcast.sources import catalog
from shelfcast.sources.writers import write_fact

from .conftest import SF_SMALL


@pytest.fixture(scope="module")
def build(spark):
    return fact_job.stage(spark, SF_SMALL)


def test_validate_only_scoped(spark, build):
    rows = fact_job.validate_only(spark, build.sales_wide, build.calendar, build.prices, stores=["TX_2"])
    by = {r["check_name"]: r for r in rows}
    assert by["row_count_matches_series_x_days"]["actual"] == f"{25 * build.n_days:,}"
    with pytest.raises(ValidationError, match="zero rows"):
        fact_job.validate_only(spark, build.sales_wide, build.calendar, build.prices, stores=["XX_9"])


def test_store_scoped_rerun_replaces_only_its_partitions(spark, build):
    path = f"{work_root(spark)}/tests/scoped-{uuid.uuid4().hex[:8]}"
    ca, _, _ = fact_job.transform(spark, build.sales_wide, build.calendar, build.prices, states=["CA"])
    write_fact(ca, path, dynamic=True, partition_cols=("state_id", "store_id"))
    one, _, _ = fact_job.transform(spark, build.sales_wide, build.calendar, build.prices, stores=["CA_1"])
    write_fact(one.withColumn("units_sold", F.lit(-1)), path, dynamic=True, partition_cols=("state_id", "store_id"))
    back = spark.read.parquet(path)
    per_store = {r["store_id"]: (r["n"], r["m"]) for r in
                 back.groupBy("store_id").agg(F.count(F.lit(1)).alias("n"), F.min("units_sold").alias("m")).collect()}
    assert set(per_store) == {"CA_1", "CA_2", "CA_3", "CA_4"}
    assert per_store["CA_1"] == (25 * build.n_days, -1)
    assert all(v[1] >= 0 for k, v in per_store.items() if k != "CA_1")


def test_catalog_tables(spark, build):
    catalog.register_external(spark, "sales_long_t", build.fact, FACT_SCHEMA, ["state_id"])
    parts = sorted(r[0] for r in catalog.show_partitions(spark, "sales_long_t").collect())
    assert parts == ["state_id=CA", "state_id=TX", "state_id=WI"]
    ddl = catalog.show_create_table(spark, "sales_long_t")
    assert "PARTITIONED BY (state_id)" in ddl and "USING parquet" in ddl
    assert catalog.table(spark, "sales_long_t").where("state_id = 'TX'").count() == 75 * build.n_days
    path = f"{work_root(spark)}/tests/ctas-{uuid.uuid4().hex[:8]}"
    small = catalog.table(spark, "sales_long_t").groupBy("state_id").agg(F.count(F.lit(1)).alias("n"))
    catalog.ctas(spark, small, "rows_per_state_t", path, ["state_id"])
    catalog.ctas(spark, small, "rows_per_state_t", path, ["state_id"])  # reuse: files exist
    assert sorted(tuple(r) for r in catalog.table(spark, "rows_per_state_t").select("state_id", "n").collect()) == [
        ("CA", 100 * build.n_days), ("TX", 75 * build.n_days), ("WI", 75 * build.n_days)]
    catalog.drop_table(spark, "rows_per_state_t")
    assert spark.read.parquet(path).count() == 3  # DROP TABLE keeps the external files


def test_failed_checks_do_not_publish(spark, monkeypatch):
    """A build whose checks fail leaves no marker, so no reader can pick it up."""
    from shelfcast.sources.storage import path_exists

    def fail(*_a, **_k):
        raise ValidationError("injected hard failure")

    monkeypatch.setattr(fact_job, "validate", fail)
    base = f"{work_root(spark)}/tests/unpublished-{uuid.uuid4().hex[:8]}"
    with pytest.raises(ValidationError, match="injected"):
        fact_job.build_into(spark, SF_SMALL, base)
    assert path_exists(spark, f"{base}/processed/sales_long/_SUCCESS")  # staged ...
    assert not path_exists(spark, f"{base}/processed/meta/_SUCCESS")  # ... but never published
    assert fact_job._read_meta(spark, base) is None


def test_queries_from_parallel_threads(spark):
    """Queries that register catalog tables can run concurrently on one session."""
    from concurrent.futures import ThreadPoolExecutor

    import __spark_entry__ as E

    keys = ["daily_sales_agg", "weekly_item_agg", "predictions", "catalog_partitions", "lag_features", "fact_checks"]
    with ThreadPoolExecutor(max_workers=len(keys)) as pool:
        counts = dict(zip(keys, pool.map(lambda k: E.queries()[k](spark, SF_SMALL).count(), keys)))
    assert counts["catalog_partitions"] == 3 and counts["fact_checks"] == 7
    assert counts["predictions"] == 3 * 28 * 250 and counts["lag_features"] == 250 * 2499
