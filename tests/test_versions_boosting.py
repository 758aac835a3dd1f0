"""Versioned partitions (fact reruns, one model's predictions), partition inventory, staged boosting."""

import uuid

import pytest
from pyspark.sql import functions as F

from shelfcast.operators import forecast, scoring
from shelfcast.operators.enrich import ValidationError
from shelfcast.plans import fact_job, queries, rerun
from shelfcast.schemas import FACT_SCHEMA, PREDICTIONS_SCHEMA
from shelfcast.session import work_root
from shelfcast.sources import catalog
from shelfcast.sources.storage import list_files

from .conftest import SF_SMALL


def _root(spark, name):
    return f"{work_root(spark)}/tests/{name}-{uuid.uuid4().hex[:8]}"


@pytest.fixture(scope="module")
def build(spark):
    return fact_job.stage(spark, SF_SMALL)


@pytest.fixture(scope="module")
def restated(spark, build):
    path = f"{_root(spark, 'restated')}/sales_wide"
    queries._restated_sales(spark, build, path)
    return path


def _totals(df):
    return {r["store_id"]: r["u"] for r in df.groupBy("store_id").agg(F.sum("units_sold").alias("u")).collect()}


# ---------------------------------------------------------------- A7

def test_state_and_store_reruns_swap_their_partitions_only(spark, build, restated):
    table = rerun.versioned_fact(spark, build, _root(spark, "rerun"))
    before, files = _totals(table.read(spark)), list_files(spark, build.fact)
    old = table.read(spark)
    assert old.where("state_id = 'CA'").agg(F.sum("units_sold")).first()[0] == sum(u for s, u in before.items() if s.startswith("CA"))
    held = old.where("state_id = 'CA'").select("units_sold")
    held.collect()  # planned on the old version
    assert rerun.rerun(spark, table, build, restated, build.calendar, build.prices, states=["CA"]) == 2
    parts = table.partitions(spark)
    assert {s: since for s, (_, since) in parts.items()} == {"CA": 2, "TX": 1, "WI": 1}
    assert parts["TX"][0] == f"{build.fact}/state_id=TX"
    after = _totals(table.read(spark))
    more = 25 * build.n_days
    assert after == {s: u + (more if s.startswith("CA") else 0) for s, u in before.items()}
    assert sum(r[0] for r in held.collect()) == sum(u for s, u in before.items() if s.startswith("CA"))  # its files are still there
    assert rerun.rerun(spark, table, build, restated, build.calendar, build.prices, stores=["TX_2"]) == 3
    assert _totals(table.read(spark)) == {s: u + (more if s == "TX_2" else 0) for s, u in after.items()}
    assert table.read(spark).where("state_id = 'TX'").count() == 3 * 25 * build.n_days
    assert list_files(spark, build.fact) == files  # the published files are as they were
    assert _totals(fact_job.sales_long(spark, SF_SMALL)) == before
    assert {s: since for s, (_, since) in table.partitions(spark, 2).items()} == {"CA": 2, "TX": 1, "WI": 1}


def test_a_rerun_of_the_versioned_fact_keeps_its_bucketing(spark, build, restated):
    table = rerun.versioned_fact(spark, build, _root(spark, "bucketed"))
    rerun.rerun(spark, table, build, restated, build.calendar, build.prices, states=["WI"])
    plan = table.read(spark).groupBy("store_id", "item_id").agg(F.sum("units_sold"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in plan


def test_a_failed_rerun_publishes_nothing(spark, build, restated, monkeypatch):
    table = rerun.versioned_fact(spark, build, _root(spark, "failed"))
    kept = table.partitions(spark)
    monkeypatch.setattr(rerun, "validate", lambda *a: (_ for _ in ()).throw(ValidationError("checks")))
    with pytest.raises(ValidationError):
        rerun.rerun(spark, table, build, restated, build.calendar, build.prices, states=["CA"])
    assert table.partitions(spark) == kept and table.version(spark) == 1


def test_a_writer_whose_base_is_old_fails(spark, build):
    table = rerun.versioned_fact(spark, build, _root(spark, "turns"))
    assert table.publish(spark, {"CA": "/x"}, base=1) == 2
    with pytest.raises(Exception, match="(?i)exist"):
        table.publish(spark, {"TX": "/y"}, base=1)
    assert {s: since for s, (_, since) in table.partitions(spark).items()} == {"CA": 2, "TX": 1, "WI": 1}


# ---------------------------------------------------------------- A9

def test_inventory_finds_missing_stray_and_unregistered_partitions(spark):
    root, name = _root(spark, "inventory"), f"inv_{uuid.uuid4().hex[:8]}"
    rows = spark.createDataFrame([(1, "CA"), (2, "TX"), (3, "WI")], "x int, state_id string")
    rows.write.partitionBy("state_id").parquet(root)
    schema = spark.read.parquet(root).schema
    catalog.register_external(spark, name, root, schema, ["state_id"])
    spark.createDataFrame([(4,)], "x int").write.parquet(f"{root}/state_id=XX")  # stray: in storage only
    spark.sql(f"ALTER TABLE {catalog.qualified(name)} ADD PARTITION (state_id='GO') LOCATION '{root}/state_id=GO'")  # in the catalog only
    got = {r[0]: tuple(r)[1:] for r in catalog.partition_inventory(spark, name, "state_id", ["CA", "TX", "WI", "NY"], [root]).collect()}
    assert got == {"CA": (True, True, True), "TX": (True, True, True), "WI": (True, True, True), "XX": (False, True, False),
                   "GO": (True, False, False), "NY": (False, False, True)}
    none = catalog.partition_inventory(spark, f"{name}_absent", "state_id", ["CA"], [f"{root}/nowhere"]).collect()
    assert [tuple(r) for r in none] == [("CA", False, False, True)]


def test_inventory_query(spark):
    assert sorted(map(tuple, queries.partition_inventory(spark, SF_SMALL).collect())) == [(s, True, True, True) for s in ("CA", "TX", "WI")]


# ---------------------------------------------------------------- M6

@pytest.mark.parametrize(("errors", "kept", "ended"), [
    ([3, 2, 1], 3, False), ([3, 2, 2.5, 2.4, 2.3], 2, True), ([3, 2, 2.5, 2.4], 2, False), ([3, 2, 2.5, 2.4, 1.9, 2, 2, 2], 5, True),
    ([1, 2, 3, 4, 0.1], 1, True), ([2, 2, 2, 2], 1, True), ([], 0, False)])
def test_choice_of_trees(errors, kept, ended):
    assert forecast.chosen_trees(errors, patience=3) == (kept, ended)


def test_staged_boosting_keeps_the_curves_choice(spark):
    p = queries.gradient_boosting(spark, SF_SMALL)
    curve = [tuple(r) for r in queries.gradient_boosting_curve(spark, SF_SMALL).orderBy("trees").collect()]
    assert [t for t, _, _ in curve] == list(range(1, len(curve) + 1))
    kept, ended = forecast.chosen_trees([e for _, e, _ in curve])
    assert [t for t, _, k in curve if k] == [kept]
    assert ended or len(curve) == 300
    assert p.where("forecast_units < 0 or forecast_units is null").count() == 0


def test_rows_without_price_are_predicted(spark, build):
    f = fact_job.sales_long(spark, SF_SMALL, columns=queries.NOTEBOOK_COLUMNS, states=["CA"], categories=["FOODS"]).where("store_id = 'CA_1'")
    bare = f.withColumn("sell_price", F.when(F.col("item_id") < "FOODS_2", F.col("sell_price")))
    made, curve = forecast.boosting(bare, queries._cutoff(spark, SF_SMALL), max_iter=3, dense=True)
    assert made.count() == 12 * 28 and curve.count() == 3


# ---------------------------------------------------------------- M7

def test_one_models_partition_is_replaced(spark):
    scope = dict(columns=queries.NOTEBOOK_COLUMNS, **queries.NOTEBOOK_SCOPE)
    cutoff = queries._cutoff(spark, SF_SMALL)
    base = forecast.baseline_predictions(fact_job.sales_long(spark, SF_SMALL, **scope), cutoff=cutoff)
    n = base.where("model_name = 'weekday_mean'").count()
    table = queries.forecast_versions(_root(spark, "models"))
    assert queries.publish_models(spark, table, base, forecast.BASELINES, n) == 1
    before = {m: x for m, x in table.partitions(spark).items() if m != "weekday_mean"}
    files = list_files(spark, table.partitions(spark)["weekday_mean"][0])
    old_folder = table.partitions(spark)["weekday_mean"][0]
    again = base.withColumn("forecast_units", F.lit(1.5))
    assert queries.publish_models(spark, table, again, ["weekday_mean"], n) == 2
    assert {m: x for m, x in table.partitions(spark).items() if m != "weekday_mean"} == before
    assert list_files(spark, old_folder) == files
    got = {r[0]: r[1] for r in table.read(spark).groupBy("model_name").agg(F.collect_set("forecast_units").alias("f")).collect()}
    assert got["weekday_mean"] == [1.5] and len(got) == 3 and len(got["seasonal_naive_28d"]) > 1
    with pytest.raises(ValidationError):
        queries.publish_models(spark, table, again.withColumn("forecast_units", F.lit(-1.0)), ["weekday_mean"], n)
    with pytest.raises(ValidationError):
        queries.publish_models(spark, table, again.limit(5), ["weekday_mean"], n)
    assert table.version(spark) == 2


def test_four_models_in_one_table(spark):
    p = queries.all_predictions(spark, SF_SMALL)
    assert p.schema.fieldNames() == PREDICTIONS_SCHEMA.fieldNames()
    counts = {r[0]: r[1] for r in p.groupBy("model_name").count().collect()}
    assert set(counts) == set(forecast.MODEL_NAMES) and len(set(counts.values())) == 1
    card = {r["model_name"]: r for r in scoring.model_scorecard(p).collect()}
    q = queries.registry()
    best = q["best_model_all"](spark, SF_SMALL).first()
    assert best["rmse"] == min(r["rmse"] for r in card.values())
    assert q["forecast_daily_by_model_all"](spark, SF_SMALL).columns == ["date", "actual_units", *forecast.MODEL_NAMES]
    assert q["forecast_daily_by_model_all"](spark, SF_SMALL).count() == 28
    assert q["reorder_outlook_all"](spark, SF_SMALL).where("horizon_days <> 28").count() == 0
    per_day = q["forecast_daily_all"](spark, SF_SMALL).groupBy("model_name").agg(F.sum("forecast_units").alias("f")).collect()
    total = {r[0]: r[1] for r in p.groupBy("model_name").agg(F.sum("forecast_units")).collect()}
    assert all(abs(r["f"] - total[r["model_name"]]) < 0.5 for r in per_day)
    assert {r["model_name"] for r in q["forecast_worst_all"](spark, SF_SMALL).collect()} == set(forecast.MODEL_NAMES)


def test_fact_schema_of_a_version(spark, build):
    table = rerun.versioned_fact(spark, build, _root(spark, "schema"))
    assert table.read(spark).schema.fieldNames() == FACT_SCHEMA.fieldNames()
