import pytest

from shelfcast import schemas
from shelfcast.operators import run_selection
from shelfcast.operators.ids import with_saved_ids
from shelfcast.plans import stages
from shelfcast.sources import star
from shelfcast.sources.readers import Warehouse

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def lake(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("lake")
    tables = {"TRAIN": star.train, "ITEMS": star.items, "STORES": star.stores, "OIL": star.oil}
    for name, build in tables.items():
        build(spark, DATA).write.parquet(f"{root}/raw/{name}")
    return Warehouse(location=f"{root}/raw"), f"{root}/out"


def test_stages_in_order(spark, lake):
    source, out = lake
    report = stages.run(spark, source, out, rounds=1, cv=False)
    assert report["ingest"]["train_weekly"] == 5484 and report["features"] == 951
    assert report["elasticity"]["n_skus_modeled"] == 7
    # Random test data: no model gets below the threshold, so scoring is reported as skipped.
    assert str(report["score"]).startswith("skipped")
    assert report["export"] == {"elasticity_summary": 7}
    features = spark.read.parquet(f"{out}/features")
    assert set(features.columns) == set(schemas.FEATURES.fieldNames())
    assert stages.score(spark, out, threshold=1e9) == 951
    scored = spark.read.parquet(f"{out}/scored_forecasts")
    assert {"store_id", "item_id", "xgb_forecast", "pricing_recommendation"} <= set(scored.columns)
    counts = stages.export(spark, out)
    assert counts["elasticity_summary"] == 7 and counts["weekly_forecast_trend"] > 0


def test_the_older_better_run_is_loaded_with_its_own_ids(spark, lake):
    source, out = lake
    runs = run_selection.read_runs(spark, f"{out}/runs").where("experiment = 'pricing/demand_forecast'")
    first = runs.first()
    again = stages.model_forecast(spark, out, cv=False, rounds=2)
    path = run_selection.resolve_model(run_selection.read_runs(spark, f"{out}/runs"), 1e9)
    better = first["metrics"]["ensemble_holdout_mape"] <= again["ensemble_holdout_mape"]
    assert (path == first["model_path"]) == better
    assert {r["model_path"] for r in run_selection.read_runs(spark, f"{out}/runs").collect()} >= {path}
    # An item that the model has not seen has no id of its own.
    rows = spark.createDataFrame([(1, 1), (1, 9999)], "store_nbr int, item_nbr int")
    known = with_saved_ids(rows, spark.read.parquet(f"{path}/ids")).collect()
    assert {r["item_nbr"]: r["item_id"] for r in known}[9999] == -1
    assert all(r["store_id"] == 0 for r in known)


def test_a_leaking_run_is_not_taken_for_a_leak_free_one(spark, tmp_path):
    path = f"{tmp_path}/runs"
    run_selection.log_run(spark, path, "a", {}, {"ensemble_holdout_mape": 0.1}, "leak", "pricing/demand_forecast_parity")
    run_selection.log_run(spark, path, "b", {}, {"ensemble_holdout_mape": 0.4}, "fair")
    assert run_selection.resolve_model(run_selection.read_runs(spark, path), 1.0) == "fair"


def test_a_failing_export_leaves_the_others(spark, lake, tmp_path):
    _, out = lake
    scored = spark.read.parquet(f"{out}/scored_forecasts").drop("price_gap_vs_family")
    scored.write.partitionBy("year").parquet(f"{tmp_path}/scored_forecasts")
    report = stages.export(spark, str(tmp_path))
    assert str(report["pricing_gaps_latest"]).startswith("failed")
    assert report["weekly_forecast_trend"] > 0 and report["elasticity_summary"] == 0


def test_elasticity_export_is_empty_before_its_stage(spark, tmp_path):
    assert stages.export_elasticity(spark, str(tmp_path)) == 0
