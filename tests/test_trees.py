import numpy as np
import pytest
from frames import panel, rows_of, week

from shelfcast import schemas
from shelfcast.operators import features, holdout, trees
from shelfcast.sources.staging import stage

KEY = "week_start date, store_nbr int, item_nbr int"


@pytest.fixture(scope="module")
def matrix(spark):
    rng = np.random.default_rng(0)
    rows = []
    for w in range(60):
        for i in range(5):
            x, z = float(rng.normal()), float(rng.normal())
            rows.append((week(w), 1, i, x, z, 50.0 + 20.0 * (x > 0)))
    return spark.createDataFrame(rows, KEY + ", x double, z double, weekly_units double").cache()


@pytest.fixture(scope="module")
def model(matrix):
    return trees.train_trees(matrix, ("x", "z"), rounds=3, rate=0.5)


def test_forecast_is_clipped_and_keeps_the_columns(spark, matrix, model):
    got = trees.predict(matrix, model)
    assert got.columns == [*matrix.columns, "xgb_forecast"]
    assert got.where("xgb_forecast < 0").count() == 0
    rows = spark.createDataFrame([(None, 1.0)], "x double, z double")
    filled = spark.createDataFrame([(0.0, 1.0)], "x double, z double")
    assert trees.predict(rows, model).first()["xgb_forecast"] == trees.predict(filled, model).first()["xgb_forecast"]
    assert trees.predict(rows, model).first()["x"] is None


def test_importance_is_sorted_and_sums_to_one(spark, model):
    got = trees.feature_importance(spark, model)
    assert schemas.same_fields(got.schema, schemas.IMPORTANCE)
    rows = got.collect()
    assert rows[0]["feature"] == "x" and sum(r["importance"] for r in rows) == pytest.approx(1.0)


def test_cross_validation_gives_one_score_per_fold(matrix):
    scores = trees.cross_validate(matrix, ("x", "z"), rounds=1)
    assert len(scores) == 5 and all(0 <= s < 1 for s in scores)
    assert trees.mean_score([0.2, None, 0.4]) == pytest.approx(0.3)
    assert trees.mean_score([None]) is None


def test_saved_model_scores_the_same(spark, matrix, model, tmp_path):
    model.save(spark, f"{tmp_path}/m")
    again = trees.load_trees(spark, f"{tmp_path}/m")
    assert rows_of(trees.predict(matrix, again)) == rows_of(trees.predict(matrix, model))


def test_holdout_trains_on_earlier_weeks_only(spark):
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.WEEKLY)
    weekly = stage(spark.createDataFrame(panel(n_items=3, n_weeks=120, n_stores=2), columns), "weekly")
    inputs = holdout.model_inputs(features.feature_table(weekly, stage), stage)
    held = holdout.fit_holdout(inputs, stage, rounds=1)
    last_train = held.before.agg({"week_start": "max"}).first()[0]
    assert held.forecast.where(held.forecast.week_start <= last_train).count() == 0
    steps = held.forecast.groupBy("store_nbr", "item_nbr").agg({"forecast_step": "max"})
    assert {r[2] for r in steps.collect()} == {held.forecast.select("week_start").distinct().count()}
    scores = {r["member"]: r for r in holdout.evaluate_holdout(held).collect()}
    assert set(scores) == {"xgb_forecast", "arima_forecast", "ensemble_forecast", "xgb_forecast_all_weeks"}
    assert scores["ensemble_forecast"]["n_zero_series"] == 0
    assert scores["ensemble_forecast"]["mape"] <= max(
        scores["xgb_forecast"]["mape"], scores["arima_forecast"]["mape"])
