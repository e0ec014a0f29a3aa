import math

import pytest
from frames import rows_of

from shelfcast import schemas
from shelfcast.operators import run_selection as rs


@pytest.fixture(scope="module")
def log(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('log')}/runs"
    for name, error in (("a", 0.3), ("b", 0.12), ("c", 0.18), ("d", None)):
        rs.log_run(
            spark, path, name, {"xgb_n_estimators": 500} if name != "c" else {},
            {"ensemble_holdout_mape": error, "xgb_cv_mape": 0.2}, model_path=f"m/{name}")
    rs.log_run(spark, path, "other", {}, {"ensemble_holdout_mape": 0.01}, experiment="else")
    return path


def test_runs_are_appended_with_their_schema(spark, log):
    runs = rs.read_runs(spark, log)
    assert schemas.same_fields(runs.schema, schemas.RUNS)
    assert runs.count() == 5 and runs.select("run_id").distinct().count() == 5


def test_best_run_is_below_the_threshold_and_of_the_experiment(spark, log):
    runs = rs.read_runs(spark, log)
    assert rows_of(rs.best_run(runs), "run_name") == [("b",)]
    assert rs.resolve_model(runs) == "m/b"
    with pytest.raises(rs.NoQualifyingRun):
        rs.resolve_model(runs, threshold=0.1)


def test_no_log_is_reported(spark, tmp_path):
    with pytest.raises(rs.NoQualifyingRun):
        rs.read_runs(spark, f"{tmp_path}/none")


def test_comparison_shows_missing_values_last(spark, log):
    got = rs.run_comparison(rs.read_runs(spark, log)).collect()
    assert [r["mape"] for r in got][:3] == [0.12, 0.18, 0.3] and math.isnan(got[3]["mape"])
    assert [r["n_estimators"] for r in got] == ["500", "N/A", "500", "500"]
    assert len(rs.run_comparison(rs.read_runs(spark, log), 2).collect()) == 2
