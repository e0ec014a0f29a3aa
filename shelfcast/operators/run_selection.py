"""The run log as a table: append, best run, comparison."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.constants import (
    CV_METRIC,
    EXPERIMENT,
    HOLDOUT_METRIC,
    REGISTER_THRESHOLD,
    SCORING_THRESHOLD,
    TREES_PARAM,
)
from shelfcast.schemas import RUNS


class NoQualifyingRun(LookupError):
    """No run of the experiment is below the threshold."""


def new_run_id() -> str:
    return uuid.uuid4().hex


def log_run(
    spark: SparkSession,
    path: str,
    run_name: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float | None],
    model_path: str = "",
    experiment: str = EXPERIMENT,
    run_id: str | None = None,
) -> str:
    """Append one run and return its id. A metric that could not be computed is left out."""
    run_id = run_id or new_run_id()
    known = {k: float(v) for k, v in metrics.items() if v is not None}
    values = (
        run_id, experiment, run_name, {k: str(v) for k, v in params.items()}, known, model_path
    )
    names = ("run_id", "experiment", "run_name", "params", "metrics", "model_path")
    row = spark.createDataFrame([values], RUNS_WITHOUT_TS).select(*names)
    stamped = row.withColumn("ts", F.current_timestamp()).select(*RUNS.fieldNames())
    stamped.write.mode("append").parquet(path)
    return run_id


RUNS_WITHOUT_TS = (
    "run_id string, experiment string, run_name string, params map<string,string>, "
    "metrics map<string,double>, model_path string"
)


def read_runs(spark: SparkSession, path: str) -> DataFrame:
    try:
        return spark.read.schema(RUNS).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        raise NoQualifyingRun(f"no run log at {path}") from missing


def _metric(name: str) -> Column:
    return F.col("metrics")[name]


def best_run(
    runs: DataFrame, threshold: float = REGISTER_THRESHOLD, experiment: str = EXPERIMENT
) -> DataFrame:
    """The run with the lowest holdout error below the threshold: at most one row."""
    qualifying = runs.where(
        (F.col("experiment") == experiment) & (_metric(HOLDOUT_METRIC) < threshold)
    )
    return qualifying.orderBy(_metric(HOLDOUT_METRIC), "run_id").limit(1)


def resolve_model(
    runs: DataFrame, threshold: float = SCORING_THRESHOLD, experiment: str = EXPERIMENT
) -> str:
    """Model path of the best run."""
    found = best_run(runs, threshold, experiment).select("model_path").collect()
    if not found:
        raise NoQualifyingRun(f"no run of {experiment} with {HOLDOUT_METRIC} < {threshold}")
    return found[0]["model_path"]


def run_comparison(runs: DataFrame, n_runs: int = 10, experiment: str = EXPERIMENT) -> DataFrame:
    """The n best runs; a missing metric shows as NaN and sorts last, a missing parameter as N/A."""
    table = runs.where(F.col("experiment") == experiment).select(
        "run_id",
        F.coalesce(_metric(HOLDOUT_METRIC), F.lit(float("nan"))).alias("mape"),
        F.coalesce(_metric(CV_METRIC), F.lit(float("nan"))).alias("cv_mape"),
        F.coalesce(F.col("params")[TREES_PARAM], F.lit("N/A")).alias("n_estimators"),
    )
    return table.orderBy("mape", "run_id").limit(n_runs)
