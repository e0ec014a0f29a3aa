"""The six stages in order. Each reads what earlier stages wrote under ``out``."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession

from shelfcast import schemas
from shelfcast.constants import (
    ARIMA_ORDER,
    ARIMA_WEIGHT,
    CV_METRIC,
    ELASTICITY_EXPERIMENT,
    EXPERIMENT,
    FORECAST_HORIZON,
    HOLDOUT_METRIC,
    MIN_OBS_PER_SKU,
    PARITY_EXPERIMENT,
    SCORING_THRESHOLD,
    SERIES,
    TREE_SETTINGS,
    TREE_WEIGHT,
    TREES_PARAM,
)
from shelfcast.operators import (
    arima,
    design,
    elasticity,
    exports,
    features,
    holdout,
    run_selection,
    scoring,
    trees,
    weekly,
)
from shelfcast.operators.ids import entity_ids
from shelfcast.sources.readers import (
    Warehouse,
    load_items,
    load_oil,
    load_stores,
    load_train,
    read_or_empty,
)
from shelfcast.sources.sinks import (
    read_bucketed,
    write_bucketed,
    write_by_year,
    write_clustered,
    write_small_csv,
    write_table,
)
from shelfcast.sources.staging import stage

STAGES = ("ingest", "features", "elasticity", "forecast", "score", "export")


def _at(spark: SparkSession, out: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{out}/{table}")


def ingest(spark: SparkSession, source: Warehouse, out: str) -> dict[str, int]:
    items, stores = load_items(spark, source), load_stores(spark, source)
    panel = weekly.enrich(weekly.aggregate_weekly(load_train(spark, source)), items, stores)
    return {
        # Every later window is over a series: the weekly table is laid out for them.
        "train_weekly": write_bucketed(panel, f"{out}/train_weekly", SERIES, ("week_start",)),
        "items": write_clustered(items, f"{out}/items", ("family",)),
        "stores": write_table(stores, f"{out}/stores"),
        "oil": write_table(load_oil(spark, source), f"{out}/oil"),
    }


def build_features(spark: SparkSession, out: str) -> int:
    rows = features.feature_table(read_bucketed(spark, f"{out}/train_weekly"), stage)
    return write_by_year(rows, f"{out}/features")


def model_elasticity(
    spark: SparkSession, out: str, min_obs: int = MIN_OBS_PER_SKU
) -> dict[str, float]:
    path = f"{out}/elasticity_results"
    fitted = elasticity.run_elasticity(_at(spark, out, "features"), stage, min_obs)
    write_table(fitted, path)
    metrics = elasticity.elasticity_summary(_at(spark, out, "elasticity_results")).first().asDict()
    run_selection.log_run(
        spark, f"{out}/runs", "promotion_response",
        {"min_obs_per_sku": min_obs, "fits": "within-store least squares, difference in differences"}, metrics,
        experiment=ELASTICITY_EXPERIMENT,
    )
    return metrics


def model_forecast(
    spark: SparkSession,
    out: str,
    leak_free: bool = True,
    cv: bool = True,
    horizon: int = FORECAST_HORIZON,
    evaluated_steps: int | None = None,
    **tree_overrides,
) -> dict[str, float | None]:
    """Cross-validate, evaluate on held-out weeks, then fit on all rows and log the run.

    The logged holdout error is the ensemble's on weeks neither member has seen, up to
    ``evaluated_steps`` of each series (default: all). The model and the ids it was trained with
    are saved under the run's own id; the ARIMA forecast of the next ``horizon`` weeks is written.
    """
    run_id = run_selection.new_run_id()
    model_path = f"{out}/models/{run_id}"
    rows = _at(spark, out, "features")
    entity_ids(rows).write.parquet(f"{model_path}/ids")
    inputs = holdout.model_inputs(rows, stage, spark.read.parquet(f"{model_path}/ids"))
    columns = design.feature_columns(leak_free)
    matrix = stage(design.training_matrix(inputs, columns), "matrix")
    scores = trees.cross_validate(matrix, columns, **tree_overrides) if cv else []
    held = holdout.fit_holdout(inputs, stage, leak_free, **tree_overrides)
    members = {
        row["member"]: row["mape"] for row in holdout.evaluate_holdout(held, evaluated_steps).collect()
    }
    model = trees.train_trees(matrix, columns, **tree_overrides)
    write_small_csv(trees.feature_importance(spark, model), f"{model_path}/feature_importance")
    settings = {**TREE_SETTINGS, **tree_overrides}
    metrics = {
        CV_METRIC: _round(trees.mean_score(scores)),
        HOLDOUT_METRIC: _round(members["ensemble_forecast"]),
        "xgb_holdout_mape": _round(members["xgb_forecast"]),
        "arima_holdout_mape": _round(members["arima_forecast"]),
        "xgb_all_holdout_mape": _round(members["xgb_forecast_all_weeks"]),
    }
    params = {
        "arima_order": ARIMA_ORDER,
        "forecast_horizon_weeks": horizon,
        "xgb_ensemble_weight": TREE_WEIGHT,
        "arima_ensemble_weight": ARIMA_WEIGHT,
        "leak_free": leak_free,
        TREES_PARAM: settings["rounds"],
        **{f"trees_{name}": value for name, value in settings.items()},
    }
    model.save(spark, f"{model_path}/trees")
    write_table(arima.forecast_all_skus_arima(rows, horizon), f"{out}/arima_forecasts")
    run_selection.log_run(
        spark, f"{out}/runs", "trees_with_arima", params, metrics, model_path,
        experiment=EXPERIMENT if leak_free else PARITY_EXPERIMENT, run_id=run_id,
    )
    return metrics


def _round(value: float | None) -> float | None:
    return None if value is None else round(value, 4)


def score(
    spark: SparkSession, out: str, threshold: float = SCORING_THRESHOLD, leak_free: bool = True
) -> int:
    """Score every feature row with the best logged model of one feature set, under the ids that
    model was trained with; a store or item it hasn't seen has id -1."""
    runs = run_selection.read_runs(spark, f"{out}/runs")
    path = run_selection.resolve_model(
        runs, threshold, EXPERIMENT if leak_free else PARITY_EXPERIMENT
    )
    model = trees.load_trees(spark, f"{path}/trees")
    rows = _at(spark, out, "features")
    inputs = holdout.model_inputs(rows, stage, spark.read.parquet(f"{path}/ids"))
    scored = scoring.add_pricing_gap_signal(scoring.score_batch(inputs, model))
    kept = scored.select(
        *rows.columns, "store_id", "item_id", "xgb_forecast", "pricing_recommendation"
    )
    written = write_by_year(kept, f"{out}/scored_forecasts")
    write_table(
        scoring.recommendation_summary(_at(spark, out, "scored_forecasts")),
        f"{out}/recommendation_summary",
    )
    return written


def export(spark: SparkSession, out: str) -> dict[str, object]:
    """All exports. One that fails is reported by its error and doesn't stop the others."""
    scored = _at(spark, out, "scored_forecasts")
    at = f"{out}/exports"
    jobs: dict[str, Callable[[], int]] = {
        "pricing_gaps_latest": lambda: write_table(
            exports.export_pricing_gaps(scored), f"{at}/pricing_gaps_latest"
        ),
        "weekly_forecast_trend": lambda: write_table(
            exports.export_weekly_forecast_trend(scored), f"{at}/weekly_forecast_trend"
        ),
        "top_family_trend": lambda: write_table(
            exports.top_family_trend(spark.read.parquet(f"{at}/weekly_forecast_trend")),
            f"{at}/top_family_trend",
        ),
        "elasticity_summary": lambda: export_elasticity(spark, out),
    }
    report: dict[str, object] = {}
    for name, job in jobs.items():
        try:
            report[name] = job()
        except PySparkException as error:
            report[name] = f"failed: {error}"
    return report


def export_elasticity(spark: SparkSession, out: str) -> int:
    """Bucketed elasticities; an empty table if that stage has not run."""
    fitted = read_or_empty(spark, f"{out}/elasticity_results", schemas.ELASTICITY)
    return write_table(
        exports.export_elasticity_summary(fitted), f"{out}/exports/elasticity_summary"
    )


def run(
    spark: SparkSession, source: Warehouse, out: str, **forecast_settings
) -> Mapping[str, object]:
    """All stages. Scoring and the exports that need it are skipped if no run qualifies."""
    report: dict[str, object] = {
        "ingest": ingest(spark, source, out),
        "features": build_features(spark, out),
        "elasticity": model_elasticity(spark, out),
        "forecast": model_forecast(spark, out, **forecast_settings),
    }
    try:
        report["score"] = score(spark, out)
    except run_selection.NoQualifyingRun as reason:
        report["score"] = f"skipped: {reason}"
        report["export"] = {"elasticity_summary": export_elasticity(spark, out)}
        return report
    report["export"] = export(spark, out)
    return report
