"""Honest evaluation: both members see only weeks before the cutoff."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.constants import PANEL_KEY, SERIES, TARGET
from shelfcast.operators.arima import series_forecasts
from shelfcast.operators.design import (
    feature_columns,
    holdout_cutoff,
    training_matrix,
    with_previous_week,
)
from shelfcast.operators.ensemble import align, mape, member_scores, number_steps
from shelfcast.operators.features import Stage
from shelfcast.operators.ids import with_entity_ids, with_saved_ids
from shelfcast.operators.trees import Model, predict, train_trees


@dataclass(frozen=True)
class Holdout:
    """Trained tree model and the held-out rows it has not seen, with its forecast."""

    model: Model
    before: DataFrame
    forecast: DataFrame


def model_inputs(features: DataFrame, stage: Stage, ids: DataFrame | None = None) -> DataFrame:
    """Features with ids and lagged leaking columns, written once for all model steps. ``ids`` is
    the table of entity_ids to use; by default the ids come from the features themselves."""
    # Dealt out by series: the id joins may leave all series of an item in one partition.
    known = with_entity_ids(features, stage) if ids is None else with_saved_ids(features, ids)
    rows = known.repartition(*SERIES)
    return stage(with_previous_week(rows), "model-inputs")


def fit_holdout(
    inputs: DataFrame, stage: Stage, leak_free: bool = True, **tree_overrides
) -> Holdout:
    """Train on complete rows before the cutoff, forecast the complete rows from it on.

    The cutoff is the quantile of all rows' weeks. It is one date, fetched so that both sides
    are plain date filters the scan can push down. Steps are numbered before incomplete rows
    are dropped, so step k is the k-th held-out week of the series.
    """
    cutoff = holdout_cutoff(inputs).first()["cutoff"]
    columns = feature_columns(leak_free)
    before = inputs.where(F.col("week_start") < F.lit(cutoff))
    after = number_steps(inputs.where(F.col("week_start") >= F.lit(cutoff)))
    model = train_trees(training_matrix(before, columns), columns, **tree_overrides)
    complete = after.na.drop(subset=[*columns, TARGET])
    forecast = predict(complete, model).select(
        *PANEL_KEY, "forecast_step", TARGET, "xgb_forecast"
    )
    return Holdout(model, before, stage(forecast, "holdout-forecast"))


def ensemble_forecast(held: Holdout, horizon: int | None = None) -> DataFrame:
    """Held-out rows with both members' forecasts and the ensemble: all of them, or with a
    ``horizon`` the first so many of each series.

    ``eligible`` is false for series without a fit, whose second member is zero.
    """
    rows = held.forecast
    if horizon is None:
        horizon = rows.agg(F.max("forecast_step")).first()[0] or 0
    fits = series_forecasts(held.before, horizon)
    arima = fits.withColumn("eligible", F.col("fitted")).drop("fitted")
    return align(rows.where(F.col("forecast_step") <= horizon), arima)


def evaluate_holdout(held: Holdout, horizon: int | None = None) -> DataFrame:
    """MAPE per member on the steps up to ``horizon`` (default: all), and of the tree model on
    every held-out row.

    The tree sees true lags (one step ahead) while ARIMA forecasts 1..horizon steps from the
    cutoff, so the members' scores are not directly comparable.
    """
    shared = member_scores(ensemble_forecast(held, horizon))
    all_rows = held.forecast.agg(
        F.lit("xgb_forecast_all_weeks").alias("member"),
        mape(TARGET, "xgb_forecast").alias("mape"),
        F.count_if(F.col(TARGET) > 0).alias("n_rows"),
        F.lit(0).cast("bigint").alias("n_zero_series"),
    )
    return shared.unionByName(all_rows)
