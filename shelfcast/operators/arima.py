"""ARIMA forecasts of every (store, item) series."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from shelfcast.constants import ARIMA_ORDER, FORECAST_HORIZON, MIN_SERIES_POINTS, SERIES, TARGET
from shelfcast.functions.arma import Order, fit_batch


FIT = "struct<forecast: array<double>, fitted: boolean>"


def _forecaster(horizon: int, min_points: int, order: Order) -> Callable:
    @pandas_udf(FIT)
    def forecast(history: pd.Series) -> pd.DataFrame:
        series = [np.asarray(h, dtype=float) for h in history]
        values, fitted = fit_batch(series, horizon, min_points, order)
        return pd.DataFrame({"forecast": list(values), "fitted": fitted})

    return forecast


def histories(panel: DataFrame, value: str = TARGET) -> DataFrame:
    """One row per series with its values in week order. A series holds one value per week, so
    the array is bounded by the calendar however large the panel is."""
    points = F.array_sort(F.collect_list(F.struct("week_start", F.col(value).alias("value"))))
    return panel.groupBy(*SERIES).agg(points["value"].alias("history"))


def series_forecasts(
    panel: DataFrame,
    horizon: int = FORECAST_HORIZON,
    min_points: int = MIN_SERIES_POINTS,
    order: Order = ARIMA_ORDER,
) -> DataFrame:
    """Every step of every series. ``eligible``: the series is long enough; ``fitted``: the fit ended at a maximum.
    The forecasts of a series that was not fitted are zeros."""
    forecast = _forecaster(horizon, min_points, order)
    series = histories(panel).select(
        *SERIES, (F.size("history") >= min_points).alias("eligible"), forecast("history").alias("fit")
    )
    steps = series.select(*SERIES, "eligible", F.col("fit.fitted").alias("fitted"), F.posexplode("fit.forecast"))
    return steps.select(
        *SERIES,
        (F.col("pos") + 1).alias("forecast_step"),
        F.col("col").alias("arima_forecast"),
        "eligible",
        "fitted",
    )


def forecast_all_skus_arima(
    panel: DataFrame,
    horizon: int = FORECAST_HORIZON,
    min_points: int = MIN_SERIES_POINTS,
    order: Order = ARIMA_ORDER,
) -> DataFrame:
    """(store, item, forecast_step 1..horizon, arima_forecast), never negative."""
    return series_forecasts(panel, horizon, min_points, order).drop("eligible", "fitted")


def fit_report(forecasts: DataFrame) -> DataFrame:
    """One row per series of ``series_forecasts``: steps, least forecast, and what became of the fit."""
    return forecasts.groupBy(*SERIES).agg(
        F.count(F.lit(1)).alias("n_steps"),
        F.min("forecast_step").alias("first_step"),
        F.max("forecast_step").alias("last_step"),
        F.bool_and("eligible").alias("eligible"),
        F.bool_and("fitted").alias("fitted"),
        F.bool_and(F.col("arima_forecast") >= 0).alias("never_negative"),
        F.bool_and(F.col("fitted") | (F.col("arima_forecast") == 0)).alias("zero_unless_fitted"),
    )
