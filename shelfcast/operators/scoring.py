"""Scored panel: forecast and pricing label per item-week."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.labels import pricing_recommendation
from shelfcast.operators.trees import Model, predict


def score_batch(df: DataFrame, model: Model) -> DataFrame:
    return predict(df, model, "xgb_forecast")


def add_pricing_gap_signal(df: DataFrame, forecast: str = "xgb_forecast") -> DataFrame:
    label = pricing_recommendation(
        F.col("price_gap_vs_family"), F.col(forecast), F.col("rolling_mean_4w")
    )
    return df.withColumn("pricing_recommendation", label)


def recommendation_summary(scored: DataFrame, forecast: str = "xgb_forecast") -> DataFrame:
    return scored.groupBy("pricing_recommendation").agg(
        F.count(F.lit(1)).alias("sku_weeks"), F.avg(forecast).alias("avg_forecast")
    )


def baseline_forecast(features: DataFrame) -> DataFrame:
    """A forecast that needs no model: last year's week, or the recent mean."""
    return features.withColumn(
        "baseline_forecast", F.coalesce("units_lag_52w", "rolling_mean_4w")
    )
