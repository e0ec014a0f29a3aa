"""Flat reporting tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.functions.labels import ratio_or, recommendation_colour
from shelfcast.operators.elasticity import with_elasticity_bucket

TOP_FAMILIES = 5


def latest_week(scored: DataFrame) -> DataFrame:
    """Rows of the last week. The year predicate prunes a table partitioned by year."""
    last = scored.agg(F.max("week_start").alias("last"))
    rows = scored.where(F.col("week_start") == last.scalar())
    if "year" in scored.columns:
        rows = rows.where(F.col("year") == last.select(F.year("last")).scalar())
    return rows


def export_pricing_gaps(scored: DataFrame, forecast: str = "xgb_forecast") -> DataFrame:
    """Latest week per item with gap, forecast over baseline, label and its chart colour."""
    return latest_week(scored).select(
        "store_nbr", "item_nbr", "family", "price_gap_vs_family", forecast,
        "rolling_mean_4w", "pricing_recommendation", "week_start",
        ratio_or(F.col(forecast), F.col("rolling_mean_4w")).alias("forecast_vs_baseline_ratio"),
        recommendation_colour(F.col("pricing_recommendation")).alias("colour"),
    )


def weekly_trend(scored: DataFrame, forecast: str = "xgb_forecast") -> DataFrame:
    return scored.groupBy("week_start", "family").agg(
        F.sum(forecast).alias("total_forecast_units"),
        F.sum("weekly_units").alias("total_actual_units"),
        F.countDistinct("item_nbr").alias("n_skus"),
    )


def export_weekly_forecast_trend(scored: DataFrame, forecast: str = "xgb_forecast") -> DataFrame:
    return weekly_trend(scored, forecast).orderBy("week_start", "family")


def top_family_trend(trend: DataFrame, top: int = TOP_FAMILIES) -> DataFrame:
    """Series of the families with most units, in chart order. Ties break on the name.

    The kept side is ``top`` rows by construction, which bounds the broadcast.
    """
    totals = trend.groupBy("family").agg(F.sum("total_actual_units").alias("units"))
    leaders = totals.orderBy(F.desc("units"), "family").limit(top).select("family")
    kept = trend.join(F.broadcast(leaders), "family", "left_semi")
    return kept.select(*trend.columns).orderBy("family", "week_start")


def export_elasticity_summary(results: DataFrame) -> DataFrame:
    return with_elasticity_bucket(results)
