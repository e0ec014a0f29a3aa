"""Error measure, weighted ensemble and its evaluation on held-out weeks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.constants import ARIMA_WEIGHT, SERIES, TARGET, TREE_WEIGHT
from shelfcast.functions.labels import absolute_percentage_error
from shelfcast.functions.quantiles import quantiles


def mape(actual: str, predicted: str) -> Column:
    """Mean absolute percentage error over rows with a positive actual; NULL if there are none."""
    return F.avg(absolute_percentage_error(F.col(actual), F.col(predicted)))


def mape_overall(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.agg(
        mape(actual, predicted).alias("mape"), F.count_if(F.col(actual) > 0).alias("n_rows")
    )


def mape_by_sku(df: DataFrame, actual: str, predicted: str) -> DataFrame:
    return df.groupBy("item_nbr").agg(
        mape(actual, predicted).alias("mape"), F.count_if(F.col(actual) > 0).alias("n_rows")
    )


def mape_distribution(per_sku: DataFrame) -> DataFrame:
    """Spread of the per-item MAPE: count, mean, quartiles and maximum.

    ``per_sku`` is the output of mape_by_sku, written down.
    """
    names = ("p25_mape", "median_mape", "p75_mape")
    quartiles = quantiles(per_sku, "mape", (0.25, 0.5, 0.75))
    return per_sku.agg(
        F.count("mape").alias("n_skus"),
        F.avg("mape").alias("mean_mape"),
        *[F.lit(q).cast("double").alias(name) for name, q in zip(names, quartiles)],
        F.max("mape").alias("max_mape"),
    )


def ensemble(
    tree: Column, arima: Column, tree_weight: float = TREE_WEIGHT, arima_weight: float = ARIMA_WEIGHT
) -> Column:
    return tree * tree_weight + arima * arima_weight


def number_steps(rows: DataFrame) -> DataFrame:
    """``forecast_step`` 1, 2, ... of each row inside its series, by week."""
    series = Window.partitionBy(*SERIES).orderBy("week_start")
    return rows.withColumn("forecast_step", F.row_number().over(series))


def align(tree: DataFrame, arima: DataFrame) -> DataFrame:
    """Every held-out row: the k-th row of a series with its k-th ARIMA step. A series without
    history before the cutoff has no ARIMA forecast; it counts as zero and not eligible."""
    both = tree.join(arima, [*SERIES, "forecast_step"], "left").withColumns({
        "arima_forecast": F.coalesce("arima_forecast", F.lit(0.0)),
        "eligible": F.coalesce("eligible", F.lit(False)),
    })
    return both.withColumn(
        "ensemble_forecast", ensemble(F.col("xgb_forecast"), F.col("arima_forecast"))
    )


def member_scores(aligned: DataFrame) -> DataFrame:
    """MAPE of both members and of the ensemble on the same rows, in one pass."""
    members = ("xgb_forecast", "arima_forecast", "ensemble_forecast")
    stats = aligned.agg(
        *[mape(TARGET, m).alias(m) for m in members],
        F.count_if(F.col(TARGET) > 0).alias("n_rows"),
        F.count_distinct(F.when(~F.col("eligible"), F.struct(*SERIES))).alias("n_zero_series"),
    )
    return stats.unpivot(
        ["n_rows", "n_zero_series"], list(members), "member", "mape"
    ).select("member", "mape", "n_rows", "n_zero_series")
