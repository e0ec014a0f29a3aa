"""Feature columns of the weekly panel.

All series features share one window spec, so chaining them costs one shuffle and one sort. A
series holds at most one row per week, which bounds every window partition by the calendar.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from shelfcast.constants import (
    COLD_START_LAG,
    HOLIDAY_WEEKS,
    LAG_WEEKS,
    PROMO_WINDOW,
    ROLLING_WINDOWS,
    SERIES,
    TARGET,
)
from shelfcast.schemas import FEATURES

Stage = Callable[[DataFrame, str], DataFrame]


def sku_window() -> WindowSpec:
    return Window.partitionBy(*SERIES).orderBy("week_start")


def _previous(n: int) -> WindowSpec:
    """The n rows before the current one; the current row is never seen."""
    return sku_window().rowsBetween(-n, -1)


def add_lag_features(df: DataFrame, weeks: Sequence[int] = LAG_WEEKS) -> DataFrame:
    """Units sold n rows earlier. Offsets count rows, so a missing week shifts them."""
    return df.withColumns(
        {f"units_lag_{n}w": F.lag(TARGET, n).over(sku_window()) for n in weeks}
    )


def add_rolling_features(df: DataFrame, windows: Sequence[int] = ROLLING_WINDOWS) -> DataFrame:
    """Mean, sample deviation and maximum of the previous n rows, the current one excluded."""
    stats = {"mean": F.avg, "std": F.stddev_samp, "max": F.max}
    return df.withColumns(
        {
            f"rolling_{name}_{n}w": stat(TARGET).over(_previous(n))
            for n in windows
            for name, stat in stats.items()
        }
    )


def _weeks_back(first: int, last: int) -> WindowSpec:
    """The weeks from ``first`` to ``last`` before the current one, by the calendar. Days since a fixed Monday
    divide by seven without rest, as all weeks begin on one."""
    number = F.unix_date("week_start") / F.lit(7)
    return Window.partitionBy(*SERIES).orderBy(F.floor(number).cast("int")).rangeBetween(-first, -last)


def add_calendar_features(
    df: DataFrame, weeks: Sequence[int] = LAG_WEEKS, windows: Sequence[int] = ROLLING_WINDOWS
) -> DataFrame:
    """Lags and trailing statistics by week number instead of row: a week without a row is missing, and
    moves no other week. A lag is NULL where that week has no row; statistics are over the rows there are,
    ``weeks_seen_{n}w`` counts them."""
    lags = {f"units_{n}w_ago": F.max(TARGET).over(_weeks_back(n, n)) for n in weeks}
    stats = {"mean": F.avg, "std": F.stddev_samp, "max": F.max}
    trailing = {
        f"calendar_{name}_{n}w": stat(TARGET).over(_weeks_back(n, 1)) for n in windows for name, stat in stats.items()
    }
    seen = {f"weeks_seen_{n}w": F.count(TARGET).over(_weeks_back(n, 1)) for n in windows}
    return df.withColumns(lags | trailing | seen)


def add_yoy_features(df: DataFrame) -> DataFrame:
    """Relative change against 52 rows earlier; NULL unless that week sold something."""
    if "units_lag_52w" not in df.columns:
        df = add_lag_features(df, (52,))
    base = F.col("units_lag_52w")
    growth = (F.col(TARGET) - base) / base
    return df.withColumn("yoy_growth", F.when(base > 0, growth))


def add_time_features(df: DataFrame) -> DataFrame:
    """Calendar parts of the week. ISO week 53 does not count as holiday season."""
    week = F.weekofyear("week_start")
    return df.withColumns(
        {
            "week_of_year": week,
            "month": F.month("week_start"),
            "quarter": F.quarter("week_start"),
            "year": F.year("week_start"),
            "is_holiday_season": F.when(week.isin(*HOLIDAY_WEEKS), 1).otherwise(0),
        }
    )


def add_promotion_rate(df: DataFrame) -> DataFrame:
    return df.withColumn("promo_rate_4w", F.avg("any_promo").over(_previous(PROMO_WINDOW)))


def family_medians(df: DataFrame) -> DataFrame:
    """Median units of each (family, week), from partial sketches merged after the shuffle.

    A sketch has a fixed size, so a family that holds most of the rows is never gathered in
    one task, as a window over (family, week) would do. Same accuracy as the window form:
    rank error of at most 1/10000, exact for groups of fewer than 5000 rows.
    """
    return df.groupBy(
        F.col("family").alias("_family"), F.col("week_start").alias("_week")
    ).agg(F.percentile_approx(TARGET, F.lit(0.5)).alias("family_median_units"))


def add_price_gap_features(df: DataFrame, stage: Stage | None = None) -> DataFrame:
    """Log distance of a row's units to its family's median of the week; 0 if either is not > 0.

    ``stage`` writes the medians down so that the join is planned on their true size.
    """
    medians = family_medians(df)
    if stage is not None:
        medians = stage(medians, "family-medians")
    same_group = F.col("family").eqNullSafe(F.col("_family")) & F.col("week_start").eqNullSafe(
        F.col("_week")
    )
    joined = df.join(medians, same_group, "left").drop("_family", "_week")
    units, middle = F.col(TARGET), F.col("family_median_units")
    gap = F.when((units > 0) & (middle > 0), F.log(units) - F.log(middle))
    return joined.withColumn("price_gap_vs_family", F.coalesce(gap, F.lit(0.0)))


def drop_cold_start_rows(df: DataFrame, min_lag: int = COLD_START_LAG) -> DataFrame:
    return df.where(F.col(f"units_lag_{min_lag}w").isNotNull())


def series_features(weekly: DataFrame) -> DataFrame:
    """Every feature that needs only the row's own series: one window stage."""
    return add_promotion_rate(
        add_time_features(add_yoy_features(add_rolling_features(add_lag_features(weekly))))
    )


def feature_table(weekly: DataFrame, stage: Stage | None = None) -> DataFrame:
    """All features after the cold-start filter.

    ``weekly`` is read twice (medians, series), so pass a written table, not a raw plan. The
    medians include the cold-start rows; only the output drops them.
    """
    complete = add_price_gap_features(series_features(weekly), _medians_of(weekly, stage))
    return drop_cold_start_rows(complete).select(*FEATURES.fieldNames())


def _medians_of(weekly: DataFrame, stage: Stage | None) -> Stage:
    def take(_: DataFrame, label: str) -> DataFrame:
        medians = family_medians(weekly)
        return stage(medians, label) if stage is not None else medians

    return take
