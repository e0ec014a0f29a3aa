"""Features of what changed, instead of all of them again."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.constants import PANEL_KEY, SERIES
from shelfcast.operators.features import (
    Stage,
    add_price_gap_features,
    drop_cold_start_rows,
    family_medians,
    series_features,
)
from shelfcast.schemas import FEATURES
from shelfcast.sources.sinks import write_by_year


def refreshed_rows(weekly: DataFrame, old: DataFrame, changed: DataFrame, stage: Stage) -> DataFrame:
    """Feature rows that differ from ``old`` because the rows of ``weekly`` named by ``changed`` (the panel key)
    are new or have other values.

    A changed row reaches later rows of its series through lags and trailing frames, and the rows of
    its family's week through the median. So two kinds of rows are read: the series that hold a change, of
    which the weeks from the first change on are kept, and the family weeks that hold one, of
    which other series' rows only get the new median.
    """
    keys = stage(changed.select(*PANEL_KEY).distinct(), "changed-keys")
    first = stage(keys.groupBy(*SERIES).agg(F.min("week_start").alias("_from")), "changed-series")
    group = [F.col("family").alias("_g"), F.col("week_start").alias("_w")]
    groups = stage(weekly.join(keys, list(PANEL_KEY)).select(*group).distinct(), "changed-groups")
    series = stage(weekly.join(first, list(SERIES), "left_semi"), "touched-series")
    here = F.col("family").eqNullSafe(F.col("_g")) & (F.col("week_start") == F.col("_w"))
    # Medians of changed groups are computed again; those of other weeks of the series are as they were there.
    weeks = stage(series.select(*group).distinct(), "touched-groups")
    medians = stage(family_medians(weekly.join(weeks, here, "left_semi")), "touched-medians")

    def known(_: DataFrame, label: str) -> DataFrame:
        return medians

    features = drop_cold_start_rows(add_price_gap_features(series_features(series), known))
    own = features.join(first, list(SERIES)).where(F.col("week_start") >= F.col("_from"))
    own = stage(own.select(*FEATURES.fieldNames()), "refreshed-series")
    beside = old.join(groups, here, "left_semi").join(own, list(PANEL_KEY), "left_anti")
    beside = beside.drop("family_median_units", "price_gap_vs_family")
    return own.unionByName(add_price_gap_features(beside, known).select(*FEATURES.fieldNames()))


def refresh_features(weekly: DataFrame, path: str, changed: DataFrame, stage: Stage) -> int:
    """Bring the table of features by year at ``path`` up to date and return the number of rows written. Only years
    with a refreshed row are overwritten; pass ``weekly`` as a written table. Rows that left ``weekly`` are
    not looked for."""
    spark = weekly.sparkSession
    old = spark.read.parquet(path).select(*FEATURES.fieldNames())
    rows = stage(refreshed_rows(weekly, old, changed, stage), "refreshed")
    years = stage(rows.select("year").distinct(), "refreshed-years")
    kept = old.join(F.broadcast(years), "year", "left_semi").join(rows, list(PANEL_KEY), "left_anti")  # one row a year
    # Written down first: the years to overwrite are read here.
    whole = stage(kept.select(*FEATURES.fieldNames()).unionByName(rows), "refreshed-table")
    return write_by_year(whole, path, keep_other_years=True)
