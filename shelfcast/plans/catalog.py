"""One named query per operator, over the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.constants import (
    CV_METRIC,
    FEATURE_COLUMNS,
    HOLDOUT_METRIC,
    MIN_SERIES_POINTS,
    PANEL_KEY,
    SERIES,
    TREES_PARAM,
)
from shelfcast.operators import (
    arima,
    design,
    elasticity,
    ensemble,
    exports,
    features,
    holdout,
    ids,
    refresh,
    run_selection,
    scoring,
    trees,
    weekly,
)
from shelfcast.schemas import FEATURES
from shelfcast.sources import readers, sinks, star
from shelfcast.sources.staging import fresh_path, stage

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, columns: Sequence[str], digits: int = 6) -> DataFrame:
    """Compared doubles, rounded: engines differ in the last bits of logs and deviations."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


# ---- shared inputs ---------------------------------------------------------------------------


def daily_sales(spark: SparkSession, folder: str) -> DataFrame:
    return readers.clean_sales(star.train(spark, folder))


def weekly_facts(spark: SparkSession, folder: str) -> DataFrame:
    return weekly.aggregate_weekly(daily_sales(spark, folder))


def panel(spark: SparkSession, folder: str) -> DataFrame:
    return weekly.enrich(
        weekly_facts(spark, folder), star.items(spark, folder), star.stores(spark, folder)
    )


def written_panel(spark: SparkSession, folder: str) -> DataFrame:
    return stage(panel(spark, folder), "weekly")


def feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    return features.feature_table(written_panel(spark, folder), stage)


def written_features(spark: SparkSession, folder: str) -> DataFrame:
    return stage(feature_rows(spark, folder), "features")


def series_feature_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Features that need no family median, after the cold start: the daily fact is read once."""
    return features.drop_cold_start_rows(features.series_features(panel(spark, folder)))


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Features with the model-free forecast and its pricing label."""
    rows = scoring.baseline_forecast(feature_rows(spark, folder))
    return scoring.add_pricing_gap_signal(rows, "baseline_forecast")


# ---- sources and sinks -----------------------------------------------------------------------


def sink_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Write the calendar features partitioned by year, read them back, count rows per year."""
    path = fresh_path(spark, "by-year")
    written = sinks.write_by_year(features.add_time_features(panel(spark, folder)), path)
    back = spark.read.parquet(path)
    return back.groupBy(F.col("year").cast("int").alias("year")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("weekly_units").alias("weekly_units"),
    ).withColumn("rows_written", F.lit(written).cast("bigint"))


def clustered_layout(spark: SparkSession, folder: str) -> DataFrame:
    """Write daily sales clustered by (date, store), read back, total per day and store."""
    path = fresh_path(spark, "clustered")
    sinks.write_clustered(daily_sales(spark, folder), path, ("date", "store_nbr"))
    return spark.read.parquet(path).groupBy("date", "store_nbr").agg(
        F.count(F.lit(1)).alias("n_sales"), F.sum("unit_sales").alias("unit_sales")
    )


def bucketed_features(spark: SparkSession, folder: str) -> DataFrame:
    """Lags and trailing means over a weekly table laid out by series: the windows read it without a shuffle."""
    path = fresh_path(spark, "by-series")
    sinks.write_bucketed(weekly_facts(spark, folder), path, SERIES, ("week_start",))
    rows = features.add_rolling_features(features.add_lag_features(sinks.read_bucketed(spark, path)))
    means = [c for c in STATS if "mean" in c]
    lags = [c for c in rows.columns if c.startswith("units_lag_")]
    return rounded(rows.select(*PANEL_KEY, *lags, *means), means)


# ---- features --------------------------------------------------------------------------------

STATS = [f"rolling_{s}_{n}w" for n in (4, 12, 26) for s in ("mean", "std", "max")]


def lag_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_lag_features(weekly_facts(spark, folder))
    return rows.select(*PANEL_KEY, *[c for c in rows.columns if c.startswith("units_lag_")])


def rolling_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_rolling_features(weekly_facts(spark, folder))
    return rounded(rows.select(*PANEL_KEY, *STATS), STATS)


def yoy_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_yoy_features(weekly_facts(spark, folder))
    return rounded(rows.select(*PANEL_KEY, "units_lag_52w", "yoy_growth"), ["yoy_growth"])


def time_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_time_features(weekly_facts(spark, folder))
    return rows.select(
        *PANEL_KEY, "week_of_year", "month", "quarter", "year", "is_holiday_season"
    )


def promo_rate(spark: SparkSession, folder: str) -> DataFrame:
    rows = features.add_promotion_rate(weekly_facts(spark, folder))
    return rounded(rows.select(*PANEL_KEY, "promo_rate_4w"), ["promo_rate_4w"])


def price_gap(spark: SparkSession, folder: str) -> DataFrame:
    needed = panel(spark, folder).select(*PANEL_KEY, "family", "weekly_units")
    rows = features.add_price_gap_features(stage(needed, "family-weeks"), stage)
    kept = rows.select(*PANEL_KEY, "family", "family_median_units", "price_gap_vs_family")
    return rounded(kept, ["price_gap_vs_family"])


def features_cold_start(spark: SparkSession, folder: str) -> DataFrame:
    rows = feature_rows(spark, folder)
    return rounded(rows, ["avg_daily_units", *STATS, "yoy_growth", "promo_rate_4w", "price_gap_vs_family"])


def calendar_lags(spark: SparkSession, folder: str) -> DataFrame:
    """Lags and trailing statistics by week number."""
    rows = features.add_calendar_features(weekly_facts(spark, folder))
    own = [c for c in rows.columns if c.startswith(("units_", "calendar_", "weeks_seen_"))]
    return rounded(rows.select(*PANEL_KEY, *own), [c for c in own if c.startswith("calendar_")])


def features_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Features built before the last months were known and before some rows of earlier years were corrected, then
    refreshed by what changed: equal to those built at once."""
    weekly_rows = written_panel(spark, folder)
    late = F.col("week_start") >= F.date_sub(F.lit(weekly_rows.agg(F.max("week_start")).scalar()), 7 * 20)
    corrected = (F.pmod(F.xxhash64(*PANEL_KEY), F.lit(199)) == 0) & ~late
    before = weekly_rows.where(~late).withColumn(
        "weekly_units", F.when(corrected, F.col("weekly_units") + 7).otherwise(F.col("weekly_units"))
    )
    path = fresh_path(spark, "features-by-year")
    sinks.write_by_year(features.feature_table(stage(before, "weekly-before"), stage), path)
    refresh.refresh_features(weekly_rows, path, weekly_rows.where(late | corrected).select(*PANEL_KEY), stage)
    rows = spark.read.parquet(path).withColumn("year", F.col("year").cast("int"))
    rows = rows.select(*FEATURES.fieldNames())
    return rounded(rows, ["avg_daily_units", *STATS, "yoy_growth", "promo_rate_4w", "price_gap_vs_family"])


# ---- model inputs ----------------------------------------------------------------------------


def entity_ids(spark: SparkSession, folder: str) -> DataFrame:
    return ids.entity_ids(stage(series_feature_rows(spark, folder).select(*PANEL_KEY), "keys"))


def matrix(spark: SparkSession, folder: str) -> DataFrame:
    inputs = [c for c in FEATURE_COLUMNS if c not in PANEL_KEY]
    needed = feature_rows(spark, folder).select(*PANEL_KEY, "weekly_units", *inputs)
    rows = ids.with_entity_ids(stage(needed, "matrix-inputs"), stage)
    return design.training_matrix(rows)


def training_matrix(spark: SparkSession, folder: str) -> DataFrame:
    fractional = [
        c for c in FEATURE_COLUMNS if c.startswith("rolling_") or c in ("promo_rate_4w", *design.LEAKING)
    ]
    return rounded(matrix(spark, folder), fractional)


def _complete_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the rows that enter training. Ids and the family gap never are NULL, so the
    features of the series itself decide."""
    deciding = [c for c in FEATURE_COLUMNS if c != "price_gap_vs_family"]
    rows = design.training_matrix(series_feature_rows(spark, folder), deciding)
    return stage(rows.select(*PANEL_KEY), "training-keys")


def cv_folds(spark: SparkSession, folder: str) -> DataFrame:
    rows = _complete_keys(spark, folder)
    return design.with_test_fold(rows, design.fold_starts(rows))


def holdout_split(spark: SparkSession, folder: str) -> DataFrame:
    rows = stage(series_feature_rows(spark, folder).select(*PANEL_KEY), "keys")
    return design.with_holdout(rows)


def arima_eligibility(spark: SparkSession, folder: str) -> DataFrame:
    """On the rows the ARIMA fit reads, after the cold start."""
    return design.arima_eligibility(series_feature_rows(spark, folder))


# ---- elasticity ------------------------------------------------------------------------------


def _design(spark: SparkSession, folder: str) -> DataFrame:
    return elasticity.staged_design(series_feature_rows(spark, folder), stage)


def log_log_features(spark: SparkSession, folder: str) -> DataFrame:
    rows = _design(spark, folder).select(*PANEL_KEY, "log_units", "log_demand_baseline", "t", "post")
    return rounded(rows, ["log_units", "log_demand_baseline"])


def elasticity_ols(spark: SparkSession, folder: str) -> DataFrame:
    per_item = elasticity.item_moments(elasticity.series_moments(_design(spark, folder)))
    values = ["elasticity_promo", "elasticity_baseline", "r_squared", "p_value_promo", "aic"]
    return rounded(elasticity.fit_ols(per_item), values)


def elasticity_did(spark: SparkSession, folder: str) -> DataFrame:
    rows = _design(spark, folder)
    per_item = elasticity.item_moments(elasticity.series_moments(rows))
    factors = stage(elasticity.did_factors(per_item), "did-factors")
    return rounded(elasticity.fit_did(rows, factors), ["did_att", "did_se", "did_pvalue", "did_r2"])


def _elasticity(spark: SparkSession, folder: str) -> DataFrame:
    return elasticity.run_elasticity(series_feature_rows(spark, folder), stage)


def elasticity_combined(spark: SparkSession, folder: str) -> DataFrame:
    rows = _elasticity(spark, folder)
    return rounded(rows, [c for c in rows.columns if c not in ("sku", "n_obs")])


def elasticity_summary(spark: SparkSession, folder: str) -> DataFrame:
    return elasticity.elasticity_summary(_elasticity(spark, folder))


def elasticity_buckets(spark: SparkSession, folder: str) -> DataFrame:
    rows = exports.export_elasticity_summary(_elasticity(spark, folder))
    kept = rows.select("sku", "elasticity_promo", "elasticity_bucket")
    return rounded(kept, ["elasticity_promo"])


# ---- forecasts -------------------------------------------------------------------------------


def mape_overall(spark: SparkSession, folder: str) -> DataFrame:
    rows = scoring.baseline_forecast(series_feature_rows(spark, folder))
    return rounded(ensemble.mape_overall(rows, "weekly_units", "baseline_forecast"), ["mape"])


def _mape_by_sku(spark: SparkSession, folder: str) -> DataFrame:
    rows = scoring.baseline_forecast(series_feature_rows(spark, folder))
    return ensemble.mape_by_sku(rows, "weekly_units", "baseline_forecast")


def mape_by_sku(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_mape_by_sku(spark, folder), ["mape"])


def mape_distribution(spark: SparkSession, folder: str) -> DataFrame:
    spread = ensemble.mape_distribution(stage(_mape_by_sku(spark, folder), "mape-by-sku"))
    return rounded(spread, [c for c in spread.columns if c.endswith("_mape")])


def ensemble_weighted(spark: SparkSession, folder: str) -> DataFrame:
    """The ensemble arithmetic over two forecasts that SQL can state."""
    rows = scoring.baseline_forecast(series_feature_rows(spark, folder))
    blend = ensemble.ensemble(F.col("baseline_forecast"), F.col("rolling_mean_12w"))
    kept = rows.select(*PANEL_KEY, "baseline_forecast", blend.alias("ensemble_forecast"))
    return rounded(kept, ["baseline_forecast", "ensemble_forecast"])


def _model_inputs(spark: SparkSession, folder: str) -> DataFrame:
    return holdout.model_inputs(feature_rows(spark, folder), stage)


def _full_model(spark: SparkSession, inputs: DataFrame) -> trees.Model:
    columns = design.feature_columns(leak_free=True)
    return trees.train_trees(stage(design.training_matrix(inputs, columns), "matrix"), columns)


def _held(spark: SparkSession, folder: str) -> holdout.Holdout:
    return holdout.fit_holdout(_model_inputs(spark, folder), stage)


def series_history(spark: SparkSession, folder: str) -> DataFrame:
    """What the ARIMA operator is given per series: the values in week order."""
    rows = arima.histories(series_feature_rows(spark, folder))
    return rows.selectExpr(
        "store_nbr", "item_nbr", "size(history) AS n_points",
        "history[0] AS first_units", "history[size(history) - 1] AS last_units",
        "aggregate(transform(history, (v, i) -> v * (i + 1)), 0D, (a, v) -> a + v) AS weighted_units",
    )


def _aligned(spark: SparkSession, folder: str) -> DataFrame:
    """The ensemble on held-out steps with two stand-ins that SQL can state: the model-free
    forecast for the trees, the last known level of the series for ARIMA."""
    wanted = (*PANEL_KEY, "weekly_units", "baseline_forecast")
    rows = scoring.baseline_forecast(series_feature_rows(spark, folder)).select(*wanted)
    split = design.with_holdout(stage(rows, "holdout-rows"))
    first = stage(ensemble.number_steps(split.where("is_holdout").drop("is_holdout")), "held-steps")
    steps = first.agg(F.max("forecast_step")).first()[0] or 1
    level = split.where("NOT is_holdout").groupBy(*SERIES).agg(
        F.max_by("weekly_units", "week_start").alias("arima_forecast"),
        (F.count(F.lit(1)) >= MIN_SERIES_POINTS).alias("eligible"),
    )
    second = level.withColumn(
        "forecast_step", F.explode(F.sequence(F.lit(1), F.lit(steps)))
    )
    return ensemble.align(first.withColumnRenamed("baseline_forecast", "xgb_forecast"), second)


def ensemble_alignment(spark: SparkSession, folder: str) -> DataFrame:
    values = ["xgb_forecast", "arima_forecast", "ensemble_forecast"]
    rows = _aligned(spark, folder).select(*PANEL_KEY, "forecast_step", "eligible", *values)
    return rounded(rows, values)


def ensemble_scores(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(ensemble.member_scores(_aligned(spark, folder)), ["mape"])


def gbt_forecast(spark: SparkSession, folder: str) -> DataFrame:
    """Tree forecast of the held-out weeks, trained on earlier weeks only."""
    return _held(spark, folder).forecast


def feature_importance(spark: SparkSession, folder: str) -> DataFrame:
    return trees.feature_importance(spark, _full_model(spark, _model_inputs(spark, folder)))


def cv_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Error on each test fold after every round, all folds trained together."""
    columns = design.feature_columns(leak_free=True)
    matrix = stage(design.training_matrix(_model_inputs(spark, folder), columns), "matrix")
    return trees.fold_scores(matrix, columns)


FEW_VALUED = ("any_promo", "week_of_year", "month", "quarter", "is_holiday_season", "store_nbr")


def tree_stumps(spark: SparkSession, folder: str) -> DataFrame:
    """The first cut of a boosted fit for every input with few values."""
    rows = series_feature_rows(spark, folder).select(*PANEL_KEY, "weekly_units", *FEW_VALUED[:-1])
    cuts = trees.stumps(stage(rows, "stump-rows"), FEW_VALUED)
    return rounded(cuts, ["gain", "left_weight", "right_weight"], 4)


def top_features(spark: SparkSession, folder: str) -> DataFrame:
    return feature_importance(spark, folder).limit(10)


def score_skus(spark: SparkSession, folder: str) -> DataFrame:
    inputs = _model_inputs(spark, folder)
    scored = scoring.score_batch(inputs, _full_model(spark, inputs))
    return scoring.add_pricing_gap_signal(scored).select(
        *PANEL_KEY, "store_id", "item_id", "xgb_forecast", "pricing_recommendation"
    )


def arima_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return arima.forecast_all_skus_arima(series_feature_rows(spark, folder))


def arima_contract(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of every series' forecast, whatever the fit finds: keys, steps, eligibility, zeros."""
    report = arima.fit_report(arima.series_forecasts(series_feature_rows(spark, folder)))
    fits = F.col("eligible") | ~F.col("fitted")
    return report.select(*SERIES, "n_steps", "first_step", "last_step", "eligible", "never_negative",
                         (F.col("zero_unless_fitted") & fits).alias("zero_unless_fitted"))


def ensemble_forecast(spark: SparkSession, folder: str) -> DataFrame:
    return holdout.ensemble_forecast(_held(spark, folder))


def holdout_mape(spark: SparkSession, folder: str) -> DataFrame:
    return holdout.evaluate_holdout(_held(spark, folder))


# ---- scoring and exports ---------------------------------------------------------------------


def pricing_recommendation(spark: SparkSession, folder: str) -> DataFrame:
    return labelled(spark, folder).select(*PANEL_KEY, "pricing_recommendation")


def recommendation_summary(spark: SparkSession, folder: str) -> DataFrame:
    summary = scoring.recommendation_summary(labelled(spark, folder), "baseline_forecast")
    return rounded(summary, ["avg_forecast"])


def pricing_gaps_latest(spark: SparkSession, folder: str) -> DataFrame:
    needed = labelled(spark, folder).select(
        "store_nbr", "item_nbr", "family", "week_start", "year", "price_gap_vs_family",
        "baseline_forecast", "rolling_mean_4w", "pricing_recommendation",
    )
    path = fresh_path(spark, "scored")
    sinks.write_by_year(needed, path)
    scored = spark.read.parquet(path)
    return rounded(
        exports.export_pricing_gaps(scored, "baseline_forecast"),
        ["price_gap_vs_family", "baseline_forecast", "rolling_mean_4w", "forecast_vs_baseline_ratio"],
    )


def weekly_trend(spark: SparkSession, folder: str) -> DataFrame:
    rows = scoring.baseline_forecast(series_feature_rows(spark, folder))
    trend = exports.export_weekly_forecast_trend(rows, "baseline_forecast")
    return rounded(trend, ["total_forecast_units"])


def top_family_trend(spark: SparkSession, folder: str) -> DataFrame:
    rows = scoring.baseline_forecast(series_feature_rows(spark, folder))
    trend = stage(exports.weekly_trend(rows, "baseline_forecast"), "trend")
    return rounded(exports.top_family_trend(trend), ["total_forecast_units"])


# ---- runs ------------------------------------------------------------------------------------


def best_run(spark: SparkSession, folder: str) -> DataFrame:
    found = run_selection.best_run(star.runs(spark, folder))
    metrics = F.col("metrics")
    return found.select(
        "run_id", "model_path",
        F.round(metrics[HOLDOUT_METRIC], 6).alias("mape"),
        F.round(metrics[CV_METRIC], 6).alias("cv_mape"),
        F.col("params")[TREES_PARAM].alias("n_estimators"),
    )


def run_comparison(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(run_selection.run_comparison(star.runs(spark, folder)), ["mape", "cv_mape"])


def _raw(table: str, build: Callable, load: Callable, spark: SparkSession, folder: str) -> DataFrame:
    """A raw table written to a warehouse folder and read by its loader."""
    root = fresh_path(spark, "raw")
    build(spark, folder).write.parquet(f"{root}/{table}")
    return load(spark, readers.Warehouse(location=root))


QUERIES: dict[str, Query] = {
    "load_train": partial(_raw, "TRAIN", star.train, readers.load_train),
    "load_items": partial(_raw, "ITEMS", star.items, readers.load_items),
    "load_stores": partial(_raw, "STORES", star.stores, readers.load_stores),
    "oil_ffill": lambda spark, folder: readers.fill_forward(star.oil(spark, folder), "dcoilwtico"),
    "sink_roundtrip": sink_roundtrip,
    "clustered_layout": clustered_layout,
    "bucketed_features": bucketed_features,
    "aggregate_weekly": lambda spark, folder: rounded(
        weekly_facts(spark, folder), ["avg_daily_units"]
    ),
    "weekly_enriched": lambda spark, folder: rounded(panel(spark, folder), ["avg_daily_units"]),
    "sku_coverage": lambda spark, folder: weekly.sku_coverage(weekly_facts(spark, folder)),
    "lag_features": lag_features,
    "rolling_features": rolling_features,
    "yoy_features": yoy_features,
    "time_features": time_features,
    "promo_rate": promo_rate,
    "price_gap": price_gap,
    "features_cold_start": features_cold_start,
    "calendar_lags": calendar_lags,
    "features_refresh": features_refresh,
    "entity_ids": entity_ids,
    "training_matrix": training_matrix,
    "cv_folds": cv_folds,
    "holdout_split": holdout_split,
    "arima_eligibility": arima_eligibility,
    "log_log_features": log_log_features,
    "elasticity_ols": elasticity_ols,
    "elasticity_did": elasticity_did,
    "elasticity_combined": elasticity_combined,
    "elasticity_summary": elasticity_summary,
    "elasticity_buckets": elasticity_buckets,
    "mape_overall": mape_overall,
    "mape_by_sku": mape_by_sku,
    "mape_distribution": mape_distribution,
    "ensemble_weighted": ensemble_weighted,
    "ensemble_alignment": ensemble_alignment,
    "ensemble_scores": ensemble_scores,
    "series_history": series_history,
    "pricing_recommendation": pricing_recommendation,
    "recommendation_summary": recommendation_summary,
    "pricing_gaps_latest": pricing_gaps_latest,
    "weekly_trend": weekly_trend,
    "top_family_trend": top_family_trend,
    "best_run": best_run,
    "run_comparison": run_comparison,
    "gbt_forecast": gbt_forecast,
    "feature_importance": feature_importance,
    "cv_scores": cv_scores,
    "tree_stumps": tree_stumps,
    "top_features": top_features,
    "score_skus": score_skus,
    "arima_forecast": arima_forecast,
    "arima_contract": arima_contract,
    "ensemble_forecast": ensemble_forecast,
    "holdout_mape": holdout_mape,
}
