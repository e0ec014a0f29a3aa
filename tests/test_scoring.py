from datetime import date

import pytest
from frames import rows_of, week
from pyspark.sql import functions as F

from shelfcast.constants import ARIMA_WEIGHT, TREE_WEIGHT
from shelfcast.functions import labels
from shelfcast.operators import ensemble, exports, scoring


def pairs_frame(spark, pairs):
    return spark.createDataFrame([(1, *map(float, p)) for p in pairs], "item_nbr int, y double, p double")


def test_zero_actuals_are_left_out_of_the_error(spark):
    df = pairs_frame(spark, [(0, 50), (100, 110), (200, 190)])
    assert df.agg(ensemble.mape("y", "p")).first()[0] == pytest.approx(0.075)
    assert rows_of(ensemble.mape_overall(df, "y", "p")) == [(pytest.approx(0.075), 2)]


def test_perfect_forecast_has_no_error(spark):
    df = pairs_frame(spark, [(100, 100), (200, 200), (300, 300)])
    assert df.agg(ensemble.mape("y", "p")).first()[0] == 0.0


def test_error_is_missing_without_positive_actuals(spark):
    df = pairs_frame(spark, [(0, 10), (0, 20)])
    assert df.agg(ensemble.mape("y", "p")).first()[0] is None
    assert rows_of(ensemble.mape_by_sku(df, "y", "p")) == [(1, None, 0)]


def test_ensemble_is_the_weighted_average(spark):
    df = pairs_frame(spark, [(100, 90), (200, 210), (150, 140)])
    got = sorted(r[0] for r in df.select(ensemble.ensemble(F.col("y"), F.col("p"))).collect())
    assert got == pytest.approx(sorted(0.65 * a + 0.35 * b for a, b in [(100, 90), (200, 210), (150, 140)]))
    assert TREE_WEIGHT + ARIMA_WEIGHT == pytest.approx(1.0)


def test_members_are_aligned_by_step(spark):
    tree = ensemble.number_steps(spark.createDataFrame(
        [(week(9), 1, 1, 10.0, 8.0), (week(5), 1, 1, 10.0, 12.0), (week(5), 1, 2, 10.0, 1.0)],
        "week_start date, store_nbr int, item_nbr int, weekly_units double, xgb_forecast double"))
    arima = spark.createDataFrame(
        [(1, 1, 1, 5.0, True), (1, 1, 2, 6.0, True), (1, 1, 3, 7.0, True)],
        "store_nbr int, item_nbr int, forecast_step int, arima_forecast double, eligible boolean")
    got = ensemble.align(tree, arima)
    # Series (1, 2) starts after the cutoff: it keeps its row, with a zero second member.
    assert rows_of(got, "week_start", "item_nbr", "forecast_step", "arima_forecast", "eligible") == [
        (week(5), 1, 1, 5.0, True), (week(5), 2, 1, 0.0, False), (week(9), 1, 2, 6.0, True)]
    assert {r["n_zero_series"] for r in ensemble.member_scores(got).collect()} == {1}
    scores = ensemble.member_scores(got.where("eligible"))
    assert {r["member"]: r["mape"] for r in scores.collect()} == {
        "xgb_forecast": pytest.approx(0.2),
        "arima_forecast": pytest.approx(0.45),
        "ensemble_forecast": pytest.approx((abs(10 - 9.55) + abs(10 - 7.3)) / 20),
    }


@pytest.mark.parametrize("gap, forecast, baseline, label", [
    (0.16, 84.0, 100.0, "OVERPRICED"), (0.15, 84.0, 100.0, "MARKET_RATE"),
    (0.16, 85.0, 100.0, "MARKET_RATE"), (-0.16, 111.0, 100.0, "UNDERPRICED"),
    (-0.15, 111.0, 100.0, "MARKET_RATE"), (-0.16, 109.0, 100.0, "MARKET_RATE"),
    (None, 1.0, 100.0, "MARKET_RATE"), (0.5, None, 100.0, "MARKET_RATE"),
    (0.5, 1.0, None, "MARKET_RATE"),
])
def test_recommendation_rule(spark, gap, forecast, baseline, label):
    df = spark.createDataFrame(
        [(gap, forecast, baseline)],
        "price_gap_vs_family double, xgb_forecast double, rolling_mean_4w double")
    assert scoring.add_pricing_gap_signal(df).first()["pricing_recommendation"] == label


@pytest.mark.parametrize("top, bottom, expected", [(6.0, 4.0, 1.5), (6.0, 0.0, 1.0), (6.0, None, 1.0)])
def test_ratio_falls_back_to_one(spark, top, bottom, expected):
    df = spark.createDataFrame([(top, bottom)], "a double, b double")
    assert df.select(labels.ratio_or(F.col("a"), F.col("b"))).first()[0] == expected


SCORED = (
    "week_start date, year int, store_nbr int, item_nbr int, family string, weekly_units double, "
    "xgb_forecast double, rolling_mean_4w double, price_gap_vs_family double, pricing_recommendation string"
)


@pytest.fixture(scope="module")
def scored(spark):
    rows = [
        (week(w), 2018, s, i, f"F{i}", float(10 * i + w), float(10 * i), 10.0, 0.2,
         "OVERPRICED" if i == 1 else "MARKET_RATE")
        for w in range(3) for s in (1, 2) for i in range(1, 8)
    ]
    return spark.createDataFrame(rows, SCORED)


def test_latest_week_export(scored):
    got = exports.export_pricing_gaps(scored)
    assert got.count() == 14
    assert rows_of(got.select("week_start").distinct()) == [(week(2),)]
    assert rows_of(got.where("item_nbr = 1 AND store_nbr = 1"), "forecast_vs_baseline_ratio", "colour") == [
        (1.0, "#E63946")]


def test_trend_and_top_families(scored):
    trend = exports.export_weekly_forecast_trend(scored)
    assert trend.first().asDict() == {
        "week_start": date(2018, 1, 1), "family": "F1", "total_forecast_units": 20.0,
        "total_actual_units": 20.0, "n_skus": 1}
    top = exports.top_family_trend(trend).collect()
    assert [r["family"] for r in top] == [f"F{i}" for i in range(3, 8) for _ in range(3)]


def test_top_families_break_ties_by_name(spark):
    trend = spark.createDataFrame(
        [(week(0), f"F{i}", 1.0, 5.0, 1) for i in range(9)],
        "week_start date, family string, total_forecast_units double, total_actual_units double, n_skus int")
    assert [r["family"] for r in exports.top_family_trend(trend).collect()] == ["F0", "F1", "F2", "F3", "F4"]


def test_recommendation_summary(scored):
    assert rows_of(scoring.recommendation_summary(scored)) == [
        ("MARKET_RATE", 36, 45.0), ("OVERPRICED", 6, 10.0)]
