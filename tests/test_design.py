import math

import numpy as np
import pandas as pd
import pytest
from frames import panel, rows_of, week
from pyspark.sql import functions as F

from shelfcast.functions.quantiles import quantiles
from shelfcast.operators import design, ids

KEY = ["week_start", "store_nbr", "item_nbr"]


def keys(spark, pdf):
    return spark.createDataFrame(pdf[KEY], "week_start date, store_nbr int, item_nbr int")


def test_dense_ids_cross_blocks_and_signs(spark):
    values = [-2_000_000_000, -65_537, -1, 0, 65_535, 65_536, 65_537, 200_000, 2_000_000_000]
    rows = spark.createDataFrame([(v,) for v in values * 3] + [(None,)], "item_nbr int")
    assert rows_of(ids.dense_ids(rows, "item_nbr", "item_id").orderBy("item_nbr")) == sorted(
        ((v, i) for i, v in enumerate(values)), key=repr)


def test_ids_join_back_without_losing_rows(spark):
    rows = keys(spark, panel(n_items=5, n_weeks=3, n_stores=2, first_item=10))
    got = ids.with_entity_ids(rows)
    assert got.count() == rows.count()
    assert rows_of(got.select("item_nbr", "item_id").distinct()) == [(10 + i, i) for i in range(5)]
    assert ids.entity_ids(rows).count() == 7


@pytest.mark.parametrize("shape", [(3, 11, 2), (1, 6, 1), (5, 7, 1), (70, 2, 3)])
def test_folds_follow_the_expanding_window_rule(spark, shape):
    items, weeks, stores = shape
    pdf = panel(n_items=items, n_weeks=weeks, n_stores=stores, first_item=65_500)
    rows = keys(spark, pdf)
    got = design.with_test_fold(rows, design.fold_starts(rows)).toPandas()
    got = got.sort_values(KEY).reset_index(drop=True)
    n, size = len(got), len(got) // 6
    place = np.arange(n)
    expected = sum((place >= n - (5 - i) * size).astype(int) for i in range(5))
    np.testing.assert_array_equal(got["test_fold"], expected)
    for fold in range(1, 6):
        train, test = got[got.test_fold < fold], got[got.test_fold == fold]
        assert len(test) == size
        assert train["week_start"].max() <= test["week_start"].min()


def test_keys_at_one_heavy_week(spark):
    pdf = panel(n_items=200, n_weeks=1, n_stores=3)
    ordered = pdf.sort_values(KEY)[KEY].to_numpy().tolist()
    places = [0, 1, 199, 200, 555, 599]
    assert [list(k) for k in design.keys_at(keys(spark, pdf), places)] == [ordered[p] for p in places]


def test_too_few_rows_for_folds(spark):
    with pytest.raises(ValueError):
        design.fold_starts(keys(spark, panel(n_items=1, n_weeks=5)))


def test_holdout_starts_at_the_interpolated_quantile(spark):
    pdf = panel(n_items=3, n_weeks=23, n_stores=1)
    got = design.with_holdout(keys(spark, pdf)).toPandas()
    cutoff = pd.to_datetime(pdf["week_start"]).quantile(0.85)
    np.testing.assert_array_equal(got["is_holdout"], pd.to_datetime(got["week_start"]) >= cutoff)


def test_training_matrix_drops_incomplete_rows_and_is_strict(spark):
    df = spark.createDataFrame(
        [(week(0), 1, 1, 1.0, 5.0), (week(1), 1, 1, None, 6.0), (week(2), 1, 1, 2.0, None)],
        "week_start date, store_nbr int, item_nbr int, x double, weekly_units double",
    )
    assert design.training_matrix(df, ["x"]).count() == 1
    with pytest.raises(ValueError, match="y"):
        design.training_matrix(df, ["x", "y"])
    assert design.training_matrix(df, ["x", "y"], strict=False).columns == [*KEY, "x", "weekly_units"]


def test_leak_free_inputs_come_from_the_previous_row(spark):
    df = spark.createDataFrame(
        [(week(w), 1, 1, float(w), 10.0 * w) for w in range(3)],
        "week_start date, store_nbr int, item_nbr int, yoy_growth double, price_gap_vs_family double",
    )
    got = design.with_previous_week(df).orderBy("week_start").collect()
    assert [r["yoy_growth_prev"] for r in got] == [None, 0.0, 1.0]
    names = design.feature_columns(leak_free=True)
    assert "yoy_growth" not in names and "yoy_growth_prev" in names and len(names) == 22


def test_series_gate(spark):
    pdf = pd.concat([panel(1, 23, first_item=1), panel(1, 24, first_item=2)])
    got = design.arima_eligibility(keys(spark, pdf))
    assert rows_of(got, "item_nbr", "eligible") == [(1, False), (2, True)]


@pytest.mark.parametrize("values", [
    [1.0], [1.0, 2.0], [3.0] * 10, [0.0] * 50 + [1e9], list(np.random.default_rng(0).normal(size=501)),
    list(np.round(np.random.default_rng(1).exponential(size=400) ** 8, 3)),
])
def test_quantiles_by_narrowing_are_exact(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values] + [(None,)], "v double")
    shares = [0.0, 0.25, 0.5, 0.85, 1.0]
    assert quantiles(df, "v", shares) == pytest.approx(list(np.quantile(values, shares)), rel=1e-12)


@pytest.mark.parametrize("values, median", [
    ([1.0, 2.0, 3.0, math.nan], 2.0),
    ([1.0, 2.0, math.inf], 2.0),
    ([-math.inf, -math.inf, 5.0], -math.inf),
    ([-math.inf, math.inf, math.inf], math.inf),
    ([-1.7e308, 1.0, 1.7e308], 1.0),
])
def test_quantiles_with_values_that_are_no_plain_numbers(spark, values, median):
    assert quantiles(spark.createDataFrame([(v,) for v in values], "v double"), "v", [0.5]) == [median]


def test_quantiles_of_nothing(spark):
    assert quantiles(spark.createDataFrame([(None,)], "v double"), "v", [0.5]) == [None]
