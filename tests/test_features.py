from datetime import date

import numpy as np
import pandas as pd
import pytest
from frames import panel, rows_of, week
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import features


@pytest.fixture(scope="module")
def weekly(spark):
    pdf = panel(n_items=4, n_weeks=70, n_stores=2)
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.WEEKLY)
    return spark.createDataFrame(pdf, columns).cache()


def test_schema_and_cold_start(spark, weekly):
    table = features.feature_table(weekly)
    assert schemas.same_fields(table.schema, schemas.FEATURES)
    assert table.count() == 8 * (70 - 52)
    assert table.where("units_lag_52w IS NULL").count() == 0


def test_features_match_pandas(weekly):
    got = features.series_features(weekly).toPandas()
    got = got.sort_values(["store_nbr", "item_nbr", "week_start"]).reset_index(drop=True)
    by = got.groupby(["store_nbr", "item_nbr"])["weekly_units"]
    for n in (1, 2, 4, 8, 12, 26, 52):
        np.testing.assert_array_equal(got[f"units_lag_{n}w"], by.shift(n))
    for n in (4, 12, 26):
        past = by.shift(1).groupby([got.store_nbr, got.item_nbr]).rolling(n, min_periods=1)
        np.testing.assert_allclose(got[f"rolling_mean_{n}w"], past.mean().to_numpy())
        np.testing.assert_allclose(got[f"rolling_max_{n}w"], past.max().to_numpy())
        np.testing.assert_allclose(got[f"rolling_std_{n}w"], past.std().to_numpy(), atol=1e-9)


def test_features_never_look_ahead(spark, weekly):
    cut = week(60)
    changed = weekly.withColumn(
        "weekly_units", F.when(F.col("week_start") >= F.lit(cut), 999.0).otherwise(F.col("weekly_units"))
    )
    past = F.col("week_start") < F.lit(cut)
    before = rows_of(features.series_features(weekly).where(past))
    assert rows_of(features.series_features(changed).where(past)) == before
    own_week = F.col("week_start") == F.lit(cut)
    seen = [c for c in features.series_features(weekly).columns
            if c.startswith(("units_lag", "rolling", "promo_rate"))]
    assert rows_of(features.series_features(changed).where(own_week), *seen) == rows_of(
        features.series_features(weekly).where(own_week), *seen
    )


def test_one_shuffle_and_one_sort_for_all_series_features(spark, weekly):
    plan = features.series_features(weekly)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("Sort [") == 1
    assert plan.count("Window [") == 1


def test_growth_needs_a_positive_base(spark):
    rows = spark.createDataFrame(
        [(week(w), 1, 1, float(v)) for w, v in enumerate([0, 10] + [1] * 50 + [5, 5])],
        "week_start date, store_nbr int, item_nbr int, weekly_units double",
    )
    got = {r["week_start"]: r["yoy_growth"] for r in features.add_yoy_features(rows).collect()}
    assert got[week(52)] is None and got[week(53)] == -0.5 and got[week(0)] is None


def test_iso_week_53_is_not_holiday_season(spark):
    rows = spark.createDataFrame(
        [(date(2020, 12, 28),), (date(2020, 12, 21),), (date(2021, 1, 4),), (date(2021, 1, 11),),
         (date(2020, 11, 23),)], "week_start date",
    )
    got = {r["week_of_year"]: r["is_holiday_season"] for r in features.add_time_features(rows).collect()}
    assert got == {53: 0, 52: 1, 1: 1, 2: 0, 48: 1}


def test_family_median_equals_the_window_form(spark, weekly):
    grouped = features.add_price_gap_features(weekly)
    window = weekly.withColumn("family_median_units", F.percentile_approx("weekly_units", 0.5).over(
        Window.partitionBy("family", "week_start")))
    key = ("week_start", "store_nbr", "item_nbr", "family_median_units")
    assert rows_of(grouped, *key) == rows_of(window, *key)
    assert grouped.count() == weekly.count()


def test_gap_is_zero_without_units_and_works_without_a_family(spark):
    rows = spark.createDataFrame(
        [(week(0), 1, 1, None, 4.0), (week(0), 1, 2, None, 2.0), (week(0), 1, 3, None, 0.0),
         (week(0), 1, 4, "F", 0.0)],
        "week_start date, store_nbr int, item_nbr int, family string, weekly_units double",
    )
    got = {r["item_nbr"]: r for r in features.add_price_gap_features(rows).collect()}
    assert got[1]["family_median_units"] == 2.0
    assert got[1]["price_gap_vs_family"] == pytest.approx(np.log(2))
    assert got[3]["price_gap_vs_family"] == 0.0 and got[4]["price_gap_vs_family"] == 0.0


def test_lags_count_rows_not_weeks(spark):
    rows = spark.createDataFrame(
        pd.DataFrame({"week_start": [week(0), week(5)], "store_nbr": [1, 1], "item_nbr": [1, 1],
                      "weekly_units": [3.0, 4.0]}))
    got = features.add_lag_features(rows, (1,)).where(F.col("units_lag_1w").isNotNull())
    assert rows_of(got, "units_lag_1w") == [(3.0,)]
