"""Calendar frames and the refresh of changed weeks."""

import pytest
from frames import panel, rows_of, week
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import features, refresh
from shelfcast.sources.sinks import write_by_year
from shelfcast.sources.staging import stage

COLUMNS = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schemas.WEEKLY)


def test_a_missing_week_moves_no_other(spark):
    rows = [(week(w), 1, 1, float(10 * w)) for w in range(12) if w != 5]
    df = spark.createDataFrame(rows, "week_start date, store_nbr int, item_nbr int, weekly_units double")
    got = {r["week_start"]: r for r in features.add_calendar_features(df, (1, 4), (4,)).collect()}
    assert got[week(6)]["units_1w_ago"] is None and got[week(6)]["units_4w_ago"] == 20.0
    assert got[week(9)]["units_4w_ago"] is None and got[week(9)]["calendar_mean_4w"] == pytest.approx(70.0)
    assert got[week(9)]["weeks_seen_4w"] == 3 and got[week(0)]["weeks_seen_4w"] == 0
    assert got[week(0)]["calendar_max_4w"] is None and got[week(1)]["calendar_std_4w"] is None
    by_row = {r["week_start"]: r for r in features.add_lag_features(df, (4,)).collect()}
    assert by_row[week(9)]["units_lag_4w"] == 40.0  # rows count the missing week away


@pytest.fixture(scope="module")
def weekly(spark):
    return stage(spark.createDataFrame(panel(n_items=5, n_weeks=130, n_stores=2), COLUMNS), "weekly")


def refreshed(spark, weekly, before, changed, path):
    write_by_year(features.feature_table(stage(before, "before"), stage), path)
    written = refresh.refresh_features(weekly, path, changed, stage)
    return written, spark.read.parquet(path).select(*schemas.FEATURES.fieldNames())


def rounded(df):
    return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@pytest.mark.parametrize("case", ["new weeks", "corrections", "a new series", "nothing"])
def test_refresh_equals_a_full_build(spark, weekly, tmp_path, case):
    pick = {
        "new weeks": F.col("week_start") >= F.lit(week(127)),
        "corrections": (F.col("week_start") == F.lit(week(60))) & (F.col("item_nbr") == 2),
        "a new series": (F.col("item_nbr") == 5) & (F.col("store_nbr") == 2),
        "nothing": F.lit(False),
    }[case]
    if case == "corrections":
        before = weekly.withColumn("weekly_units", F.when(pick, 999.0).otherwise(F.col("weekly_units")))
    else:
        before = weekly.where(~pick)
    written, got = refreshed(spark, weekly, before, weekly.where(pick), f"{tmp_path}/features")
    want = features.feature_table(weekly, stage)
    assert rows_of(rounded(got)) == rows_of(rounded(want))
    assert (written > 0) == (case != "nothing")


def test_years_without_a_change_are_not_written(spark, weekly, tmp_path):
    path = tmp_path / "features"
    late = F.col("week_start") >= F.lit(week(128))
    write_by_year(features.feature_table(stage(weekly.where(~late), "before"), stage), str(path))
    files = {p: p.stat().st_mtime_ns for p in path.glob("year=*/*.parquet")}
    written = refresh.refresh_features(weekly, str(path), weekly.where(late), stage)
    last = weekly.where(late).selectExpr("max(year(week_start))").first()[0]
    for p, stamp in files.items():
        assert p.exists() == (p.parent.name != f"year={last}") and (not p.exists() or p.stat().st_mtime_ns == stamp)
    assert written == spark.read.parquet(str(path)).where(f"year = {last}").count()
