from datetime import date

import pytest
from frames import rows_of
from pyspark.sql import functions as F

from shelfcast import schemas
from shelfcast.operators import features
from shelfcast.sources import readers, sinks, staging
from shelfcast.sources.readers import Warehouse, clean_sales, fill_forward, read_or_empty


def sales(spark, rows):
    return spark.createDataFrame(
        rows, "date string, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean"
    )


def test_returns_and_missing_sales_become_zero(spark):
    raw = sales(spark, [("2020-01-05", 1, 1, -3.0, True), ("2020-01-06", 1, 1, None, None),
                        ("2020-01-07", 1, 1, 2.5, False)])
    assert rows_of(clean_sales(raw), "date", "unit_sales", "week_start") == [
        (date(2020, 1, 5), 0.0, date(2019, 12, 30)),
        (date(2020, 1, 6), 0.0, date(2020, 1, 6)),
        (date(2020, 1, 7), 2.5, date(2020, 1, 6)),
    ]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Pacific/Auckland"])
def test_week_does_not_depend_on_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        days = spark.sql("SELECT explode(sequence(date'2018-10-28', date'2018-11-12')) AS date")
        got = rows_of(days.select("date", readers.week_of(F.col("date"))))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert all(monday.weekday() == 0 and 0 <= (day - monday).days < 7 for day, monday in got)


def test_forward_fill_crosses_years_and_keeps_leading_nulls(spark):
    days = [
        (date(2018, 12, 30), None), (date(2018, 12, 31), 5.0), (date(2019, 1, 1), None),
        (date(2019, 6, 1), None), (date(2020, 1, 1), None), (date(2020, 1, 2), 7.0),
        (date(2021, 1, 1), None),
    ]
    filled = fill_forward(spark.createDataFrame(days, schemas.OIL), "dcoilwtico")
    assert [v for _, v in rows_of(filled)] == [None, 5.0, 5.0, 5.0, 5.0, 7.0, 7.0]
    assert schemas.same_fields(filled.schema, schemas.OIL)


def test_tables_load_from_csv_and_parquet(spark, tmp_path):
    items = spark.createDataFrame([(1, "FAM_1", 2, True)], schemas.ITEMS)
    items.write.parquet(f"{tmp_path}/p/ITEMS")
    items.write.option("header", True).csv(f"{tmp_path}/c/ITEMS")
    holidays = spark.createDataFrame(
        [(date(2020, 1, 1), "Holiday", "National", "X", "New Year", False)],
        schemas.HOLIDAYS_EVENTS,
    )
    holidays.write.parquet(f"{tmp_path}/p/HOLIDAYS_EVENTS")
    parquet = Warehouse(location=f"{tmp_path}/p")
    csv = Warehouse("csv", f"{tmp_path}/c", {"header": "true"})
    assert rows_of(readers.load_items(spark, parquet)) == [(1, "FAM_1", 2, True)]
    assert rows_of(readers.load_items(spark, csv)) == [(1, "FAM_1", 2, True)]
    assert readers.load_holidays(spark, parquet).count() == 1


def test_missing_table_is_empty_with_its_schema(spark, tmp_path):
    empty = read_or_empty(spark, f"{tmp_path}/none", schemas.ELASTICITY)
    assert empty.count() == 0
    assert schemas.same_fields(empty.schema, schemas.ELASTICITY)


def test_write_reports_rows_and_overwrites(spark, tmp_path):
    path = f"{tmp_path}/t"
    assert sinks.write_table(spark.range(5), path) == 5
    assert sinks.write_table(spark.range(3), path) == 3
    assert spark.read.parquet(path).count() == 3


def test_year_partitions_are_replaced_one_by_one_or_all_at_once(spark, tmp_path):
    path = f"{tmp_path}/y"
    rows = spark.createDataFrame([(2019, 1), (2019, 2), (2020, 3)], "year int, v int")
    assert sinks.write_by_year(rows, path) == 3
    newer = rows.where("year = 2020").withColumn("v", F.lit(9))
    assert sinks.write_by_year(newer, path, keep_other_years=True) == 1
    assert rows_of(spark.read.parquet(path), "year", "v") == [(2019, 1), (2019, 2), (2020, 9)]
    assert sinks.write_by_year(newer, path) == 1
    assert rows_of(spark.read.parquet(path), "year", "v") == [(2020, 9)]


def test_clustered_files_cover_narrow_key_ranges(spark, tmp_path):
    path = f"{tmp_path}/k"
    rows = spark.range(20_000).select(
        F.expr("date_add(date'2020-01-01', int(id % 200))").alias("date"),
        (F.col("id") % 7).cast("int").alias("store_nbr"),
    )
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merge, "false")  # the table is so small that it would become one file
    try:
        assert sinks.write_clustered(rows, path, ("date", "store_nbr")) == 20_000
    finally:
        spark.conf.set(merge, "true")
    files = spark.read.parquet(path).groupBy(F.input_file_name()).agg(
        F.min("date").alias("lo"), F.max("date").alias("hi")
    ).orderBy("lo").collect()
    assert len(files) > 1
    assert all(a["hi"] <= b["lo"] for a, b in zip(files, files[1:]))


def test_small_csv_has_a_header(spark, tmp_path):
    sinks.write_small_csv(spark.createDataFrame([("a", 1.0)], schemas.IMPORTANCE), f"{tmp_path}/f")
    assert spark.read.option("header", True).csv(f"{tmp_path}/f").columns == ["feature", "importance"]


def test_staged_table_lives_in_the_checkpoint_folder(spark):
    staged = staging.stage(spark.range(10), "ids")
    assert staged.count() == 10
    root = staging.staging_root(spark)
    assert all(root in f for f in staged.inputFiles())


def _exchanges_under_windows(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return plan[plan.index("Window") :].count("Exchange")


def test_a_bucketed_table_needs_no_shuffle_for_its_series(spark, tmp_path):
    rows = spark.range(600).selectExpr(
        "date_add(date'2018-01-01', int(7 * (id % 60))) AS week_start", "int(id / 300) AS store_nbr",
        "int((id / 60) % 5) AS item_nbr", "double(id % 37) AS weekly_units",
    )
    path = f"{tmp_path}/series"
    assert sinks.write_bucketed(rows, path, ("store_nbr", "item_nbr"), ("week_start",), 3) == 600
    back = sinks.read_bucketed(spark, path)
    assert rows_of(back) == rows_of(rows)
    windowed = features.add_rolling_features(features.add_lag_features(back))
    assert _exchanges_under_windows(windowed) == 0
    assert _exchanges_under_windows(features.add_lag_features(rows)) > 0
    assert rows_of(windowed) == rows_of(features.add_rolling_features(features.add_lag_features(rows)))
    # Another session knows the path alone.
    spark.sql(f"DROP TABLE {sinks._table_name(path)}")
    again = features.add_lag_features(sinks.read_bucketed(spark, path))
    assert _exchanges_under_windows(again) == 0 and again.count() == 600
    # Written anew with other rows and buckets.
    assert sinks.write_bucketed(rows.where("item_nbr > 1"), path, ("store_nbr", "item_nbr"), ("week_start",), 2) == 360
    assert sinks.read_bucketed(spark, path).count() == 360
    assert len(list((tmp_path / "series").glob("*.parquet"))) <= 2
