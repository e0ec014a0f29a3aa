"""The raw retail tables derived from the star-schema test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.constants import CV_METRIC, EXPERIMENT, HOLDOUT_METRIC, TREES_PARAM


def _scan(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def _brand_number() -> F.Column:
    return F.substring("p_brand", 7, 9).cast("int")


def train(spark: SparkSession, folder: str) -> DataFrame:
    """Daily sales: each line item is one sale of its brand in its supplier's region."""
    brand_of_part = _scan(spark, folder, "part").select(
        F.col("p_partkey").alias("l_partkey"), _brand_number().alias("item_nbr")
    )
    region_of_nation = _scan(spark, folder, "nation").select(
        F.col("n_nationkey").alias("s_nationkey"), (F.col("n_regionkey") + 1).alias("store_nbr")
    )
    store_of_supplier = (
        _scan(spark, folder, "supplier")
        .select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
        .join(region_of_nation, "s_nationkey")
        .select("l_suppkey", "store_nbr")
    )
    quantity = F.col("l_quantity")
    return (
        _scan(spark, folder, "lineitem")
        .join(brand_of_part, "l_partkey")
        .join(store_of_supplier, "l_suppkey")
        .select(
            F.to_date("l_shipdate").alias("date"),
            "store_nbr",
            "item_nbr",
            F.when(F.col("l_returnflag") == "R", -quantity).otherwise(quantity).alias("unit_sales"),
            (F.col("l_discount") >= 0.095).alias("onpromotion"),
        )
    )


def items(spark: SparkSession, folder: str) -> DataFrame:
    brands = _scan(spark, folder, "part").select(_brand_number().alias("item_nbr")).distinct()
    return brands.select(
        "item_nbr",
        F.concat(F.lit("FAM_"), (F.col("item_nbr") % 5).cast("string")).alias("family"),
        (F.col("item_nbr") % 7).alias("class"),
        (F.col("item_nbr") % 2 == 0).alias("perishable"),
    )


def stores(spark: SparkSession, folder: str) -> DataFrame:
    return _scan(spark, folder, "region").select(
        (F.col("r_regionkey") + 1).alias("store_nbr"),
        F.col("r_name").alias("city"),
        F.col("r_name").alias("state"),
        F.substring("r_name", 1, 1).alias("type"),
        (F.col("r_regionkey") % 2).alias("cluster"),
    )


def oil(spark: SparkSession, folder: str) -> DataFrame:
    """One row per day; weekends have no quote."""
    daily = (
        _scan(spark, folder, "orders")
        .groupBy(F.to_date("o_orderdate").alias("date"))
        .agg((F.max("o_totalprice") / 1000).alias("dcoilwtico"))
    )
    return daily.withColumn(
        "dcoilwtico", F.when(F.weekday("date") < 5, F.col("dcoilwtico"))
    )


def runs(spark: SparkSession, folder: str) -> DataFrame:
    """A run log with one run per event."""
    return _scan(spark, folder, "events").select(
        F.col("event_id").cast("string").alias("run_id"),
        F.lit(EXPERIMENT).alias("experiment"),
        F.lit("ensemble").alias("run_name"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.create_map(F.lit(TREES_PARAM), F.lit("500")).alias("params"),
        F.create_map(
            F.lit(HOLDOUT_METRIC), F.col("value") / 1000, F.lit(CV_METRIC), F.col("value") / 1200
        ).alias("metrics"),
        F.concat(F.lit("models/"), F.col("event_id").cast("string")).alias("model_path"),
    )
