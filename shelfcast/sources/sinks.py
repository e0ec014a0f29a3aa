"""Writers. Row counts come from the write itself, not from a second job."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    fmt: str = "parquet",
    partition_by: tuple[str, ...] = (),
    **options: str,
) -> int:
    """Write and return the number of rows written."""
    seen = Observation()
    observed = df.observe(seen, F.count(F.lit(1)).alias("rows"))
    writer = observed.write.format(fmt).mode(mode).options(**options)
    writer.partitionBy(*partition_by).save(path)
    return seen.get["rows"]


def write_by_year(
    df: DataFrame, path: str, fmt: str = "parquet", keep_other_years: bool = False
) -> int:
    """Overwrite a table partitioned by ``year``: all of it, or only the years in ``df``.

    The rebalance hint gathers a year into few files but lets adaptive execution split a year
    that is too large for one task.
    """
    return write_table(
        df.hint("rebalance", "year"), path, fmt=fmt, partition_by=("year",),
        partitionOverwriteMode="dynamic" if keep_other_years else "static",
    )


def write_clustered(df: DataFrame, path: str, keys: tuple[str, ...], fmt: str = "parquet") -> int:
    """Range-partition and sort by ``keys`` so that file statistics prune scans on them.

    The range bounds come from a sample, so a heavy key range gets more partitions. Rows that
    share the whole key are spread by a hash of the row, which is stable under task retries.
    """
    salted = df.withColumn("_salt", F.xxhash64(*df.columns))
    laid_out = salted.repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys)
    return write_table(laid_out.drop("_salt"), path, fmt=fmt)


LAYOUT = "buckets int, keys array<string>, sorted_by array<string>, ddl string"


def write_bucketed(
    df: DataFrame, path: str, keys: Sequence[str], order: Sequence[str], buckets: int | None = None
) -> int:
    """Write ``df`` in buckets by ``keys``, sorted by ``keys`` and ``order`` inside, and return its number of rows.

    Rows are dealt by the hash that names the bucket, so a bucket is one file. ``read_bucketed`` gives the
    table back with its layout: a window or join by ``keys`` then needs no shuffle. The layout is kept
    beside the table, in ``<path>_layout``. By default there are as many buckets as a shuffle has partitions.
    """
    spark = df.sparkSession
    count = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = _table_name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    seen = Observation()
    laid_out = df.observe(seen, F.count(F.lit(1)).alias("rows")).repartition(count, *keys)
    writer = laid_out.write.mode("overwrite").format("parquet").option("path", path)
    writer.bucketBy(count, *keys).sortBy(*keys, *order).saveAsTable(name)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    layout = spark.createDataFrame([(count, list(keys), [*keys, *order], ddl)], LAYOUT)
    layout.coalesce(1).write.mode("overwrite").parquet(f"{path}_layout")
    return seen.get["rows"]


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table of ``write_bucketed``, named in this session's catalog if it is not yet."""
    name = _table_name(path)
    if not spark.catalog.tableExists(name):
        layout = spark.read.parquet(f"{path}_layout").first()
        keys, order = (", ".join(f"`{c}`" for c in layout[part]) for part in ("keys", "sorted_by"))
        spark.sql(
            f"CREATE TABLE {name} ({layout['ddl']}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({order}) "
            f"INTO {layout['buckets']} BUCKETS LOCATION '{path}'"
        )
    return spark.table(name)


def _table_name(path: str) -> str:
    return "bucketed_" + hashlib.sha256(path.encode()).hexdigest()[:16]


def write_small_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for tables of a few rows such as feature importances."""
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
