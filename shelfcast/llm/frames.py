"""Helpers that the corpus operators share: staged tables, global order, worker memory."""

from __future__ import annotations

import sys
import types
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.sources.staging import fresh_path

PART_BITS = 33  # monotonically_increasing_id(): partition number above, place below
WORD = r"[^\x20\x09-\x0D]+"


class Staged:
    """A table written to the shared folder; ``rows`` scans it. ``drop`` deletes the files once
    everything that needs them has been written itself."""

    def __init__(self, df: DataFrame, label: str):
        self.spark = df.sparkSession
        self.path = fresh_path(self.spark, label)
        df.write.option("compression", "zstd").parquet(self.path)
        self.rows = self.spark.read.schema(df.schema).parquet(self.path)

    def drop(self) -> None:
        context = self.spark.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def text_or_empty(text: str = "text") -> Column:
    return F.coalesce(F.col(text), F.lit(""))


def text_marks(text: str = "text") -> list[Column]:
    """128 bits of a whole text, as ``h0`` and ``h1``; with the key they name a row and its repetitions."""
    body = text_or_empty(text)
    return [F.xxhash64(body).alias("h0"), F.xxhash64(F.lit(1), body).alias("h1")]


def same_row(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """Key (which may be null) and text marks are the same."""
    return left[0].eqNullSafe(right[0]) & (left[1] == right[1]) & (left[2] == right[2])


def running(df: DataFrame, order: Sequence[Column | str], total: str | None = None) -> DataFrame:
    """``df`` with ``row_number`` from 0 over all rows in ``order`` and, if ``total`` names a
    column, ``before``: its sum over all earlier rows.

    The rows are range-partitioned and sorted once and written with their place; only one row
    per partition is then summed up in one task. Ties are broken by the place in the input, so a
    key that holds most rows is spread over partitions like any other.
    """
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    placed = (
        tied.repartitionByRange(*order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        .withColumn("_at", F.monotonically_increasing_id())
    )
    rows = Staged(placed, "ordered").rows
    part = F.shiftright("_at", PART_BITS)
    summed = F.col(total) if total else F.lit(0).cast("long")
    sizes = rows.groupBy(part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_rows"), F.sum(summed).alias("_sum")
    )
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_rows"),
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_sum"),
    )
    # One row per range partition: bounded by the number of partitions.
    numbered = rows.withColumn("_part", part).join(F.broadcast(offsets), "_part")
    out = numbered.withColumn(
        "row_number", F.col("_rows") + F.col("_at").bitwiseAND(F.lit((1 << PART_BITS) - 1))
    )
    if total:
        inside = (
            Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
        )
        out = out.withColumn(
            "before", F.col("_sum") + F.coalesce(F.sum(total).over(inside), F.lit(0))
        )
    return out.drop("_part", "_rows", "_sum", "_at")


def spread(df: DataFrame, *columns: Column | str) -> DataFrame:
    """``df`` dealt out by ``columns`` to as many partitions as shuffles have, which adaptive
    execution leaves apart: for few bytes that make much work."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *columns)


def worker_memory() -> dict:
    """A dict that lives as long as the Python worker, also when functions travel by value."""
    name = "_shelfcast_worker_memory"
    if name not in sys.modules:
        sys.modules[name] = types.ModuleType(name)
    return sys.modules[name].__dict__
