"""Raw tables of the warehouse, read by name in any format Spark can load."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from itertools import pairwise
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast import schemas

FILE_FORMATS = ("parquet", "orc", "csv", "json", "avro", "text", "delta")


@dataclass(frozen=True)
class Split:
    """A connector's table read in ranges of ``column`` (numbers, dates or timestamps), each by a connection of its own.

    ``parts`` ranges of equal width lie between ``low`` and ``high``, which one aggregation looks up
    where they are not given. They decide the size of ranges only: the first has all that is smaller,
    the last all that is larger, and NULLs have a range of their own.
    """

    column: str
    parts: int
    low: Any = None
    high: Any = None

    def read(self, load: Callable[[], DataFrame]) -> DataFrame:
        """The rows of ``load()``, which is called for every range: some connectors keep what was pushed
        to a scan with the loaded table, and ranges that share it would get each other's filters."""
        table = load()
        kind = table.schema[self.column].dataType
        if not isinstance(kind, T.NumericType | T.DateType | T.TimestampType | T.TimestampNTZType):
            raise ValueError(f"no ranges of {self.column}: {kind.simpleString()}")
        low, high = self.low, self.high
        if low is None or high is None:
            ends = table.agg(F.min(self.column), F.max(self.column)).first()
            low, high = (own if own is not None else found for own, found in zip((low, high), ends))
        if low is None or high is None:  # no rows, or NULLs only
            return load()
        inner = {low + (high - low) * n // self.parts for n in range(1, self.parts)} - {low}
        place = F.col(self.column)
        # Plain comparisons with literals, which connectors push down.
        ranges = [load().where(place.isNull())] if table.schema[self.column].nullable else []
        for start, end in pairwise([None, *sorted(inner), None]):
            rows = load().where(place.isNotNull()) if start is None and end is None else load()
            rows = rows if start is None else rows.where(place >= F.lit(start))
            ranges.append(rows if end is None else rows.where(place < F.lit(end)))
        return reduce(DataFrame.unionAll, ranges)


@dataclass(frozen=True)
class Warehouse:
    """Where raw tables live: a folder of files, or a connector that takes ``dbtable``.

    ``own_options`` adds options for single tables. ``splits`` names the tables that a connector reads in
    ranges; files are split by Spark itself.
    """

    fmt: str = "parquet"
    location: str = ""
    options: dict[str, str] = field(default_factory=dict)
    own_options: dict[str, dict[str, str]] = field(default_factory=dict)
    splits: dict[str, Split] = field(default_factory=dict)

    def table(self, spark: SparkSession, name: str) -> DataFrame:
        reader = spark.read.format(self.fmt).options(**self.options | self.own_options.get(name, {}))
        if self.fmt not in FILE_FORMATS:
            named = reader.option("dbtable", name)
            return self.splits[name].read(named.load) if name in self.splits else named.load()
        if self.fmt in ("csv", "json") and name.upper() in schemas.RAW:
            reader = reader.schema(schemas.RAW[name.upper()])
        return reader.load(f"{self.location}/{name}")


def week_of(day: Column) -> Column:
    """Monday of the day's week, as a date; no time zone is involved."""
    return F.date_sub(day, F.weekday(day))


def clean_sales(raw: DataFrame) -> DataFrame:
    """Typed date, returns (and missing sales) clamped to zero, week attached."""
    typed = raw.withColumns(
        {"date": F.to_date("date"), "unit_sales": F.greatest("unit_sales", F.lit(0.0))}
    )
    return typed.withColumn("week_start", week_of(F.col("date")))


def fill_forward(daily: DataFrame, value: str, day: str = "date") -> DataFrame:
    """Last known value carried over later days; days before the first value stay NULL.

    Filled inside each year, plus one carried value per year. No task sees more than one
    year of days, and the only unpartitioned window runs over one row per year.
    """
    dated = daily.withColumn("_year", F.year(day))
    in_year = Window.partitionBy("_year").orderBy(day)
    closing = dated.groupBy(F.col("_year").alias("_closing_year")).agg(
        F.max_by(value, F.when(F.col(value).isNotNull(), F.col(day))).alias("_closing")
    )
    carried = closing.select(
        "_closing_year",
        F.last("_closing", ignorenulls=True)
        .over(Window.orderBy("_closing_year").rowsBetween(Window.unboundedPreceding, -1))
        .alias("_carried"),
    )
    return (
        dated.withColumn("_known", F.last(value, ignorenulls=True).over(in_year))
        .join(carried, F.col("_year").eqNullSafe(F.col("_closing_year")), "left")
        .withColumn(value, F.coalesce("_known", "_carried"))
        .select(*daily.columns)
    )


def load_train(spark: SparkSession, source: Warehouse) -> DataFrame:
    return clean_sales(source.table(spark, "TRAIN"))


def load_items(spark: SparkSession, source: Warehouse) -> DataFrame:
    return source.table(spark, "ITEMS")


def load_stores(spark: SparkSession, source: Warehouse) -> DataFrame:
    return source.table(spark, "STORES")


def load_oil(spark: SparkSession, source: Warehouse) -> DataFrame:
    raw = source.table(spark, "OIL").withColumn("date", F.to_date("date"))
    return fill_forward(raw, "dcoilwtico")


def load_holidays(spark: SparkSession, source: Warehouse) -> DataFrame:
    return source.table(spark, "HOLIDAYS_EVENTS").withColumn("date", F.to_date("date"))


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The parquet table at ``path``, or an empty one of the same schema if it is absent."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
