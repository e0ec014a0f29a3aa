"""Ranges of a connector's table: a connector with one connection a scan, written here, that takes filters."""

import sys
import uuid
from datetime import date, datetime, timedelta
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from frames import rows_of
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, GreaterThanOrEqual, InputPartition, IsNull, LessThan,
)

from shelfcast.sources.readers import Split, Warehouse, load_train

SALES = "date date, store_nbr int, item_nbr int, unit_sales double, onpromotion boolean"
PUSHED = "spark.sql.python.filterPushdown.enabled"
cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers have no folder of tests


class OneConnection(DataSource):
    @classmethod
    def name(cls):
        return "one_connection"

    def schema(self):
        return SALES

    def reader(self, schema):
        return OneConnectionReader(self.options)


class OneConnectionReader(DataSourceReader):
    """One partition a scan. Every read leaves a file with the number of rows it gave."""

    def __init__(self, options):
        self.path = f"{options['folder']}/{options['dbtable']}"
        self.log = options["log"]
        self.filters = []

    def pushFilters(self, filters):
        for one in filters:
            if isinstance(one, GreaterThanOrEqual | LessThan | IsNull) and len(one.attribute) == 1:
                self.filters.append(one)
            else:
                yield one

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        given = 0
        for row in pq.read_table(self.path).to_pylist():
            fits = True
            for one in self.filters:
                value = row[one.attribute[0]]
                if isinstance(one, IsNull):
                    fits &= value is None
                elif isinstance(one, LessThan):
                    fits &= value is not None and value < one.value
                else:
                    fits &= value is not None and value >= one.value
            if fits:
                given += 1
                yield tuple(row.values())
        Path(self.log, uuid.uuid4().hex).write_text(str(given))


@pytest.fixture
def connector(spark, tmp_path):
    """(Warehouse of given splits, rows given by every read since the last call)."""
    days = [(date(2020, 1, 1) + timedelta(days=d), 1, d % 3, float(d), False) for d in range(100)]
    days += [(None, 2, 0, 1.0, None), (None, 2, 1, 2.0, None)]
    spark.createDataFrame(days, SALES).write.parquet(f"{tmp_path}/TRAIN")
    log = tmp_path / "log"
    log.mkdir()
    spark.dataSource.register(OneConnection)
    spark.conf.set(PUSHED, "true")

    def reads():
        found = sorted(int(f.read_text()) for f in log.iterdir())
        for file in log.iterdir():
            file.unlink()
        return found

    def warehouse(**splits):
        options = {"folder": str(tmp_path)}
        return Warehouse("one_connection", "", options, {"TRAIN": {"log": str(log)}}, splits)

    yield warehouse, reads
    spark.conf.unset(PUSHED)


def test_ranges_are_input_partitions_and_lose_no_row(spark, connector):
    warehouse, reads = connector
    whole = warehouse().table(spark, "TRAIN")
    assert whole.rdd.getNumPartitions() == 1
    expected = rows_of(whole)
    assert len(expected) == 102 and reads() == [102]
    split = warehouse(TRAIN=Split("date", 4)).table(spark, "TRAIN")
    reads()
    assert split.rdd.getNumPartitions() == 5
    assert rows_of(split) == expected
    assert reads() == [2, 24, 25, 25, 26]  # NULLs, then four ranges: no connection gives all rows


def test_a_filter_reaches_every_range(spark, connector):
    warehouse, reads = connector
    split = warehouse(TRAIN=Split("date", 4)).table(spark, "TRAIN")
    reads()
    late = split.where(F.col("date") >= F.lit(date(2020, 4, 1)))
    assert late.count() == 9
    assert sum(reads()) == 9


def test_given_bounds_need_no_look_up_and_hold_back_nothing(spark, connector):
    warehouse, reads = connector
    narrow = Split("date", 3, date(2020, 2, 1), date(2020, 2, 4))
    split = warehouse(TRAIN=narrow).table(spark, "TRAIN")
    assert reads() == []
    assert split.count() == 102
    assert reads() == [1, 2, 32, 67]


def test_sales_load_through_ranges(spark, connector):
    warehouse, _ = connector
    one, many = (load_train(spark, warehouse(**s)) for s in ({}, {"TRAIN": Split("item_nbr", 8)}))
    assert rows_of(one) == rows_of(many)


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("long", [5, None, 5, -(2**63), 2**63 - 1, 7]),
        ("double", [0.5, None, -3.0, 1e6]),
        ("decimal(12,2)", [None, 3, 9]),
        ("timestamp_ntz", [datetime(2020, 1, 1), datetime(2020, 1, 2, 3), None]),
        ("date", [date(2020, 1, 1), date(2020, 1, 1)]),
        ("date", [None, None]),
        ("int", []),
    ],
)
def test_any_ordered_column_keeps_its_rows(spark, kind, values):
    text = [(None if v is None else str(v), n) for n, v in enumerate(values)]
    table = spark.createDataFrame(text, "v string, n int").select(F.col("v").cast(kind).alias("v"), "n")
    assert rows_of(Split("v", 5).read(lambda: table)) == rows_of(table)


def test_text_has_no_ranges(spark):
    with pytest.raises(ValueError, match="no ranges of v"):
        Split("v", 2).read(lambda: spark.createDataFrame([("a",)], "v string"))
