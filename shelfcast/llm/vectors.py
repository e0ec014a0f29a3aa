"""What the vector searches share: usable rows, classes of equal vectors, bounded meetings, ranks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged


def usable(rows: DataFrame, key: str, vector: str, nonzero: bool) -> DataFrame:
    """Distinct (vec_id, vector) rows that take part: key, vector and components are there and finite,
    and the vector has the table's most frequent length (ties: the longer); zero vectors only
    unless ``nonzero``. Rows repeated in both count once."""
    finite = F.forall(
        "vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    some = F.exists("vector", lambda x: x != 0) if nonzero else F.lit(True)
    named = rows.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).alias("vector"))
    good = named.where("vec_id is not null and vector is not null and size(vector) > 0").where(finite & some)
    kept = Staged(good.distinct(), "vectors").rows
    lengths = kept.groupBy(F.size("vector").alias("size")).count()
    common = lengths.orderBy(F.desc("count"), F.desc("size")).limit(1).select("size").collect()
    return kept.where(F.size("vector") == (common[0]["size"] if common else 0))


def classes(rows: DataFrame, keep: int) -> DataFrame:
    """(ids, vector): equal vectors once, with their ``keep`` smallest ids in order; more of them can't
    be among the results when ties go to smaller ids."""
    place = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = rows.withColumn("_place", place).where(F.col("_place") <= keep)
    return least.groupBy("vector").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


def queries_of(rows: DataFrame, every: int) -> DataFrame:
    """(query, query_id, vector) of the rows whose id is divisible by ``every``."""
    chosen = rows.where(F.col("vec_id") % every == 0)
    return chosen.select(F.xxhash64("vec_id", "vector").alias("query"), F.col("vec_id").alias("query_id"), "vector")


def meet(
    data: DataFrame,
    queries: DataFrame,
    cell: Sequence[str],
    tie: Column,
    data_rows: int,
    query_rows: int,
    function: Callable,
    schema: str,
) -> DataFrame:
    """``function(data, queries)`` for each cell, dealt out so that a task gets about
    ``data_rows`` of the cell's rows and ``query_rows`` of its queries, however full the cell is."""
    shape = data.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / data_rows).alias("_dn")).join(
        queries.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / query_rows).alias("_qn")), list(cell)
    )
    shape = Staged(shape, "shape").rows
    zero = F.lit(0).cast("long")
    left = (
        data.join(shape, list(cell))
        .withColumn("_d", F.pmod(tie, F.col("_dn")))
        .withColumn("_q", F.explode(F.sequence(zero, F.col("_qn") - 1)))
        .drop("_dn", "_qn")
    )
    right = (
        queries.join(shape, list(cell))
        .withColumn("_q", F.pmod(F.xxhash64("query"), F.col("_qn")))
        .withColumn("_d", F.explode(F.sequence(zero, F.col("_dn") - 1)))
        .drop("_dn", "_qn")
    )
    by = [*cell, "_d", "_q"]
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInPandas(function, schema)


def ranked(found: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best of each query, a candidate found twice once."""
    once = found.groupBy("query", "query_id", "vec_id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("query", "query_id").orderBy(F.desc("score"), "vec_id")
    placed = once.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return placed.select("query_id", "rank", "vec_id", "score")


def matrix(column) -> np.ndarray:
    return np.array(column.tolist())
