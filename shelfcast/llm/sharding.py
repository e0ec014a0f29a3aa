"""Reproducible shuffle into shards by a Feistel permutation of global row numbers.

Rows are numbered 0..n-1 in key order. A keyed Feistel network permutes the numbers; the shard is
the permuted number modulo the shard count and the slot the quotient, so both can be computed
from the row number alone, and the row from shard and slot by the inverse. Shard sizes differ
by at most one row.
"""

from __future__ import annotations

from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged, running

ROUNDS = 8


def radices(n: int) -> tuple[int, int]:
    """(a, b) with a * b >= n, both near the root of n, and few numbers beyond n."""
    start = max(1, isqrt(n))
    return min(((a, -(-n // a)) for a in range(start, start + 64)), key=lambda x: x[0] * x[1] - n)


def _keyed(value: Column, seed: int, turn: int, modulus: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), value), F.lit(modulus))


def _network(df: DataFrame, column: str, a: int, b: int, seed: int, inverse: bool) -> DataFrame:
    """``column`` through an alternating Feistel network on [0, a) x [0, b)."""
    df = df.withColumns({"_l": F.expr(f"{column} div {b}"), "_r": F.col(column) % b})
    for turn in reversed(range(ROUNDS)) if inverse else range(ROUNDS):
        moved, by, modulus = ("_l", "_r", a) if turn % 2 == 0 else ("_r", "_l", b)
        key = _keyed(F.col(by), seed, turn, modulus)
        shifted = F.col(moved) + (F.lit(modulus) - key if inverse else key)
        df = df.withColumn(moved, F.pmod(shifted, F.lit(modulus)))
    return df.withColumn(column, F.col("_l") * b + F.col("_r")).drop("_l", "_r")


def _walks(spark: SparkSession, n: int, a: int, b: int, seed: int, inverse: bool) -> int:
    """Passes after which every number below n is below n again: one more than the longest run of
    numbers beyond n that starts at the image of a number below n. Fewer than a are beyond n; a cycle
    that lies wholly beyond n is never entered and is left out."""
    if a * b == n:
        return 1
    beyond = _network(spark.range(n, a * b).withColumn("_y", F.col("id")), "_y", a, b, seed, not inverse)
    now, passes = beyond.where(F.col("_y") < n).select(F.col("id").alias("_x")), 1
    while not now.isEmpty():
        passes += 1
        now = _network(now, "_x", a, b, seed, inverse).where(F.col("_x") >= n)
    return passes


def permute(
    df: DataFrame, column: str, out: str, n: int, seed: int, inverse: bool = False
) -> DataFrame:
    """``out``: the image of ``column`` (0..n-1) under the keyed permutation of 0..n-1. Images
    beyond n are walked on along their cycle until they are below n."""
    if n < 1:
        return df.withColumn(out, F.col(column))
    a, b = radices(n)
    df = df.withColumn(out, F.col(column))
    for step in range(_walks(df.sparkSession, n, a, b, seed, inverse)):
        before = df.withColumn("_kept", F.col(out))
        df = _network(before, out, a, b, seed, inverse)
        if step:
            df = df.withColumn(out, F.when(F.col("_kept") < n, F.col("_kept")).otherwise(F.col(out)))
        df = df.drop("_kept")
    return df


def shard(
    documents: DataFrame, shards: int, seed: int = 20240229, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, row_number, position, law, shard, slot, grown_shard).

    ``size`` is the UTF-8 length of the text (null: 0) plus 16; ``text_crc32`` of a null text is
    that of the empty one. Law ``rows``: shard sizes are at most one row apart. Rows are numbered
    by (key, crc, size), nulls first, so the shuffle depends on the rows alone, not on files or
    partitions. Repeated rows keep their own places; rows equal in all three are
    interchangeable. An empty table gives no rows; other columns are not looked at.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    narrow = documents.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(body) + 16).cast("long").alias("size"),
        F.crc32(body.cast("binary")).alias("text_crc32"),
    )
    read = Staged(narrow, "sizes")  # the texts are read once; sampling for ranges reads this
    n = read.rows.count()
    rows = running(read.rows, ["doc_id", "text_crc32", "size"])
    read.drop()
    placed = permute(rows, "row_number", "position", n, seed)
    return placed.select(
        F.col("doc_id").alias(key),
        "size",
        "text_crc32",
        "row_number",
        "position",
        F.lit("rows").alias("law"),
        F.pmod("position", F.lit(shards)).cast("int").alias("shard"),
        F.expr(f"position div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
