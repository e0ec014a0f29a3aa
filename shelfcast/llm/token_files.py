"""Token ids of documents in files coded with a static range asymmetric numeral system.

A folder holds ``frequencies`` (id, frequency: one table for all blocks) and ``blocks``: rows of Parquet in
which ``place`` gives the order and ``payload`` is a block of ``ans``, decodable alone. A block has
consecutive documents, in ascending id order over all blocks, whole ones only.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfcast.llm.ans import Coder, scaled
from shelfcast.llm.frames import PART_BITS, Staged
from shelfcast.llm.tokens import arrow_texts, encoder
from shelfcast.sources.staging import fresh_path

BLOCK_TOKENS = 1 << 19
BLOCKS = "place long, n_tokens long, keys array<long>, lengths array<int>, payload binary"


def tokenized(documents: DataFrame, tokenizer: str, end: int, key: str, text: str) -> DataFrame:
    """(tie, doc_id, ids, counts): ids with ``end`` behind them, where the texts are read. The last row of a
    task has no ids but the counts of the task, one 64-bit integer for every id up to the largest; ``tie``
    keeps the order of the input among equal keys."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        last = np.array([end], own.dtype).tobytes()
        total = np.zeros(max(own.size, end + 1), np.int64)
        for batch in batches:
            for low in range(0, len(batch), 2000):
                some = batch.slice(low, 2000)
                ids = [raw + last for raw in own.encode(arrow_texts(some.column(2)))]
                total += np.bincount(np.frombuffer(b"".join(ids), own.dtype), minlength=len(total))
                yield pa.RecordBatch.from_arrays(
                    [some.column(0), some.column(1), pa.array(ids, pa.binary()), pa.nulls(len(some), pa.binary())],
                    ["tie", "doc_id", "ids", "counts"],
                )
        if total.any():
            nothing = pa.nulls(1, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [nothing, nothing, pa.nulls(1, pa.binary()), pa.array([total.tobytes()], pa.binary())],
                ["tie", "doc_id", "ids", "counts"],
            )

    rows = documents.select(
        F.monotonically_increasing_id().alias("tie"), F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text")
    )
    return rows.mapInArrow(read, "tie long, doc_id long, ids binary, counts binary")


def frequencies(written: DataFrame) -> DataFrame:
    """(id, n) over the tasks' counts."""

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for raw in batch.column(0).to_pylist():
                own = np.frombuffer(raw, np.int64)
                total = own.copy() if not len(total) else total + own
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], ["id", "n"])

    counted = written.where("counts is not null").select("counts").mapInArrow(spell, "id long, n long")
    return counted.groupBy("id").agg(F.sum("n").alias("n"))


def write_tokens(
    documents: DataFrame, path: str, tokenizer: str, end: int = 0, key: str = "doc_id", text: str = "text"
) -> None:
    """Write every row's ids, a null text as empty, to the folder ``path``."""
    spark = documents.sparkSession
    written = Staged(tokenized(documents, tokenizer, end, key, text), "ids")
    counts = {r["id"]: r["n"] for r in frequencies(written.rows).collect()}  # one per id at most
    table = np.zeros(max(counts, default=0) + 1, np.int64)
    table[list(counts)] = list(counts.values())
    table = scaled(table)
    width = encoder(tokenizer).dtype
    listed = [(int(i), int(table[i])) for i in np.flatnonzero(table)]
    spark.createDataFrame(listed, "id long, frequency long").coalesce(1).write.parquet(f"{path}/frequencies")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(table)
        held: list[tuple[int, int | None, bytes]] = []
        size = 0

        def block() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(h[2] for h in held), width)
            columns = (
                (pa.int64(), held[0][0]),
                (pa.int64(), len(ids)),
                (pa.list_(pa.int64()), [h[1] for h in held]),
                (pa.list_(pa.int32()), [len(h[2]) // width.itemsize for h in held]),
                (pa.binary(), coder.encode(ids)),
            )
            names = ["place", "n_tokens", "keys", "lengths", "payload"]
            return pa.RecordBatch.from_arrays([pa.array([v], k) for k, v in columns], names)

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                # A block has documents that follow each other in the order.
                if held and (size >= BLOCK_TOKENS or row[0] != held[-1][0] + 1):
                    yield block()
                    held, size = [], 0
                held.append(row)
                size += len(row[2]) // width.itemsize
        if held:
            yield block()

    # Ids, two bytes each for a small vocabulary, are ordered instead of texts.
    ordered = (
        written.rows.where("counts is null")
        .select("tie", "doc_id", "ids")
        .repartitionByRange("doc_id", "tie")
        .sortWithinPartitions("doc_id", "tie")
    )
    placed = ordered.select(F.monotonically_increasing_id().alias("at"), "doc_id", "ids")
    blocks = placed.mapInArrow(pack, BLOCKS)
    blocks.write.option("compression", "uncompressed").parquet(f"{path}/blocks")
    written.drop()


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32, ids) of every document in the files; ``start`` counts the
    ids of all documents before it, ``ids`` are little-endian unsigned 32-bit integers."""
    table = spark.read.parquet(f"{path}/frequencies")
    listed = {r["id"]: r["frequency"] for r in table.collect()}  # bounded by the vocabulary
    values = np.zeros(max(listed, default=0) + 1, np.int64)
    values[list(listed)] = list(listed.values())

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(values)
        for batch in batches:
            for place, keys, lengths, payload in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids = coder.decode(payload).astype("<u4").tobytes()
                cuts = np.concatenate([[0], np.cumsum(lengths)]).tolist()
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([place] * len(keys), pa.int64()),
                        pa.array(keys, pa.int64()),
                        pa.array(cuts[:-1], pa.int64()),
                        pa.array(lengths, pa.int64()),
                        pa.array([ids[4 * a : 4 * b] for a, b in zip(cuts, cuts[1:])], pa.binary()),
                    ],
                    ["place", "doc_id", "inside", "n_tokens", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(f"{path}/blocks")
    part = F.shiftright("place", PART_BITS)
    sizes = blocks.select("place", part.alias("part"), "n_tokens")
    totals = sizes.groupBy("part").agg(F.sum("n_tokens").alias("_all"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per partition
    offsets = totals.select("part", F.coalesce(F.sum("_all").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy("part").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.join(F.broadcast(offsets), "part").select(
        "place", (F.col("_offset") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).alias("_start")
    )
    rows = blocks.select("place", "keys", "lengths", "payload").mapInArrow(
        unpack, "place long, doc_id long, inside long, n_tokens long, ids binary"
    )
    # The digest is taken before the join, which then moves no ids unless they are asked for.
    digested = rows.withColumn("ids_crc32", F.crc32("ids")).join(Staged(starts, "starts").rows, "place")
    start = (F.col("_start") + F.col("inside")).alias("start")
    return digested.select("doc_id", start, "n_tokens", "ids_crc32", "ids")


def token_digests(
    documents: DataFrame, tokenizer: str, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, start, n_tokens, ids_crc32) of every row, from files that are written and read back.

    A null text is empty: its ids are ``end`` alone. Repeated rows are documents of their own; null keys
    come first. An empty table gives empty files and no rows; other columns are not read.
    """
    spark = documents.sparkSession
    path = fresh_path(spark, "tokens")
    write_tokens(documents, path, tokenizer, end, key, text)
    read = read_tokens(spark, path)
    return read.select(F.col("doc_id").alias(key), "start", "n_tokens", "ids_crc32")
