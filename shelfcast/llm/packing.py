"""Vector best-fit packing of token pieces into sequences.

A piece takes tokens, one document place and attention cost (its length squared) of a sequence. Pieces
of equal length are equal to the packing, so the fit runs over the histogram of lengths (at most as
many rows as a sequence has tokens): lengths in falling order, each into the open bins that the
rule prefers among those where all three capacities suffice. Bins in the same state are held as one
entry with a count. The plan says for each length which ranks go where; the pieces get their rank by
a distributed numbering and are joined with the plan.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged, running
from shelfcast.llm.tokens import arrow_texts, encoder

PLAN = "length long, low long, high long, bin long, per long, at long"
TOGETHER = 2000  # rows whose texts and ids a worker holds at once
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut_lengths(n: int, capacity: int) -> list[int]:
    """``n`` tokens as pieces of ``capacity``; of several the first may be shorter."""
    if n <= capacity:
        return [n]
    first = n % capacity
    return [first] * (first > 0) + [capacity] * (n // capacity)


def pieces(
    documents: DataFrame, tokenizer: str, capacity: int, end: int = 0, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids with ``end`` behind them."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(tokenizer)
        last = np.array([end], own.dtype).tobytes()
        for batch in batches:
            for low in range(0, len(batch), TOGETHER):
                some = batch.slice(low, TOGETHER)
                columns = [[], [], [], [], []]
                keys = some.column(0).to_pylist()
                for doc, raw in zip(keys, own.encode(arrow_texts(some.column(1))), strict=True):
                    ids = np.frombuffer(raw + last, own.dtype).astype("<u4").tobytes()
                    start = 0
                    for place, length in enumerate(cut_lengths(len(ids) // 4, capacity)):
                        crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                        for column, value in zip(columns, (doc, place, start, length, crc), strict=True):
                            column.append(value)
                        start += length
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                    ["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(cut, PIECES)


def best_fit(
    histogram: Mapping[int, int],
    capacity: int,
    most_documents: int | None = None,
    most_attention: int | None = None,
    weights: tuple[float, float, float] = (1.0, 1.0, 1.0),
    rule: str = "norm",
) -> list[tuple[int, int, int, int, int, int]]:
    """Plan rows (length, low, high, bin, per, at): the pieces of that length with rank in
    [low, high) go to bins from ``bin`` on, ``per`` to each, the first at offset ``at``.

    Rule ``norm`` takes the bins whose weighted residual vector is shortest after the piece, ``dot``
    those with the largest weighted product of residual and piece. Without a limit, documents and
    attention cost are bounded by what ``capacity`` tokens can cost.
    """
    full = np.array([capacity, most_documents or capacity, most_attention or capacity**2], np.int64)
    scaled = np.sqrt(np.array(weights)) / full
    room, count, first = np.empty((0, 3), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    plan, bins = [], 0
    for length in sorted(histogram, reverse=True):
        need = np.array([length, 1, length * length], np.int64)
        if (need > full).any():
            raise ValueError(f"a piece of {length} tokens fits in no sequence")
        rank, left = 0, int(histogram[length])
        while left:
            fits = np.flatnonzero((room >= need).all(axis=1))
            if not len(fits):
                per = int((full // need).min()) if rule == "norm" else 1
                opened = -(-left // per)
                room, count = np.vstack([room, full]), np.append(count, opened)
                first = np.append(first, bins)
                bins += opened
                continue
            if rule == "norm":
                rest = (room[fits] - need) * scaled
                best = fits[np.argmin((rest * rest).sum(axis=1))]
            else:
                best = fits[np.argmax(((room[fits] * scaled) @ (need * scaled)))]
            per = int((room[best] // need).min()) if rule == "norm" else 1
            used = int(capacity - room[best, 0])
            here, start, some = room[best].copy(), int(first[best]), int(count[best])
            keep = np.arange(len(count)) != best
            room, count, first = room[keep], count[keep], first[keep]
            states = []
            whole = min(some, left // per)
            rest = left - whole * per if whole < some else 0
            for each, n in ((per, whole), (rest, 1)):
                if each and n:
                    plan.append((length, rank, rank + n * each, start, each, used))
                    states.append((here - each * need, n, start))
                    rank, left, start, some = rank + n * each, left - n * each, start + n, some - n
            if some:
                states.append((here, some, start))
            kept = [s for s in states if s[0].all()]
            room = np.vstack([room, *[s[0] for s in kept]])
            count = np.append(count, np.array([s[1] for s in kept], np.int64))
            first = np.append(first, np.array([s[2] for s in kept], np.int64))
    return plan


def packed(
    documents: DataFrame,
    tokenizer: str,
    capacity: int = 2048,
    end: int = 0,
    key: str = "doc_id",
    text: str = "text",
    **options,
) -> DataFrame:
    """(key, piece, start, length, ids_crc32, sequence_id, offset) of every piece.

    A null text counts as empty: its document is the end id alone. Only documents beyond
    ``capacity`` are cut. Repeated rows are packed each; rows with null keys too. An empty table gives no
    rows; other columns are not read. ``options`` go to ``best_fit``.
    """
    cut = Staged(pieces(documents, tokenizer, capacity, end, key, text), "pieces")
    lengths = cut.rows.groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in lengths.collect()}  # at most ``capacity`` rows
    spark = documents.sparkSession
    starts, at = [], 0
    for length in sorted(histogram):
        starts.append((length, at))
        at += histogram[length]
    plan = spark.createDataFrame(best_fit(histogram, capacity, **options), PLAN)
    first = spark.createDataFrame(starts, "length long, first long")
    ranked = running(cut.rows, ["length", "doc_id", "piece", "start", "ids_crc32"])
    cut.drop()
    # Both tables are bounded by the number of lengths, not by the number of pieces.
    ranked = ranked.join(F.broadcast(first), "length").withColumn(
        "_rank", F.col("row_number") - F.col("first")
    )
    placed = ranked.join(F.broadcast(plan), "length").where("_rank >= low and _rank < high")
    return placed.select(
        F.col("doc_id").alias(key),
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("bin") + F.expr("(_rank - low) div per")).alias("sequence_id"),
        (F.col("at") + (F.col("_rank") - F.col("low")) % F.col("per") * F.col("length")).alias("offset"),
    )
