"""Mixing sources to target weights, block by block, with DataFrame functions only.

The words of a source, documents in key order, form a stream that is packed into blocks of one
length, shorter for a small source (the last one may be shorter still). A source gets as many slots as its target needs. The slots
of all sources are dealt to output shards by one keyed permutation: each shard's source counts are a
multinomial draw conditioned on the sources' totals, so no source misses its target by chance
and none outgrows its limit. A source's slots run through its blocks in a pseudorandom order,
another one for each pass, and are joined with the blocks by index.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfcast.llm.frames import WORD, Staged, running
from shelfcast.llm.sharding import permute

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST_REPEATS = 2
BLOCK_WORDS = 64  # at most; a source has at least LEAST_BLOCKS blocks, or one for each word
LEAST_BLOCKS = 128
SHARD_SLOTS = 4096
SHUFFLES = 24  # swap-or-not rounds of a source's block order
CHUNK = 1 << 14


def word_count(text: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int], share: float, most: int) -> DataFrame:
    """(source, rank, source_size, stream_start, target) from (source, source_size).

    The target is the smaller of ``most`` times the source's size and its weight times a common
    level, at which the targets add up to ``share`` of all sizes. In rising order of limit over
    weight, the level is the largest of those found by taking all sources before one as limited.
    One row per source passes through one task.
    """
    place = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(
        F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")
    ).cast("double")
    ranked = (
        sizes.withColumn("rank", (F.row_number().over(place) - 1).cast("long"))
        .withColumn("weight", weight)
        .withColumn("limit", (F.col("source_size") * most).cast("double"))
        .withColumn(
            "stream_start",
            F.coalesce(
                F.sum("source_size").over(place.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ),
        )
    )
    whole = Window.orderBy("_by", "rank").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    before = Window.orderBy("_by", "rank").rowsBetween(Window.unboundedPreceding, -1)
    free = share * F.sum("source_size").over(whole) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    room = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = (
        ranked.withColumn("_by", F.col("limit") / F.col("weight"))
        .withColumn("_level", free / room)
        .withColumn("level", F.max("_level").over(whole))
    )
    return level.select(
        "source", "rank", "source_size", "stream_start",
        F.least("limit", F.col("level") * F.col("weight")).alias("target"),
    )


def swap_or_not(df: DataFrame, column: str, size: str, keys: Sequence[str], seed: int) -> DataFrame:
    """``column`` through a keyed permutation of 0..size-1, where ``size`` and ``keys`` are columns:
    each round pairs x with key - x and a keyed bit of the pair says whether to swap."""
    named = [F.col(k) for k in keys]
    for turn in range(SHUFFLES):
        other = F.pmod(
            F.pmod(F.xxhash64(F.lit(seed), F.lit(turn), *named), F.col(size)) - F.col(column),
            F.col(size),
        )
        df = df.withColumn("_other", other)
        coin = F.xxhash64(F.lit(~seed), F.lit(turn), *named, F.greatest(column, "_other"))
        df = df.withColumn(
            column, F.when(coin.bitwiseAND(F.lit(1)) == 1, F.col("_other")).otherwise(F.col(column))
        )
    return df.drop("_other")


class Mixture:
    """``rows``: the input with row_number, size and source figures; ``slots``: what each place of
    each output shard takes; ``spans``: the same with documents and word ranges."""

    def __init__(
        self,
        documents: DataFrame,
        key: str = "doc_id",
        text: str = "text",
        source: str = "source",
        carried: Sequence[str] = (),
        weights: Sequence[int] = WEIGHTS,
        share: float = SHARE,
        most: int = MOST_REPEATS,
        block_words: int = BLOCK_WORDS,
        shard_slots: int = SHARD_SLOTS,
        seed: int = 71,
    ):
        body = F.coalesce(F.col(text), F.lit(""))
        read = documents.select(
            F.col(key).alias("doc_id"),
            F.col(source).alias("source"),
            F.crc32(body.cast("binary")).alias("_crc"),
            word_count(text).alias("size"),
            F.struct(*carried).alias("own") if carried else F.lit(None).cast("int").alias("own"),
        )
        first = Staged(read, "sized")
        ordered = running(
            first.rows.withColumn("_last", F.col("source").isNull()),
            ["_last", "source", "doc_id", "_crc", "size"],
            total="size",
        ).drop("_last", "_crc")
        by_source = first.rows.groupBy("source").agg(F.sum("size").alias("source_size"))
        # Half a block at most is what rounding to whole blocks costs a target.
        own = F.greatest(F.lit(1).cast("long"), F.least(F.lit(block_words).cast("long"), F.expr(f"source_size div {LEAST_BLOCKS}")))
        blocks = F.ceil(F.col("source_size") / F.col("block_size"))
        wanted = F.round(F.col("target") * F.col("blocks") / F.greatest("source_size", F.lit(1)))
        self.sources = Staged(
            targets(by_source, weights, share, most)
            .withColumn("block_size", own)
            .withColumn("blocks", blocks)
            .withColumn("quota", F.least(F.col("blocks") * most, wanted.cast("long")))
            .withColumn(
                "slot_start",
                F.coalesce(
                    F.sum("quota").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)),
                    F.lit(0),
                ),
            ),
            "sources",
        ).rows
        self.rows = Staged(
            ordered.join(self.sources, ordered["source"].eqNullSafe(self.sources["source"]))
            .drop(self.sources["source"])
            .withColumn("from", F.col("before") - F.col("stream_start"))
            .drop("before", "slot_start"),
            "placed",
        ).rows
        first.drop()
        total = self.sources.agg(F.sum("quota")).first()[0] or 0
        self.slots = Staged(self._slots(total, shard_slots, seed), "slots").rows
        self.spans = self._spans()

    def _slots(self, total: int, shard_slots: int, seed: int) -> DataFrame:
        """(shard, slot, rank, block): two expansions, so that a source with most of the slots is
        spread over tasks."""
        chunks = self.sources.where("quota > 0").select(
            "rank", "blocks", "quota", "slot_start",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1, F.lit(CHUNK).cast("long"))).alias("_from"),
        )
        chunks = chunks.repartition(max(1, min(10_000, total // CHUNK)), "rank", "_from")
        end = F.least(F.col("_from") + CHUNK, "quota") - 1
        slots = chunks.withColumn("_own", F.explode(F.sequence("_from", end)))
        dealt = permute(
            slots.withColumn("_global", F.col("slot_start") + F.col("_own")), "_global", "place", total, seed
        )
        passes = dealt.withColumn("_pass", F.expr("_own div blocks")).withColumn(
            "block", F.col("_own") % F.col("blocks")
        )
        mapped = swap_or_not(passes, "block", "blocks", ["rank", "_pass"], seed + 1)
        return mapped.select(
            F.expr(f"place div {shard_slots}").alias("shard"),
            (F.col("place") % shard_slots).cast("int").alias("slot"),
            "rank",
            "block",
        )

    def _spans(self) -> DataFrame:
        """(shard, slot, rank, block, row_number, word, words): ``words`` words of the document from
        its ``word``-th on. Joined on (rank, block), of which no value has more rows than a block
        has words and a block has uses. Sorted and merged at any size: the planner takes the parts to be as
        small as the compressed files of ``rows``, and would broadcast hundreds of times its limit."""
        has = self.rows.where("size > 0").select("rank", "row_number", "size", "from", "block_size")
        last = F.expr("(`from` + size - 1) div block_size")
        parts = has.withColumn("block", F.explode(F.sequence(F.expr("`from` div block_size"), last)))
        low = F.greatest(F.col("block") * F.col("block_size"), "from")
        high = F.least((F.col("block") + 1) * F.col("block_size"), F.col("from") + F.col("size"))
        parts = parts.select(
            "rank", "block", "row_number", (low - F.col("from")).alias("word"), (high - low).alias("words")
        )
        return self.slots.join(parts.hint("merge"), ["rank", "block"])

    def taken(self) -> DataFrame:
        """``rows`` with ``taken``: the words of each row in the mix, repeats counted."""
        used = self.spans.groupBy("row_number").agg(F.sum("words").alias("taken"))
        return self.rows.join(used, "row_number", "left").withColumn(
            "taken", F.coalesce("taken", F.lit(0)).cast("long")
        )

    def texts(self) -> DataFrame:
        """(row_number, own, repeat, text): a row's ``repeat``-th copy in the mix has the words of
        those of its spans that are used at least so often, joined by single spaces (line breaks are not
        kept); with all words it is the text itself.
        ``own`` must carry the text."""
        used = self.spans.groupBy("row_number", "word", "words").agg(F.count(F.lit(1)).alias("uses"))
        by_row = used.groupBy("row_number").agg(
            F.sort_array(F.collect_list(F.struct("word", "words", "uses"))).alias("_spans")
        )
        rows = self.rows.select("row_number", "own", "size").join(by_row, "row_number")
        most = F.aggregate("_spans", F.lit(0).cast("long"), lambda m, s: F.greatest(m, s["uses"]))
        count = F.aggregate("_spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
        # A text is cut into words below the explode: above it, the planner would move the cut into the
        # function that runs for every span.
        even = (count == F.col("size")) & ~F.exists("_spans", lambda s: s["uses"] != F.col("_most"))
        words = F.regexp_extract_all(F.col("own.text"), F.lit(WORD), F.lit(0))
        cut = rows.withColumn("_most", most).withColumn("_words", F.when(~even, words))
        copies = cut.withColumn("repeat", F.explode(F.sequence(F.lit(1).cast("long"), "_most")))
        chosen = copies.withColumn("_spans", F.filter("_spans", lambda s: s["uses"] >= F.col("repeat")))
        taken = F.transform(
            "_spans", lambda s: F.slice("_words", (s["word"] + 1).cast("int"), s["words"].cast("int"))
        )
        text = F.when(count == F.col("size"), F.col("own.text")).otherwise(F.array_join(F.flatten(taken), " "))
        return chosen.select("row_number", "own", "repeat", text.alias("text"))


def mixed_sizes(documents: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row.

    ``size`` counts words (null text: 0). A null source is a source of its own, last in order; a
    source without words has target 0 and gives nothing. Repeated rows and rows with null keys take part
    each for itself. No row gives more than ``most`` times its words. An empty table gives no
    rows; other columns are not read.
    """
    return Mixture(documents, **options).taken().select("doc_id", "size", "source_size", "target", "taken")
