"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

One permutation spreads a document's shingles over 2**32 places. A second one, shifted circularly by
0, 1, 2, ..., gives all signature coordinates. Documents that agree in the four coordinates of a
band meet in a bucket. Documents with equal shingle sets are one class from the start. Buckets are
settled without their pairs: members are compared with a pivot, confirmed links are contracted to
components, and buckets that hold several components are compared block by block. Every link is
confirmed on the full shingle sets; a sketch of two bits per coordinate spares comparisons with
pivots that are far from the similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components
from shelfcast.llm.frames import Staged, same_row, spread, text_marks
from shelfcast.llm.tokens import arrow_texts

WORDS = 5
SIMILAR = 0.75
BANDS, ROWS = 32, 4  # a pair at 0.75 misses all bands with probability 5e-6
COORDINATES = BANDS * ROWS
#: Coordinates whose two sketched bits agree: at 0.75 the mean is 105 and 82 lies 5.2 deviations below.
SKETCHED = 82
BLOCK_SHINGLES = 1 << 18  # set elements of a block of documents that are compared with another
HOME_STEPS = 3
SLICE = 1 << 16
FIRST = ("doc_id", "h0", "h1")
_MULTIPLIERS = np.random.default_rng(5).integers(1 << 62, 1 << 63, WORDS, dtype=np.uint64) * 2 + 1
_TURNS = np.random.default_rng(6).integers(1 << 62, 1 << 63, ROWS, dtype=np.uint64) * 2 + 1


def _mixed(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit integers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles of a whole text."""
    words = text.encode().lower().split()  # A-Z only, cut at 0x20 and 0x09-0x0D
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.array([xxhash.xxh3_64_intdigest(w) for w in words], dtype=np.uint64)
    if len(words) < WORDS:
        whole = (hashed * _MULTIPLIERS[: len(words)]).sum(dtype=np.uint64) + np.uint64(len(words))
        return _mixed(np.array([whole], dtype=np.uint64))
    n = len(words) - WORDS + 1
    total = np.zeros(n, np.uint64)
    for i in range(WORDS):
        total += hashed[i : i + n] * _MULTIPLIERS[i]
    return np.unique(_mixed(total))


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of COORDINATES minima per non-empty set. Coordinate k is the least value of the
    second permutation at the shingles' places shifted by k, on the circle of 2**32 places."""
    places = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint32)
    x, y = np.empty_like(places), np.empty_like(places)
    for k in range(COORDINATES):
        np.add(places, np.uint32(k), out=x)
        for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            np.right_shift(x, np.uint32(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        out[:, k] = np.minimum.reduceat(x, starts)
    return out


def _slices(texts: list[str]) -> Iterator[list[np.ndarray]]:
    held, size = [], 0
    for text in texts:
        held.append(shingles(text))
        size += len(held[-1])
        if size > SLICE:
            yield held
            held, size = [], 0
    if held:
        yield held


def signed(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, h0, h1, n, f0, f1, bands, sketch): marks of the text, set size, 128-bit fingerprint of the set, band keys and two
    bits of every coordinate."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = np.arange(32, dtype=np.uint64) * np.uint64(2)
        for batch in batches:
            at = 0
            for sets in _slices(arrow_texts(batch.column(1))):
                n = np.array([len(s) for s in sets])
                bands = np.zeros((len(sets), BANDS), np.uint64)
                sketch = np.zeros((len(sets), 4), np.uint64)
                if n.any():
                    values = _signatures([s for s in sets if len(s)]).astype(np.uint64)
                    rows = _mixed(values.reshape(-1, BANDS, ROWS) * _TURNS).sum(2, dtype=np.uint64)
                    bands[n > 0] = _mixed(rows + np.arange(BANDS, dtype=np.uint64))
                    pairs = (values & np.uint64(3)).reshape(-1, 4, 32) << step
                    sketch[n > 0] = np.bitwise_or.reduce(pairs, axis=2)
                prints = np.array(
                    [divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64) for s in sets], np.uint64
                ).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(at, len(sets)) for c in (0, 2, 3)),
                        pa.array(n),
                        pa.array(prints[:, 0].copy()),
                        pa.array(prints[:, 1].copy()),
                        pa.array(list(bands.view(np.int64)), pa.list_(pa.int64())),
                        pa.array(list(sketch.view(np.int64)), pa.list_(pa.int64())),
                    ],
                    ["doc_id", "h0", "h1", "n", "f0", "f1", "bands", "sketch"],
                )
                at += len(sets)

    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *text_marks(text)
    )
    return rows.mapInArrow(
        sign,
        "doc_id long, h0 long, h1 long, n long, f0 long, f1 long, bands array<long>, sketch array<long>",
    )


def _sets(documents: DataFrame, key: str, text: str, wanted: DataFrame) -> DataFrame:
    """(id, shingles) of the wanted classes (id, doc_id, h0, h1), from the whole texts of such rows."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t).view(np.int64) for t in arrow_texts(batch.column(1))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sets, pa.list_(pa.int64()))], ["id", "shingles"]
            )

    rows = documents.select(
        F.col(key).cast("long").alias("_key"), F.col(text).alias("text"),
        *(mark.alias(f"_{i}") for i, mark in enumerate(text_marks(text))),
    )
    same = same_row([F.col(c) for c in ("_key", "_0", "_1")], [F.col(c) for c in ("doc_id", "h0", "h1")])
    return rows.join(wanted, same).select("id", "text").mapInArrow(cut, "id long, shingles array<long>")


def can_be_similar(a: str, b: str) -> Column:
    """Sizes and sketches of both sides allow the similarity."""
    low, high = F.least(f"{a}.n", f"{b}.n"), F.greatest(f"{a}.n", f"{b}.n")
    differ = F.lit(0)
    for i in range(4):
        x = F.col(f"{a}.sketch")[i].bitwiseXOR(F.col(f"{b}.sketch")[i])
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(0x5555555555555555))
        differ = differ + F.bit_count(either)
    return (low * 100 >= high * 75) & (differ <= COORDINATES - SKETCHED)


class _Search:
    """The state of one run: classes, what was tested, the links found and their components."""

    def __init__(self, documents: DataFrame, key: str, text: str):
        self.documents, self.key, self.text = documents, key, text
        self.all = Staged(signed(documents, key, text), "signed")
        # A class is named by a number of its own, and its texts are read from its first row.
        pick = F.min_by(F.struct(*FIRST, "n", "bands", "sketch"), F.struct(F.isnull("doc_id"), *FIRST))
        self.classes = Staged(
            self.all.rows.where("n > 0")
            .groupBy("f0", "f1")
            .agg(pick.alias("own"))
            .select("f0", "f1", "own.*", F.monotonically_increasing_id().alias("id")),
            "classes",
        )
        self.short = self.classes.rows.select("id", "n", "sketch")
        self.stars: Staged | None = None

    def buckets(self) -> Staged:
        """(bucket, id) of all buckets with more than one class."""
        rows = self.classes.rows.select("id", F.explode("bands").alias("bucket"))
        shared = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
        return Staged(rows.join(shared.select("bucket"), "bucket").select("bucket", "id"), "buckets")

    def open_buckets(self, buckets: DataFrame) -> Staged:
        """(bucket, id, part): members of buckets that still hold more than one component."""
        part = F.col("id")
        if self.stars is not None:
            buckets = buckets.join(self.stars.rows.withColumnRenamed("u", "id"), "id", "left")
            part = F.coalesce("v", "id")
        labelled = Staged(buckets.select("bucket", "id", part.alias("part")), "labelled")
        mixed = (
            labelled.rows.groupBy("bucket")
            .agg(F.min("part").alias("_a"), F.max("part").alias("_b"))
            .where("_a < _b")
            .select("bucket")
        )
        out = Staged(labelled.rows.join(mixed, "bucket"), "open")
        labelled.drop()
        return out

    def pivot_pairs(self, opened: DataFrame) -> DataFrame:
        """Every member with its bucket's smallest id. A group meets in many buckets, mostly with
        the same pivot."""
        pivots = opened.groupBy("bucket").agg(F.min("id").alias("a"))
        return opened.join(pivots, "bucket").where("id != a").select("a", F.col("id").alias("b"))

    def link(self, links: DataFrame) -> None:
        before = self.stars
        self.stars = components(links.union(before.rows) if before else links)
        if before:
            before.drop()

    def sets(self, ids: DataFrame) -> Staged:
        wanted = self.classes.rows.select("id", *FIRST).join(ids.distinct(), "id")
        found = _sets(self.documents, self.key, self.text, wanted)
        return Staged(found.groupBy("id").agg(F.first("shingles").alias("shingles")), "sets")

    def confirm(self, pairs: DataFrame) -> None:
        """Add the links among ``pairs`` and bring the components up to date."""
        sized = pairs.distinct()
        for side in ("a", "b"):
            own = self.short.select(F.col("id").alias(side), F.struct("n", "sketch").alias(f"_{side}"))
            sized = sized.join(own, side)
        likely = Staged(sized.where(can_be_similar("_a", "_b")).select("a", "b"), "likely")
        ids = likely.rows.select(F.col("a").alias("id")).union(likely.rows.select("b")).distinct()
        sets = self.sets(ids)
        both = likely.rows
        for side in ("b", "a"):
            own = sets.rows.select(F.col("id").alias(side), F.col("shingles").alias(f"_{side}"))
            both = both.join(own, side)
        common = F.size(F.array_intersect("_a", "_b"))
        union = F.size("_a") + F.size("_b") - common
        self.link(both.where(common * 100 >= union * 75).select(F.col("b").alias("u"), F.col("a").alias("v")))
        sets.drop()
        likely.drop()

    def compare_blocks(self, opened: DataFrame) -> None:
        """Links among all members of the open buckets, without rows for pairs.

        A document's home is the smallest id within HOME_STEPS buckets, mostly the same for a whole
        group; a home is cut by hash into blocks of bounded size. Two blocks (or one with itself) are compared if any open bucket has members in
        both; a task holds the sets of two blocks and returns a spanning forest of their links.
        """
        rows = opened.withColumn("home", F.col("id"))
        for _ in range(HOME_STEPS):
            least = rows.groupBy("bucket").agg(F.min("home").alias("_least"))
            met = opened.join(least, "bucket").groupBy("id", "part").agg(F.min("_least").alias("home"))
            homes = Staged(met, "homes")
            rows = opened.join(homes.rows.select("id", "home"), "id")
        homes = Staged(homes.rows.join(self.short.select("id", "n"), "id"), "homes")
        weight = homes.rows.groupBy("home").agg(F.sum("n").alias("_sum"))
        chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("_sum") / BLOCK_SHINGLES))
        blocks = Staged(
            homes.rows.join(weight, "home").select(
                "id", "part", F.xxhash64("home", chunk).alias("block")
            ),
            "blocks",
        )
        homes.drop()
        met = opened.select("bucket", "id").join(blocks.rows.select("id", "block"), "id")
        met = Staged(met.select("bucket", "block").distinct(), "met")
        a, b = met.rows.alias("a"), met.rows.alias("b")
        pairs = (
            a.join(b, (F.col("a.bucket") == F.col("b.bucket")) & (F.col("a.block") <= F.col("b.block")))
            .select(F.col("a.block").alias("_x"), F.col("b.block").alias("_y"))
            .distinct()
        )
        sides = pairs.select("_x", "_y", F.explode(F.array_distinct(F.array("_x", "_y"))).alias("block"))
        sets = self.sets(blocks.rows.select("id"))
        rows = sides.join(blocks.rows, "block").join(sets.rows, "id")
        ordered = spread(rows, "_x", "_y").sortWithinPartitions("_x", "_y", "block", "id")
        found = ordered.select("_x", "_y", "block", "id", "part", "shingles").mapInArrow(_forests, "u long, v long")
        self.link(found)
        for done in (blocks, met, sets):
            done.drop()


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of each pair of blocks; the rows of a pair follow each other."""
    held: list[pa.RecordBatch] = []
    now = None

    def done() -> pa.RecordBatch:
        u, v = _forest(pa.Table.from_batches(held).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(x)], strict=True):
            if low == high:
                continue
            if now is not None and now != (x[low], y[low]):
                yield done()
                held = []
            now = (x[low], y[low])
            held.append(batch.slice(low, high - low))
    if held:
        yield done()


def _forest(rows: pa.Table) -> tuple[list[int], list[int]]:
    ids, parts, block = (rows.column(c).to_numpy() for c in ("id", "part", "block"))
    lists = rows.column("shingles").combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    values = lists.flatten().to_numpy()
    owner = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(values, kind="stable")
    values, owner = values[order], owner[order]  # in each element's run, documents in row order
    count = np.unique(values, return_counts=True)[1]
    # Elements that stand in one document only are in no intersection.
    owner = owner[np.repeat(count > 1, count)]
    starts = np.concatenate([[0], np.cumsum(count[count > 1])])
    place = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    by_doc = np.argsort(owner, kind="stable")
    place_of, ends = place[by_doc], np.cumsum(np.bincount(owner, minlength=len(ids)))
    parent = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    u, v = [], []
    lengths = np.diff(starts)
    # Rows are sorted by block. Within one block every document meets those before it, of two
    # blocks those of the smaller one meet all of the other.
    split = int(np.searchsorted(block, block[-1])) if block[0] != block[-1] else 0
    if split and split < len(ids) - split:
        turns, others = range(split), np.arange(len(ids)) >= split
    else:
        turns, others = range(split, len(ids)), np.arange(len(ids)) < split
    for doc in turns:
        own = place_of[ends[doc - 1] if doc else 0 : ends[doc]]
        if not len(own):
            continue
        n = lengths[own]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[own], n)
        common = np.bincount(owner[at], minlength=len(ids))
        fits = (100 * common >= 75 * (sizes + sizes[doc] - common)) & (parts != parts[doc])
        for other in np.flatnonzero(fits & others if split else fits[:doc]):
            a, b = root(int(parts[doc])), root(int(parts[other]))
            if a != b:
                parent[a] = b
                u.append(int(ids[doc]))
                v.append(int(ids[other]))
    return u, v


def verdicts(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, h0, h1, n, component_id, kept, chosen) of every row; ``chosen`` marks one key and text of each
    component and all rows without words. Rows equal in key and text have equal verdicts."""
    search = _Search(documents, key, text)
    buckets = search.buckets()
    opened = search.open_buckets(buckets.rows)
    search.confirm(search.pivot_pairs(opened.rows))
    opened.drop()
    opened = search.open_buckets(buckets.rows)
    buckets.drop()
    search.compare_blocks(opened.rows)
    opened.drop()
    labelled = search.classes.rows.select("f0", "f1", "id", *FIRST).join(
        search.stars.rows.select(F.col("u").alias("id"), "v"), "id", "left"
    )
    labelled = Staged(labelled.withColumn("label", F.coalesce("v", "id")), "labels").rows
    first = F.min_by(F.struct(*FIRST), F.struct(F.isnull("doc_id"), *FIRST))
    least = labelled.groupBy("label").agg(first.alias("least"))
    named = labelled.join(least, "label").select("f0", "f1", F.isnull("doc_id").alias("keyless"), "least")
    rows = search.all.rows.select(*FIRST, "n", "f0", "f1").join(named, ["f0", "f1"], "left")
    empty = F.col("n") == 0
    chosen = same_row([F.col(c) for c in FIRST], [F.col(f"least.{c}") for c in FIRST])
    by_key = F.col("doc_id").eqNullSafe(F.col("least.doc_id"))
    return rows.select(
        *FIRST,
        "n",
        F.when(empty, F.col("doc_id")).when(~F.col("keyless"), F.col("least.doc_id")).alias("component_id"),
        F.when(empty, True).when(F.isnull("least.doc_id"), chosen).otherwise(by_key).alias("kept"),
        F.when(empty, True).otherwise(chosen).alias("chosen"),
    )


def near_duplicates(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept) of every row.

    Links join documents whose five-word shingle sets have a Jaccard similarity of 0.75 or more;
    ``component_id`` is the smallest key reachable over links, ``kept`` whether it is the row's own.
    Texts without words (null, empty, white space) have no shingles and are linked with nothing;
    texts of one to four words are one shingle. Repeated rows and equal texts are one class and get the
    same component. Links are between classes, so the texts of one key and those of null keys are
    linked each for itself. A row with a null key shows its component only if its class has any key; it is
    kept if no key is reachable and its text is the component's first, by hash. An empty
    table gives no rows; other columns are not read.
    """
    return verdicts(documents, key, text).select(
        F.col("doc_id").alias(key), F.col("n").alias("n_shingles"), "component_id", "kept"
    )
