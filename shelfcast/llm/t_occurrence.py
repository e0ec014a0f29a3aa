"""Jaccard join on three-word shingles by T-occurrence search.

A text that reaches the similarity with a query shares at least T of the query's shingles. Among inverted
lists of documents, those found in T of the query's lists are wanted. As in DivideSkip, the shorter lists are merged
and the L longest ones probed by binary search, without the documents that cannot reach the count any more.

Which documents have to meet at all is settled first, without losing a pair. Two linked sets differ in at most a
nineteenth of both sizes, so of a few more parts into which a hash deals all shingles, some are
equal in both. A part's content is its key; equal sets are one class from the start, and only classes that share a key
meet. A member goes to the cell of the smallest class among its lists, which holds a bounded number of shingles
and is searched whole; links found there are contracted to components. The same is done with the largest
class, and then lists that still hold several components are searched in cells of two blocks each: families of
members are cut into blocks by length, and a cell holds those members of two blocks that share a list. No
rows are made for pairs within a list.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.components import components, contracted
from shelfcast.llm.frames import Staged, same_row, spread, text_marks
from shelfcast.llm.tokens import arrow_texts

WORDS = 3
PERCENT = 90
LEAST = 9  # a smaller set reaches 90 % with no other set
THIN = 2  # a part with fewer shingles is no key of its own, unless too many are
BLOCK_SHINGLES = 1 << 18  # set elements of a block
MU = 0.0085  # cost of a probe against a merged entry: how many lists are probed
HOME_STEPS = 2
FEW = 8  # documents that a query is searched in before the others of its cell
FIRST = ("doc_id", "h0", "h1")
_SEEDS = np.random.default_rng(13).integers(1 << 62, 1 << 63, WORDS, dtype=np.uint64) * 2 + 1


def _scrambled(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of the 64-bit integers."""
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def shingles(text: str) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the three-word shingles of a whole text; of fewer words, one."""
    words = text.encode().lower().split()  # A-Z only, cut at 0x20 and 0x09-0x0D
    if not words:
        return np.empty(0, np.uint64)
    hashed = np.array(list(map(xxhash.xxh3_64_intdigest, words)), np.uint64)
    span = min(WORDS, len(words))
    total = np.full(len(words) - span + 1, span, np.uint64)
    for i in range(span):
        total += hashed[i : i + len(total)] * _SEEDS[i]
    return np.unique(_scrambled(total))


def _edges(most: int) -> list[int]:
    """Sizes at which the classes of size begin; the linked sets of a size are in its class and the two beside it."""
    out = [LEAST]
    while out[-1] <= most:
        out.append(-(-out[-1] * 100 // PERCENT))
    return [*out, -(-out[-1] * 100 // PERCENT)]


def needed(n: int) -> int:
    """Shingles of a set of ``n`` that every set similar to it holds."""
    return -(-n * PERCENT // 100)


def signatures(values: np.ndarray) -> np.ndarray:
    """Keys of a set. Linked sets of different content share one.

    A pair's keys belong to the size class of its larger set, so a set has those of its own class and of
    the next. With d shingles at most in only one of the two sets, d + 1 + s parts have 1 + s equal ones. A
    set with up to s thin parts leaves them out, as an equal part that is not thin remains; others give all.
    """
    n = len(values)
    if n < LEAST:
        return values[:0]
    edges = _edges(n)
    own = bisect_right(edges, n) - 1
    out = []
    for grade in (own, own + 1):
        most = (2 * (edges[grade + 1] - 1) * (100 - PERCENT)) // (100 + PERCENT)
        spare = (most > 3) + most // 64
        parts = most + 1 + spare
        dealt = _scrambled(values + np.full(1, 2 * grade + 1, np.uint64) * _SEEDS[0])
        part = ((dealt >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
        sums = np.zeros(parts, np.uint64)
        np.add.at(sums, part, _scrambled(dealt))
        number = np.arange(parts, dtype=np.uint64) + np.uint64(grade << 40)
        keys = _scrambled(sums + number * _SEEDS[1])
        thin = np.bincount(part, minlength=parts) < THIN
        out.append(keys if thin.sum() > spare else keys[~thin])
    return np.concatenate(out)


def described(documents: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_id, h0, h1, n, f0, f1, keys): marks of the text, size, 128-bit fingerprint and keys of its set."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 1000):
                some = batch.slice(low, 1000)
                sets = [shingles(body) for body in arrow_texts(some.column(1))]
                prints = [divmod(xxhash.xxh3_128_intdigest(s.tobytes()), 1 << 64) for s in sets]
                prints = np.array(prints, np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0), some.column(2), some.column(3), pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(prints[:, 0].copy()), pa.array(prints[:, 1].copy()),
                        pa.array([signatures(s).view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    [*FIRST, "n", "f0", "f1", "keys"],
                )

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), *text_marks(text))
    return rows.mapInArrow(describe, "doc_id long, h0 long, h1 long, n long, f0 long, f1 long, keys array<long>")


class Index:
    """Inverted lists over the sets of a block: document numbers in ascending order for each shingle."""

    def __init__(self, values: np.ndarray, sizes: np.ndarray, part: np.ndarray):
        """``part`` holds the component of each document and may change between searches."""
        owner = np.repeat(np.arange(len(sizes)), sizes)
        order = np.argsort(values, kind="stable")
        self.shingle, first = np.unique(values[order], return_index=True)
        self.owner = owner[order]
        self.bounds = np.append(first, len(values))
        self.sizes, self.part = sizes, part

    def search(self, query: np.ndarray, own: int, before: int) -> Iterator[tuple[int, int]]:
        """(document, common shingles) of the first ``before`` documents, of other components than ``own``, that are
        similar to the query."""
        n = len(query)
        least = needed(n)
        apart = np.zeros(len(self.part), bool)
        apart[:before] = self.part[:before] != own
        apart &= (100 * self.sizes >= PERCENT * n) & (100 * n >= PERCENT * self.sizes)
        if not apart.any():
            return
        at = np.minimum(np.searchsorted(self.shingle, query), len(self.shingle) - 1)
        at = at[self.shingle[at] == query]
        if len(at) < least:
            return
        starts, ends = self.bounds[at], self.bounds[at + 1]
        order = np.argsort(ends - starts, kind="stable")
        lists = [self.owner[a:b] for a, b in zip(starts[order].tolist(), ends[order].tolist(), strict=True)]
        for doc, common in occurring(lists, least, apart):
            if 100 * common >= PERCENT * (n + int(self.sizes[doc]) - common):
                yield doc, common


def occurring(
    lists: list[Sequence[int]], least: int, wanted: np.ndarray | None = None
) -> Iterator[tuple[int, int]]:
    """(document, number of lists) of the documents, marked in ``wanted`` if given, in at least ``least`` of the lists,
    which come shortest first. All documents of the shorter lists are counted at once; those that can still
    reach the count are looked up together in one longer list after the other."""
    probed = min(least - 1, int(least / (MU * math.log2(len(lists[-1]) + 1) + 1)))
    short, long = lists[: len(lists) - probed], lists[len(lists) - probed :]
    counts = np.bincount(np.concatenate(short))
    docs = np.flatnonzero(counts >= least - probed)
    if wanted is not None:
        docs = docs[wanted[docs]]
    common = counts[docs]
    for rest, own in zip(reversed(range(len(long))), map(np.asarray, long)):
        if not len(docs):
            return
        common += own.take(own.searchsorted(docs), mode="clip") == docs
        reach = common >= least - rest
        if not reach.all():
            docs, common = docs[reach], common[reach]
    yield from zip(docs.tolist(), common.tolist())


def _linked(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Components that the links of a cell join, each with the smallest of those it is joined to: of two blocks the
    documents of the second are searched for in the first, of one each among those before it."""
    block = rows.column("block").to_numpy()
    names, own = np.unique(rows.column("part").to_numpy(), return_inverse=True)
    lists = rows.column("shingles").combine_chunks()
    values = lists.flatten().to_numpy().view(np.uint64)
    bounds = np.append(0, np.cumsum(np.diff(lists.offsets.to_numpy())))
    split = int(np.searchsorted(block, block[-1])) or len(own)
    alone = split == len(own)
    sizes = np.diff(bounds)
    part = own.copy()
    few = min(FEW, split)
    # Most queries of a family are linked with one of its first documents and need no other then.
    indices = [Index(values[: bounds[stop]], sizes[:stop], part[:stop]) for stop in sorted({few, split})]
    for q in range(1 if alone else split, len(own)):
        query = values[bounds[q] : bounds[q + 1]]
        for index in indices:
            reach = min(q, len(index.sizes)) if alone else len(index.sizes)
            for doc, _ in list(index.search(query, part[q], reach)):
                if part[doc] != part[q]:
                    part[part == part[doc]] = part[q]
    joined = np.empty_like(part, shape=len(names))
    joined[own] = part
    least = np.full(len(names), len(names))
    np.minimum.at(least, joined, np.arange(len(names)))
    least = least[joined]
    moved = least < np.arange(len(names))
    return names[moved], names[least[moved]]


def _cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined components of each cell; the rows of a cell follow each other."""
    held: list[pa.RecordBatch] = []
    now = None

    def done() -> pa.RecordBatch:
        u, v = _linked(pa.Table.from_batches(held).combine_chunks())
        return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    for batch in batches:
        x, y = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        cuts = np.flatnonzero((np.diff(x) != 0) | (np.diff(y) != 0)) + 1
        for low, high in zip([0, *cuts], [*cuts, len(x)], strict=True):
            if low == high:
                continue
            if now not in (None, (x[low], y[low])):
                yield done()
                held = []
            now = (x[low], y[low])
            held.append(batch.slice(low, high - low))
    if held:
        yield done()


class _Join:
    """Classes of equal sets, the lists of their keys, and the components found so far."""

    def __init__(self, documents: DataFrame, key: str, text: str):
        self.documents, self.key, self.text = documents, key, text
        self.all = Staged(described(documents, key, text), "described")
        pick = F.min_by(F.struct(*FIRST, "n", "keys"), F.struct(F.isnull("doc_id"), *FIRST))
        numbered = self.all.rows.where("n > 0").groupBy("f0", "f1").agg(pick.alias("own"))
        self.classes = Staged(
            numbered.select("f0", "f1", "own.*", F.monotonically_increasing_id().alias("id")), "classes"
        )
        self.stars: Staged | None = None

    def lists(self) -> Staged:
        """(key, id) of the keys that more than one class has."""
        rows = self.classes.rows.select("id", F.explode("keys").alias("key"))
        shared = rows.groupBy("key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("key")
        return Staged(rows.join(shared, "key").select("key", "id"), "lists")

    def open_lists(self, lists: DataFrame) -> Staged:
        """(key, id, part, first, last): members of lists that hold several components, with the list's
        smallest and largest id."""
        part = F.col("id")
        if self.stars is not None:
            lists = lists.join(self.stars.rows.withColumnRenamed("u", "id"), "id", "left")
            part = F.coalesce("v", "id")
        named = Staged(lists.select("key", "id", part.alias("part")), "parts")
        ends = named.rows.groupBy("key").agg(
            F.min("part").alias("_a"), F.max("part").alias("_b"), F.min("id").alias("first"), F.max("id").alias("last")
        )
        out = Staged(named.rows.join(ends.where("_a < _b").drop("_a", "_b"), "key"), "open")
        named.drop()
        return out

    def sets(self, ids: DataFrame) -> Staged:
        """(id, shingles) of the wanted classes, from the whole text of a row of theirs."""

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = [shingles(body).view(np.int64) for body in arrow_texts(batch.column(1))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(found, pa.list_(pa.int64()))], ["id", "shingles"]
                )

        wanted = self.classes.rows.select("id", *FIRST).join(ids.distinct(), "id")
        rows = self.documents.select(
            F.col(self.key).cast("long").alias("_key"), F.col(self.text).alias("text"),
            *(mark.alias(f"_{i}") for i, mark in enumerate(text_marks(self.text))),
        )
        same = same_row([F.col(c) for c in ("_key", "_0", "_1")], [F.col(c) for c in FIRST])
        found = rows.join(wanted, same).select("id", "text").dropDuplicates(["id"])
        return Staged(found.mapInArrow(read, "id long, shingles array<long>"), "sets")

    def link(self, links: DataFrame) -> None:
        self.stars = contracted(self.stars, links) if self.stars else components(links)

    def gather(self, opened: DataFrame, other: str, sets: DataFrame) -> None:
        """Search in cells of members that have an end of their lists in common, the least over a member's lists. A
        cell with more shingles than a block is cut by hash, and its end is in every piece."""
        homes = opened.groupBy("id", "part").agg(F.min(other).alias("home"))
        homes = Staged(homes.join(self.classes.rows.select("id", "n"), "id"), "homes")
        pieces = homes.rows.groupBy("home").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("_pieces"))
        pieces = Staged(pieces, "pieces")
        zero = F.lit(0).cast("long")
        members = homes.rows.join(pieces.rows, "home").select(
            F.col("home").alias("_x"), F.pmod(F.xxhash64("id"), F.col("_pieces")).alias("_y"), "id", "part"
        )
        ends = pieces.rows.join(homes.rows.select(F.col("id").alias("home"), "part"), "home").select(
            F.col("home").alias("_x"), F.explode(F.sequence(zero, F.col("_pieces") - 1)).alias("_y"),
            F.col("home").alias("id"), "part",
        )
        self.find(members.union(ends).distinct().withColumn("block", zero), sets)
        homes.drop()
        pieces.drop()

    def find(self, cells: DataFrame, sets: DataFrame) -> None:
        """Join the components that have links within cells (_x, _y, block, id, part)."""
        ordered = spread(cells.join(sets, "id"), "_x", "_y").sortWithinPartitions("_x", "_y", "block", "id")
        self.link(ordered.select("_x", "_y", "block", "id", "part", "shingles").mapInArrow(_cells, "u long, v long"))

    def search(self, opened: DataFrame, sets: DataFrame) -> None:
        """Links among all members of the open lists.

        A member's home is the smallest id within HOME_STEPS lists, mostly the same for a whole
        family. A home is cut by size, then by hash, into blocks; a member goes to the cell of its
        block and another one if a list of its own has a member there of a size that allows a link.
        """
        rows = opened.select("key", "id", F.col("id").alias("home"))
        for _ in range(HOME_STEPS):
            least = rows.groupBy("key").agg(F.min("home").alias("_least"))
            homes = Staged(opened.join(least, "key").groupBy("id").agg(F.min("_least").alias("home")), "homes")
            rows = opened.select("key", "id").join(homes.rows, "id")
        sized = homes.rows.join(self.classes.rows.select("id", "n"), "id").withColumn(
            "grade", F.floor(F.log(F.col("n")) / -math.log(PERCENT / 100)).cast("int")
        )
        weight = sized.groupBy("home", "grade").agg(F.sum("n").alias("_sum"))
        chunk = F.pmod(F.xxhash64("id"), F.ceil(F.col("_sum") / BLOCK_SHINGLES))
        blocks = Staged(
            sized.join(weight, ["home", "grade"]).select("id", "n", F.xxhash64("home", "grade", chunk).alias("block")),
            "blocks",
        )
        members = Staged(opened.select("key", "id", "part").join(blocks.rows, "id"), "members")
        there = members.rows.groupBy("key", "block").agg(F.min("n").alias("_low"), F.max("n").alias("_high"))
        there = there.withColumnRenamed("block", "other")
        fits = (F.col("_high") * 100 >= F.col("n") * PERCENT) & (F.col("n") * 100 >= F.col("_low") * PERCENT)
        cells = (
            members.rows.join(there, "key")
            .where(fits)
            .select(F.least("block", "other").alias("_x"), F.greatest("block", "other").alias("_y"), "block", "id", "part")
            .distinct()
        )
        self.find(cells, sets)
        for done in (homes, blocks, members):
            done.drop()


def similar_groups(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id) of every row.

    Links join rows whose sets of distinct three-word shingles (A-Z in lower case) have a Jaccard similarity of 0.9 or
    more; ``component_id`` is the smallest key reachable over links, the row's own included. A text of one
    or two words is one shingle; one without words (null, empty, white space) has none and is linked with
    nothing. Rows with equal sets, repeated ones among them, have the same component; texts that share a key
    are linked each for itself. A row with a null key shows its component if any key is reachable. An
    empty table gives no rows; other columns are not read.
    """
    join = _Join(documents, key, text)
    lists = join.lists()
    opened = join.open_lists(lists.rows)
    sets = join.sets(opened.rows.select("id"))
    for other in ("first", "last"):
        join.gather(opened.rows, other, sets.rows)
        opened.drop()
        opened = join.open_lists(lists.rows)
    join.search(opened.rows, sets.rows)
    for done in (opened, lists, sets):
        done.drop()
    classes = join.classes.rows.select("f0", "f1", "id", "doc_id").join(
        join.stars.rows.select(F.col("u").alias("id"), "v"), "id", "left"
    )
    labelled = Staged(classes.withColumn("label", F.coalesce("v", "id")), "labels").rows
    least = labelled.groupBy("label").agg(F.min("doc_id").alias("component_id"))
    named = labelled.join(least, "label").select("f0", "f1", "component_id")
    rows = join.all.rows.select("doc_id", "n", "f0", "f1").join(named, ["f0", "f1"], "left")
    return rows.select(
        F.col("doc_id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
