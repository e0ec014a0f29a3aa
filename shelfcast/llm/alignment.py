"""Alignment of two tokenizations of the same texts.

A text's tokens under both tokenizers are byte ranges of the same bytes. The places where tokens of
both end, found by intersecting the two dictionaries from end to token index, cut the text into
groups; inside a group, tokens whose ranges overlap are linked.

A single space between two characters that are not white space is such a place in every text: neither tokenizer
has a token across it (checked when the files are opened), and what stands on one side does not change the tokens
on the other. Texts are therefore aligned word by word, and a worker remembers the words it has met.

How many documents hold a pair of ids linked is counted over blocks of consecutive documents: a block
sends each of its pairs once, gets its count back once, and its documents are summed up in place. A pair that
stands in every document is one row per block, and no document's links travel.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.frames import Staged, worker_memory
from shelfcast.llm.token_counts import byte_letters
from shelfcast.llm.tokens import arrow_texts, load

BLOCK_WORDS = 200_000  # a block of documents is closed beyond; a longer document is a block of its own
REMEMBERED = 250_000  # words a worker keeps in each of two generations
LONG_WORD = 80  # longer ones are not remembered
TOGETHER = 512
_CUT = re.compile(r"(?<=\S) (?=\S)")
_SPANS = re.compile(r"\S ")
_B_BITS = 32
BLOCKS = (
    "block long, keys array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, pairs array<long>, documents array<long>, ends array<long>, at array<int>, "
    "times array<int>"
)
COUNTED = ("n_a", "n_b", "n_groups", "n_links")


def groups(a_ends: list[int], b_ends: list[int]) -> Iterator[tuple[int, int, int, int, int]]:
    """(end, a_from, a_to, b_from, b_to) between the byte places where tokens of both end."""
    a_index = dict(zip(a_ends, count(1)))
    b_index = dict(zip(b_ends, count(1)))
    a_from = b_from = 0
    for end in sorted(a_index.keys() & b_index.keys()):
        a_to, b_to = a_index[end], b_index[end]
        yield end, a_from, a_to, b_from, b_to
        a_from, b_from = a_to, b_to


def links(
    a_ends: list[int], b_ends: list[int], a_from: int, a_to: int, b_from: int, b_to: int
) -> Iterator[tuple[int, int]]:
    """Token indices of a group whose byte ranges overlap. Inside a group no two ends are equal but the
    last, so one side goes on at a time."""
    i, j = a_from, b_from
    while i < a_to and j < b_to:
        yield i, j
        if a_ends[i] < b_ends[j]:
            i += 1
        else:
            j += 1


#: What a word adds to its document, plain so that the collector need not look at it: n_a, n_b, n_groups and n_links, the
#: ids by group, and the linked pairs. All zeros where a tokenizer changes the text.
Word = tuple[bytes, str, bytes]
CHANGED: Word = (bytes(32), "", b"")


class Aligner:
    """Both tokenizers, and the words met so far in two generations."""

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece

        self.a = load(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        back = {letter: b for b, letter in enumerate(byte_letters())}
        self.a_bytes: dict[int, bytes] = {}
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            if all(letter in back for letter in token):
                self.a_bytes[number] = bytes(back[letter] for letter in token)
        self.b_bytes = [self._b_token(i) for i in range(self.b.get_piece_size())]
        self._check()
        self.young: dict[str, Word] = {}
        self.old: dict[str, Word] = {}

    def _b_token(self, number: int) -> bytes:
        piece = self.b.id_to_piece(number)
        return bytes([int(piece[3:-1], 16)]) if self.b.is_byte(number) else piece.replace("▁", " ").encode()

    def _check(self) -> None:
        """No token of either file has a space behind a character that is not white space, and A cuts texts by
        the byte-level pattern alone."""
        own = [*self.a_bytes.values(), *self.b_bytes]
        settings = json.loads(self.a.to_str())
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        kept = settings["normalizer"] is None and plain.items() <= (settings["pre_tokenizer"] or {}).items()
        if not kept or any(_SPANS.search(raw.decode(errors="replace")) for raw in own):
            raise ValueError("words of these files cannot be aligned one by one")

    def _run(self, text: str, stops: list[int]) -> list[Word] | None:
        """The words of a space and a text, which end at the byte places ``stops``; None if a tokenizer changes it."""
        a = self.a.encode(text, add_special_tokens=False).ids
        b = self.b.encode(text[1:])
        raw = text.encode()
        a_bytes, b_bytes = list(map(self.a_bytes.__getitem__, a)), list(map(self.b_bytes.__getitem__, b))
        if b"".join(a_bytes) != raw or b"".join(b_bytes) != raw:
            return None
        a_ends, b_ends = list(accumulate(map(len, a_bytes))), list(accumulate(map(len, b_bytes)))
        told, found, lines, marks = [], [], [], []
        at = iter(stops)
        after = next(at)
        told_before = 0
        for end, a_from, a_to, b_from, b_to in groups(a_ends, b_ends):
            if a_to - a_from == 1 == b_to - b_from:
                x, y = a[a_from], b[b_from]
                told.append(f"{x}|{y}")
                found.append(x << _B_BITS | y)
            else:
                told.append(",".join(map(str, a[a_from:a_to])) + "|" + ",".join(map(str, b[b_from:b_to])))
                found += [a[i] << _B_BITS | b[j] for i, j in links(a_ends, b_ends, a_from, a_to, b_from, b_to)]
            if end == after:
                lines.append(";".join(told[told_before:]))
                told_before = len(told)
                marks += (a_to, b_to, told_before, len(found))
                after = next(at, None)
        ends = np.array(marks, np.int64).reshape(-1, 4)
        sizes = np.diff(ends, axis=0, prepend=0).tobytes()
        pairs, cuts = np.array(found, np.int64).tobytes(), [0, *(8 * ends[:, 3]).tolist()]
        return [
            (sizes[32 * i : 32 * i + 32], line, pairs[cuts[i] : cuts[i + 1]]) for i, line in enumerate(lines)
        ]

    def learn(self, words: list[str]) -> list[Word]:
        """The words' alignments, in their order: many in one text where their ends are safe places."""
        out: list[Word | None] = [None] * len(words)
        joined = [i for i, w in enumerate(words) if not (w[0].isspace() or w[-1].isspace() or "▁" in w)]
        for low in range(0, len(joined), TOGETHER):
            some = joined[low : low + TOGETHER]
            own = [words[i] for i in some]
            stops = list(accumulate(len(word.encode()) + 1 for word in own))
            for i, word in zip(some, self._run(" " + " ".join(own), stops) or ()):
                out[i] = word
        for i, word in enumerate(words):
            if out[i] is None:
                alone = self._run(" " + word, [len(word.encode()) + 1])
                out[i] = alone[0] if alone else CHANGED
        return out

    def words(self, texts: set[str]) -> dict[str, Word]:
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        found, new = {}, []
        for text in texts:
            word = self.young.get(text)
            if word is None:
                word = self.old.get(text)
                if word is None:
                    new.append(text)
                    continue
                self.young[text] = word
            found[text] = word
        for text, word in zip(new, self.learn(new), strict=True):
            found[text] = word
            if len(text) <= LONG_WORD:
                self.young[text] = word
        return found


def aligner(a_path: str, b_path: str) -> Aligner:
    memory, key = worker_memory(), ("aligner", a_path, b_path)
    if key not in memory:
        memory[key] = Aligner(a_path, b_path)
    return memory[key]


def cut(text: str) -> list[str]:
    """The words of a text, none for an empty one."""
    return _CUT.split(text) if text else []


def _block(own: Aligner, keys: list[int | None], parts: list[list[str]]) -> dict:
    """One row of BLOCKS but its number. ``at`` holds, for each document in turn up to ``ends``, places in
    ``pairs``, and ``times`` how often the document has that pair linked."""
    known = own.words({word for words in parts for word in words})
    place = dict(zip(known, count()))
    words = list(known.values())
    sizes = np.frombuffer(b"".join([w[0] for w in words]), np.int64).reshape(-1, 4)
    lengths = sizes[:, 3]
    starts = np.cumsum(lengths) - lengths
    linked = np.frombuffer(b"".join([w[2] for w in words]), np.int64)
    pairs, flat = np.unique(linked, return_inverse=True)
    same = lengths > 0  # a word has tokens, and each token is linked
    lines = [w[1] for w in words]
    sums, told, at, times, ends = [], [], [], [], [0]
    for text in parts:
        listed = list(map(place.__getitem__, text))
        rows = np.array(listed, np.int64)
        ends.append(ends[-1])
        if not listed or not same[rows].all():
            sums.append(np.zeros(4, np.int64))
            told.append("")
            continue
        sums.append(sizes[rows].sum(axis=0))
        told.append(hashlib.sha256(";".join(map(lines.__getitem__, listed)).encode()).hexdigest())
        n = lengths[rows]
        here = flat[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(starts[rows], n)]
        distinct, often = np.unique(here, return_counts=True)
        at.append(distinct)
        times.append(often)
        ends[-1] += len(distinct)
    at = np.concatenate([*at, np.empty(0, np.int64)]).astype(np.int32)
    times = np.concatenate([*times, np.empty(0, np.int64)]).astype(np.int32)
    documents = np.bincount(at, minlength=len(pairs)).astype(np.int64)
    used = documents > 0  # a text that one tokenizer changes has no pairs
    renamed = (np.cumsum(used) - 1).astype(np.int32)
    columns = dict(zip(COUNTED, np.array(sums, np.int64).reshape(-1, 4).T, strict=True))
    return {
        "keys": keys, **columns, "groups_sha256": told, "pairs": pairs[used], "documents": documents[used],
        "ends": ends[1:], "at": renamed[at], "times": times,
    }


def _fields(described: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_()}
    parts = [part.rsplit(" ", 1) for part in described.split(", ")]
    return pa.schema(
        [(n, pa.list_(kinds[k[6:-1]]) if k.startswith("array") else kinds[k]) for n, k in parts]
    )


def blocks(documents: DataFrame, a_path: str, b_path: str, key: str, text: str) -> Staged:
    """Written blocks of aligned documents, in the order of the input's partitions."""
    schema = _fields(BLOCKS)
    limit = BLOCK_WORDS

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        held: list[tuple[int | None, list[str], int]] = []
        size = 0

        def block() -> pa.RecordBatch:
            row = _block(own, [h[0] for h in held], [h[1] for h in held])
            row["block"] = held[0][2]
            return pa.RecordBatch.from_arrays([pa.array([row[f.name]], f.type) for f in schema], schema=schema)

        for batch in batches:
            ids, places = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            for number, words, place in zip(ids, map(cut, arrow_texts(batch.column(1))), places, strict=True):
                if held and size + len(words) > limit:
                    yield block()
                    held, size = [], 0
                held.append((number, words, place))
                size += len(words)
        if held:
            yield block()

    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"), F.monotonically_increasing_id().alias("at")
    )
    return Staged(rows.mapInArrow(align, BLOCKS), "aligned")


def pair_counts(written: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of its A id is in more. A pair
    is the A id above 32 bits of the B id; an A id has at most as many pairs as the B file has tokens."""
    counted = (
        written.select(F.explode(F.arrays_zip("pairs", "documents")).alias("p"))
        .groupBy(F.col("p.pairs").alias("pair"))
        .agg(F.sum("p.documents").alias("n"))
    )
    rows = Staged(counted, "pair-counts").rows
    first = F.shiftright("pair", _B_BITS)
    highest = rows.groupBy(first.alias("_a")).agg(F.max("n").alias("_most"))
    joined = rows.withColumn("_a", first).join(highest, "_a")
    return joined.select("pair", "n", (F.col("n") == F.col("_most")).alias("best"))


RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of blocks with their pairs' counts (place, n, best), one block at a time."""
    schema = _fields(RESULT)
    for batch in batches:
        for row in range(len(batch)):
            block = {name: batch.column(name)[row].values for name in batch.schema.names if name != "block"}
            size = len(block["keys"])
            best, total = np.zeros(size, np.int64), np.zeros(size, np.int64)
            ends = block["ends"].to_numpy()
            if size and ends[-1]:
                found = block["found"]
                order = np.argsort(found.field("at").to_numpy())
                counts = found.field("n").to_numpy()[order]
                most = found.field("best").to_numpy(zero_copy_only=False)[order]
                at, times = block["at"].to_numpy(), block["times"].to_numpy().astype(np.int64)
                document = np.repeat(np.arange(size), np.diff(ends, prepend=0))
                np.add.at(total, document, counts[at] * times)
                np.add.at(best, document, np.where(most[at], times, 0))
            told = [block["keys"], *(block[c] for c in COUNTED), pa.array(best), pa.array(total), block["groups_sha256"]]
            yield pa.RecordBatch.from_arrays(told, schema=schema)


def aligned(documents: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    A is a byte-level tokenizers file, applied to a space and the text; B a sentencepiece file that adds
    the space itself; both without special tokens, whose strings in a text are plain text. Groups are cut where
    tokens of both end; links are all pairs of occurrences with overlapping bytes. A pair of ids
    counts the rows that hold it linked; ``n_best`` are the row's links whose count is the highest of
    their A id, ``count_sum`` the sum over its links. ``groups_sha256`` digests the ids by group.

    A null or empty text, and one that either tokenizer changes, has no tokens: zeros and an empty
    digest. Repeated rows and null keys are documents of their own. An empty table gives no rows;
    other columns are not read.
    """
    written = blocks(documents, a_path, b_path, key, text).rows
    counts = Staged(pair_counts(written), "pairs").rows
    asked = written.select("block", F.posexplode("pairs").alias("_at", "pair"))
    answers = asked.join(counts, "pair").groupBy("block").agg(
        F.collect_list(F.struct(F.col("_at").alias("at"), "n", "best")).alias("found")
    )
    rest = written.drop("pairs", "documents").join(answers, "block", "left")
    found = rest.withColumn(
        "found", F.coalesce("found", F.array().cast("array<struct<at:int,n:bigint,best:boolean>>"))
    )
    return found.mapInArrow(_told, RESULT).withColumnRenamed("doc_id", key)
