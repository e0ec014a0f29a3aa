"""Token counts by the whole-token shortcut.

Which vocabulary strings encode alone as one token is proven once per tokenizer file, by encoding
each of them. A text is cut into the pre-tokens of the byte-level pattern; those in the proven
set count one, and only the rest go through the merges.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.frames import worker_memory
from shelfcast.llm.tokens import LONG_PIECE, PLAIN, REMEMBERED, arrow_texts, load, pieces, whole

# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def byte_letters() -> list[str]:
    """The letter that stands for each byte in byte-level vocabularies: printable bytes are
    their own letter, the others follow in order from code point 256."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b if b in printable else next(others)) for b in range(256)]


class Counter:
    """Counts tokens of texts; remembers the counts of pieces in two generations."""

    def __init__(self, path: str):
        self.library = load(path)
        settings = json.loads(self.library.to_str())
        cutter = settings["pre_tokenizer"] or {}
        plain = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        marks = [t.single_word or t.lstrip or t.rstrip for t in self.library.get_added_tokens_decoder().values()]
        if settings["normalizer"] is not None or not plain.items() <= cutter.items() or any(marks):
            raise ValueError("the tokenizer does not cut texts by the byte-level pattern alone")
        self.model = self.library.model
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.letters = {b: letter for b, letter in enumerate(byte_letters())}
        self.find = regex.compile(PATTERN).findall
        self.proven = self.prove()
        self.young: dict[str, int] = {}
        self.old: dict[str, int] = {}

    def prove(self) -> frozenset[str]:
        """Vocabulary strings that are whole texts and whose merges end in one token."""
        back = {letter: b for b, letter in self.letters.items()}
        proven = set()
        for token in self.library.get_vocab(with_added_tokens=False):
            if all(letter in back for letter in token) and len(self.model.tokenize(token)) == 1:
                raw = bytes(back[letter] for letter in token)
                try:
                    proven.add(raw.decode())
                except UnicodeDecodeError:  # a part of a character is no pre-token
                    continue
        return frozenset(proven)

    def merged(self, pre_token: str) -> int:
        return len(self.model.tokenize(pre_token.encode().decode("latin-1").translate(self.letters)))

    def piece(self, text: str) -> int:
        # Beyond, the pattern's character tables here and in the library may be of different years.
        if not text.isascii() and max(text) >= PLAIN or any(s in text for s in self.special):
            return len(self.library.encode(text, add_special_tokens=False).ids)
        proven = self.proven
        return sum(1 if p in proven else self.merged(p) for p in self.find(text))

    def count(self, text: str) -> int:
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        young, old = self.young, self.old
        first, *rest = pieces(text)
        counts = list(map(young.get, rest))
        total = self.piece(first)
        if None in counts:
            for at, word in enumerate(rest):
                if counts[at] is None:
                    n = old.get(word)
                    if n is None:
                        n = self.piece(whole(word))
                    counts[at] = n
                    if len(word) <= LONG_PIECE:
                        young[word] = n
        return total + sum(counts)


def counter(path: str) -> Counter:
    memory = worker_memory()
    if ("counter", path) not in memory:
        memory["counter", path] = Counter(path)
    return memory["counter", path]


def token_counts(
    documents: DataFrame, tokenizer: str, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, n_bytes, n_tokens) of every row, without begin, end or added special tokens; special
    strings inside a text count as the library takes them by default.

    A null text counts as empty (0, 0). Rows with null or repeated keys keep their own count, an
    empty table gives no rows, other columns are not read. One pass over the input, no shuffle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = counter(tokenizer)
        for batch in batches:
            texts = arrow_texts(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(t.encode()) for t in texts], pa.int64()),
                    pa.array([own.count(t) for t in texts], pa.int64()),
                ],
                ["doc_id", "n_bytes", "n_tokens"],
            )

    rows = documents.select(F.col(key).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(count, SCHEMA).withColumnRenamed("doc_id", key)
