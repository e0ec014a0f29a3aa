"""Ids of whole texts by a tokenizers file, with encoded pieces remembered per worker.

A text may be cut before a space or a line feed that stands between two characters which are not
white space: no pre-token of the byte-level pattern spans such a place, and what stands on one
side does not change the other. So a text's ids are those of its pieces in a row. The distinct pieces of some texts
are looked up together among those that a worker has met before, which are Arrow columns and no Python objects; new
ones are encoded by the library, many in one call.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from shelfcast.llm.frames import worker_memory

REMEMBERED = 700_000  # pieces whose counts a worker keeps in each of two generations
KEPT = 500_000  # the same for ids, in Arrow columns of some 40 bytes a piece
SLICE = 1 << 23  # characters of texts that are encoded together
LONG_PIECE = 80  # longer pieces are not remembered
TOGETHER = 500  # new pieces in one text
AT_ONCE = 16  # such texts in one call: the library's results take some 100 bytes a token
SPACE, FEED = "Ġ", "Ċ"  # how byte-level vocabularies write the bytes 0x20 and 0x0A
PLAIN = "\u0530"  # letters below are letters in every version of the character tables
STOPS = ",."
_ODD = re.compile(r"\s[ \n]|[ \n]\s")
_CUT = re.compile(r"(?<=\S) (?=\S)")


def pieces(text: str) -> list[str]:
    """The text cut at safe places. All but the first have lost a space in front, those that begin
    with a line feed apart. A text with white space beside a space or line feed is cut at spaces only."""
    return _CUT.split(text) if _ODD.search(text) else text.replace("\n", " \n").split(" ")


def whole(piece: str) -> str:
    return piece if piece[:1] == "\n" else " " + piece


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Encoder:
    """Ids of texts as bytes of little-endian unsigned integers of ``width`` bytes."""

    def __init__(self, path: str):
        self.library = load(path)
        vocabulary = self.library.get_vocab(with_added_tokens=True)
        self.size = max(vocabulary.values()) + 1
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.width = self.dtype.itemsize
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.opens = {mark: np.zeros(self.size, dtype=bool) for mark in (SPACE, FEED)}
        for token, number in vocabulary.items():
            if token[0] in self.opens:
                self.opens[token[0]][number] = True
        self.young = self.old = _table([], [])
        self.stops = {stop: self.plain(stop) for stop in STOPS}

    def plain(self, text: str) -> bytes:
        return np.array(
            self.library.encode(text, add_special_tokens=False).ids, dtype=self.dtype
        ).tobytes()

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        """The ids of new pieces, many pieces in one text where spaces tell them apart."""
        learned: dict[str, bytes] = {}
        fed = [piece for piece in new if piece[:1] == "\n"]
        spaced = [piece for piece in new if piece[:1] != "\n"]
        some = [(SPACE, " ", spaced[at : at + TOGETHER]) for at in range(0, len(spaced), TOGETHER)]
        some += [(FEED, "\n", fed[at : at + TOGETHER]) for at in range(0, len(fed), TOGETHER)]
        texts = ["".join(map(whole, group)) for _, _, group in some]
        encoded = (
            ids
            for at in range(0, len(texts), AT_ONCE)
            for ids in self.library.encode_batch_fast(texts[at : at + AT_ONCE], add_special_tokens=False)
        )
        for (mark, lead, group), text, own in zip(some, texts, encoded, strict=True):
            ids = np.array(own.ids, dtype=self.dtype)
            starts = np.flatnonzero(self.opens[mark][ids]) * self.width
            apart = len(starts) == len(group) == text.count(lead) and "" not in group
            if apart and not any(s in text for s in self.special):
                raw, starts = ids.tobytes(), starts.tolist()
                ends = [*starts[1:], len(raw)]
                own = [raw[a:b] for a, b in zip(starts, ends, strict=True)]
            else:
                own = [self.plain(whole(piece)) for piece in group]
            learned.update(zip(group, own, strict=True))
        return learned

    def _places(self, distinct: pa.LargeStringArray) -> np.ndarray:
        """Where the young generation, once it has met them all, holds distinct pieces."""
        if len(self.young) > KEPT:
            self.young, self.old = _table([], []), self.young
        young, old = self.young, self.old
        known, ids = (pa.concat_arrays([young[name], old[name]]) for name in ("piece", "ids"))
        # A word of plain letters and a stop are two pre-tokens; the word is looked up too.
        ends = np.zeros(len(distinct), bool)
        for stop in self.stops:
            ends |= pc.ends_with(distinct, stop).to_numpy(zero_copy_only=False)
        words = pc.utf8_slice_codeunits(distinct.filter(pa.array(ends)), 0, -1)
        found = pc.index_in(pa.concat_arrays([distinct, words]), value_set=known)
        found = found.fill_null(-1).to_numpy().astype(np.int64)
        places, of_words = found[: len(distinct)], found[len(distinct) :]
        missing = np.flatnonzero(places < 0)
        unknown = distinct.take(pa.array(missing)).to_numpy(zero_copy_only=False).tolist()
        before = np.full(len(distinct), -2)  # where the word before a stop was found
        before[ends] = of_words
        new: dict[str, None] = {}
        stopped, met, met_at = [], [], []
        for piece, at in zip(unknown, before[missing].tolist(), strict=True):
            if at == -2:
                new[piece] = None
                continue
            word = piece[:-1]
            if not (word.isalpha() and (word.isascii() or max(word) < PLAIN)):
                new[piece] = None
            elif at == -1:
                new[word] = None
                stopped.append(piece)
            else:
                met.append(piece)
                met_at.append(at)
        learned = self._learn(list(new))
        for piece in stopped:
            learned[piece] = learned[piece[:-1]] + self.stops[piece[-1]]
        raws = ids.take(pa.array(met_at, pa.int64())).to_numpy(zero_copy_only=False)
        for piece, raw in zip(met, raws, strict=True):
            learned[piece] = raw + self.stops[piece[-1]]
        moved = np.flatnonzero(places >= len(young))
        again = old.take(pa.array(places[moved] - len(young)))
        places[moved] = np.arange(len(young), len(young) + len(moved))
        order = {piece: at for at, piece in enumerate(learned, len(young) + len(moved))}
        places[missing] = [order[piece] for piece in unknown]
        grown = [young, again, _table(list(learned), list(learned.values()))]
        self.young = pa.RecordBatch.from_arrays(
            [pa.concat_arrays([part[name] for part in grown]) for name in young.schema.names], schema=young.schema
        )
        return places

    def encode(self, texts: list[str]) -> list[bytes]:
        out, held, size = [], [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= SLICE:
                out += self._encode(held)
                held, size = [], 0
        return out + self._encode(held)

    def _encode(self, texts: list[str]) -> list[bytes]:
        """A text's first piece by the library, the others as places among the remembered pieces."""
        out, tails, owners = [], [], []
        odd, odd_sizes, odd_owners = [], [], []
        for i, text in enumerate(texts):
            flat = text.replace("\n", " ")
            # Printable characters hold no white space but the space itself.
            if "  " in flat or not flat.isprintable() and _ODD.search(text):
                first, *rest = pieces(text)
                odd += rest
                odd_sizes.append(len(rest))
                odd_owners.append(i)
                out.append(self.plain(first))
                continue
            first, cut, tail = text.replace("\n", " \n").partition(" ")
            out.append(self.plain(first))
            if cut:
                tails.append(tail)
                owners.append(i)
        if tails or odd:
            found = pc.split_pattern(pa.array(tails, pa.large_string()), " ")
            cuts = found.offsets.to_numpy().astype(np.int64)
            cuts = np.concatenate([cuts, cuts[-1] + np.cumsum(odd_sizes, dtype=np.int64)])
            met = pa.concat_arrays([found.values, pa.array(odd, pa.large_string())]).dictionary_encode()
            places = self._places(met.dictionary)[met.indices.to_numpy()]
            ids = self.young["ids"].take(pa.array(places))
            ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset :][cuts].tolist()
            raw = memoryview(ids.buffers()[2] or b"")
            for i, a, b in zip(owners + odd_owners, ends, ends[1:]):
                out[i] += raw[a:b]
            # Long pieces are not kept, so that memory is bounded by the number of pieces.
            if max(map(len, texts)) > LONG_PIECE and _longest(self.young) > LONG_PIECE:
                self.young = _short(self.young)
        return out


def _table(pieces: list[str], ids: list[bytes]) -> pa.RecordBatch:
    columns = [pa.array(pieces, pa.large_string()), pa.array(ids, pa.large_binary())]
    return pa.RecordBatch.from_arrays(columns, ["piece", "ids"])


def _longest(table: pa.RecordBatch) -> int:
    return pc.max(pc.binary_length(table["piece"])).as_py() or 0


def _short(table: pa.RecordBatch) -> pa.RecordBatch:
    return table.filter(pc.less_equal(pc.binary_length(table["piece"]), LONG_PIECE))


def encoder(path: str) -> Encoder:
    memory = worker_memory()
    key = ("encoder", path)
    if key not in memory:
        memory[key] = Encoder(path)
    return memory[key]


def arrow_texts(column) -> list[str]:
    """Texts of an Arrow column, nulls as empty."""
    return [text or "" for text in column.to_pylist()]
