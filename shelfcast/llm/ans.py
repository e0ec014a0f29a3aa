"""Range asymmetric numeral system over numpy lanes.

Symbol i of a block belongs to lane i mod LANES. All lanes take a step at once: 64-bit states, 32-bit
words, frequencies that add up to 2**SCALE. The encoder walks backwards; words are stored in the order
in which the decoder reads them. A checkpoint keeps the lane states and the word position before a
step, so that decoding can start there.

A block in bytes, little-endian: magic, steps between checkpoints, number of symbols, words,
checkpoints (5 x uint32), crc32 of the rest (uint32); then for each checkpoint its word position (uint64)
and lane states (LANES x uint64); then the words (uint32). The first checkpoint is the start.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

LANES = 1024
SCALE = 18
LOW = np.uint64(1 << 31)
MAGIC = 0x31534E41
HEADER = "<6I"
EVERY = 256  # steps between checkpoints
_WORD = np.uint64(32)


def scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies that add up to 2**SCALE, at least 1 for every symbol that occurs."""
    total = 1 << SCALE
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), np.int64)
    if not len(used):
        return out
    if len(used) > total:
        raise ValueError(f"{len(used)} symbols do not fit into frequencies of {SCALE} bits")
    share = counts[used] / counts[used].sum() * (total - len(used))
    own = np.floor(share).astype(np.int64) + 1
    left = total - own.sum()
    order = np.argsort(np.floor(share) - share, kind="stable")
    own[order[:left]] += 1
    out[used] = own
    return out


class Coder:
    def __init__(self, frequencies: np.ndarray):
        self.frequency = frequencies.astype(np.uint64)
        self.start = (np.cumsum(frequencies) - frequencies).astype(np.uint64)
        self.symbol = np.repeat(np.arange(len(frequencies), dtype=np.uint32), frequencies)
        if len(frequencies) <= 1 << 16:
            self.symbol = self.symbol.astype(np.uint16)  # stays in the processor's cache
        self.top = self.frequency << np.uint64(63 - SCALE)

    def encode(self, symbols: np.ndarray) -> bytes:
        n = len(symbols)
        steps = -(-n // LANES)
        state = np.full(LANES, LOW, np.uint64)
        words: list[np.ndarray] = []
        marks: list[tuple[int, np.ndarray]] = []
        written = 0
        for step in reversed(range(steps)):
            some = symbols[step * LANES : (step + 1) * LANES]
            x, f = state[: len(some)], self.frequency[some]
            full = x >= self.top[some]
            if full.any():
                words.append((x[full] & np.uint64(0xFFFFFFFF)).astype("<u4"))
                written += len(words[-1])
                x = np.where(full, x >> _WORD, x)
            high = x // f
            state[: len(some)] = (high << np.uint64(SCALE)) + (x - high * f) + self.start[some]
            if step % EVERY == 0:
                marks.append((written, state.copy()))
        body = b"".join(
            struct.pack("<Q", written - at) + lanes.astype("<u8").tobytes() for at, lanes in reversed(marks)
        ) + b"".join(w.tobytes() for w in reversed(words))
        return struct.pack(HEADER, MAGIC, EVERY, n, written, len(marks), zlib.crc32(body)) + body

    def decode(self, block: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
        """Symbols of the checkpoints ``first`` to ``last`` - 1; of the whole block by default."""
        magic, every, n, written, marks, crc = struct.unpack_from(HEADER, block)
        body = memoryview(block)[struct.calcsize(HEADER) :]
        if magic != MAGIC or zlib.crc32(body) != crc:
            raise ValueError("damaged block")
        if n == 0:
            return np.empty(0, np.uint32)
        size = 8 + 8 * LANES
        words = np.frombuffer(body, "<u4", written, marks * size)
        at = struct.unpack_from("<Q", body, first * size)[0]
        state = np.frombuffer(body, "<u8", LANES, first * size + 8).copy()
        end = min(n, (marks if last is None else last) * every * LANES)
        out = np.empty(end - first * every * LANES, np.uint32)
        mask = np.uint64((1 << SCALE) - 1)
        for low in range(0, len(out), LANES):
            count = min(LANES, len(out) - low)
            x = state[:count]
            slot = x & mask
            found = self.symbol[slot]
            out[low : low + count] = found
            x = self.frequency[found] * (x >> np.uint64(SCALE)) + slot - self.start[found]
            short = np.flatnonzero(x < LOW)
            if len(short):
                x[short] = (x[short] << _WORD) | words[at : at + len(short)]
                at += len(short)
            state[:count] = x
        return out
