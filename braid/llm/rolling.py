"""Vectorised words, word hashes and hashes of word windows over Arrow text columns.

A text's words are its runs of bytes other than blank and ``\\x09``-``\\x0D``. A hash is a polynomial modulo 2^64 over
random values of the bytes (or words), taken from running sums, so that all words and all windows of a block of texts
come out of a few array operations.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

# Texts are worked on in blocks of about so many bytes; a longer text makes a block of its own.
BLOCK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True

# Odd radixes that are 3 modulo 4: their powers differ by numbers with few factors of two.
_RADIX = (0x9E3779B97F4A7C17 | 3, 0xC2B2AE3D27D4EB4F | 3)


@cache
def _byte_values(seed: int, fold: bool) -> np.ndarray:
    values = np.random.default_rng(7919 + seed).integers(0, 1 << 64, 256, np.uint64) | np.uint64(1)
    if fold:
        values[65:91] = values[97:123]
    return values


_powers: dict[int, np.ndarray] = {}


def _power(base: int, size: int) -> np.ndarray:
    """``base`` to the powers 0, 1, ..., modulo 2^64."""
    have = _powers.get(base)
    if have is None or len(have) < size:
        steps = np.full(max(size, BLOCK_BYTES + 1), base, np.uint64)
        steps[0] = 1
        have = np.multiply.accumulate(steps)
        if size <= 4 * BLOCK_BYTES:
            _powers[base] = have
    return have[:size]


def _run_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, radix: int) -> np.ndarray:
    """Hashes of the runs ``values[start:end]``, equal for equal runs wherever they stand."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power(radix, len(values)), out=sums[1:])
    return (sums[ends] - sums[starts]) * _power(pow(radix, -1, 1 << 64), len(values) + 1)[starts]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of ``x`` over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class Block:
    """Some consecutive texts: their bytes, where each text starts, where each word starts and ends, and the number of
    the first word of each text (one entry more than texts, in both ``text_at`` and ``word_at``)."""

    first_row: int
    data: np.ndarray
    text_at: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    word_at: np.ndarray

    def word_hashes(self, seed: int = 0, fold: bool = False) -> np.ndarray:
        """A hash per word; ``fold`` takes A-Z for a-z."""
        return mix(_run_hashes(_byte_values(seed, fold)[self.data], self.starts, self.ends, _RADIX[seed]))

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers at which a window of ``size`` words of one text starts, and the number of its text."""
        counts = np.maximum(np.diff(self.word_at) - size + 1, 0)
        text = np.repeat(np.arange(len(counts)), counts)
        within = np.arange(len(text)) - np.repeat(np.cumsum(counts) - counts, counts)
        return self.word_at[:-1][text] + within, text


def window_hashes(words: np.ndarray, at: np.ndarray, size, seed: int = 0) -> np.ndarray:
    """Hashes of the windows of ``size`` word hashes (a number, or one per window) that start at ``at``."""
    return mix(_run_hashes(words, at, at + size, _RADIX[seed]))


def buffers(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and the offset of each text; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    column = column.cast(pa.large_string()).fill_null("").cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)), at


def row_ranges(at: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive rows of up to ``limit`` bytes, or one longer row, by the offsets of the texts."""
    low = 0
    while low < len(at) - 1:
        high = max(int(np.searchsorted(at, at[low] + limit, "right")) - 1, low + 1)
        yield low, high
        low = high


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with a bounded amount of text in ``column`` each; at least one."""
    if not len(batch):
        yield batch
    for low, high in row_ranges(buffers(batch.column(column))[1]):
        yield batch.slice(low, high - low)


def blocks(column: pa.Array | pa.ChunkedArray, between: np.ndarray = IS_SPACE) -> Iterator[Block]:
    """The texts of a column, block by block. ``between`` says of each byte value whether it stands between words."""
    data, at = buffers(column)
    for low, high in row_ranges(at):
        text_at = at[low : high + 1] - at[low]
        part = data[at[low] : at[high]]
        word = ~between[part]
        # A word starts where a word byte follows a space or the start of its text.
        edge = np.zeros(len(part) + 1, bool)
        edge[text_at] = True
        before = np.empty(len(part), bool)
        before[:1] = False
        before[1:] = word[:-1]
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        after = np.empty(len(part), bool)
        after[-1:] = False
        after[:-1] = word[1:]
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        yield Block(low, part, text_at, starts, ends, np.searchsorted(starts, text_at))
