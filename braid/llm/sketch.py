"""A count-min sketch that is as wide as the data needs and never in one place.

Rows are dealt into chunks of bounded size by a hash of their content, so that a chunk is the same whenever its task runs
again. Each chunk works out which cells of the sketch its elements fall into and sends, per block of cells, the distinct cells
it hits: a partial sketch, sparse and compressed. The partial sketches of a block are merged in one task, which answers each
chunk with one bit per cell it sent: whether another chunk hits the cell as well. A chunk adds what it hits twice itself. An
element is estimated to be repeated if all its cells are: never too seldom, and too often only by collisions. All messages
are rows of an ordinary shuffle; nothing is broadcast or collected, and the width grows with the data.

The same exchange with the elements' full hashes in place of cells gives exact answers for those estimated repeated.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK_BYTES = 8 << 20
# Cells of a block, and rows of the sketch.
BLOCK_BITS = 23
DEPTH = 2
# Bytes of text for which an exact block is made; a word takes at least two.
EXACT_BLOCK_BYTES = 32 << 20

MESSAGE = "block bigint, chunk bigint, n bigint, data binary"
_CODEC = "zstd"


def text_bytes(docs: DataFrame, text_col: str) -> int:
    return docs.select(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0


def chunk_of(total_bytes: int, *columns: Column | str) -> Column:
    """The chunk of a row, by a hash of its content."""
    return F.pmod(F.xxhash64(*columns), F.lit(max(1, -(-total_bytes // CHUNK_BYTES)))).alias("chunk")


def cell_bits(total_bytes: int) -> int:
    """Four cells or so for each word of a text, as a power of two."""
    return max(BLOCK_BITS, (total_bytes // 2).bit_length())


def cells(hashes: np.ndarray, depth: int, bits: int) -> np.ndarray:
    """The cell of each hash in one row of the sketch; rows use different bits of the hash, multiplied anew."""
    odd = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))[depth]
    return (hashes * odd) >> np.uint64(64 - bits)


def _packed(sorted_values: np.ndarray) -> bytes:
    """Sorted numbers as their differences, the low bytes apart from the high ones, which are mostly zero."""
    steps = np.diff(sorted_values, prepend=0).astype("<u4").view(np.uint8).reshape(-1, 4)
    return pa.compress(np.ascontiguousarray(steps.T).tobytes(), codec=_CODEC, asbytes=True)


def _unpacked(data: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(pa.decompress(data, 4 * n, codec=_CODEC, asbytes=True), np.uint8).reshape(4, n)
    return np.cumsum(np.ascontiguousarray(raw.T).view("<u4").ravel(), dtype=np.int64)


def messages(rows: Iterator[tuple[int, int, int, bytes]]) -> pa.Table:
    block, chunk, n, data = list(zip(*rows, strict=True)) or ((), (), (), ())
    return pa.table({"block": pa.array(block, pa.int64()), "chunk": pa.array(chunk, pa.int64()), "n": pa.array(n, pa.int64()), "data": pa.array(data, pa.binary())})


def partial_sketch(chunk: int, hashes: np.ndarray, bits: int) -> Iterator[tuple[int, int, int, bytes]]:
    """The distinct cells that ``hashes`` hit, as one message per block. Rows of the sketch follow one another in the blocks."""
    for depth in range(DEPTH):
        hit = np.unique(cells(hashes, depth, bits)).astype(np.int64)
        block = hit >> BLOCK_BITS
        edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
        for low, high in zip(edges[:-1], edges[1:], strict=True):
            number = int(block[low]) << 1 | depth
            yield number, chunk, int(high - low), _packed(hit[low:high] & ((1 << BLOCK_BITS) - 1))


def merge_sketches(table: pa.Table) -> pa.Table:
    """For the messages of one block, an answer to each: for every cell sent, whether another chunk sent it."""
    seen, twice = np.zeros(1 << BLOCK_BITS, bool), np.zeros(1 << BLOCK_BITS, bool)
    sent = list(zip(table.column("chunk").to_pylist(), table.column("n").to_pylist(), table.column("data"), strict=True))
    for _, n, data in sent:
        hit = _unpacked(data.as_py(), n)
        twice[hit[seen[hit]]] = True
        seen[hit] = True
    block = table.column("block")[0].as_py()
    return messages((block, chunk, n, np.packbits(twice[_unpacked(data.as_py(), n)]).tobytes()) for chunk, n, data in sent)


def _answers(table: pa.Table) -> dict[int, np.ndarray]:
    found = zip(table.column("block").to_pylist(), table.column("n").to_pylist(), table.column("data").to_pylist(), strict=True)
    return {block: np.unpackbits(np.frombuffer(data, np.uint8), count=n).astype(bool) for block, n, data in found}


def estimated_repeated(hashes: np.ndarray, answers: pa.Table, bits: int) -> np.ndarray:
    """Whether each hash may stand elsewhere: in another chunk, by the answers, or here, by its cells."""
    answers = _answers(answers)
    out = np.ones(len(hashes), bool)
    for depth in range(DEPTH):
        hit, which, n = np.unique(cells(hashes, depth, bits), return_inverse=True, return_counts=True)
        block = hit.astype(np.int64) >> BLOCK_BITS
        parts = [answers[int(b) << 1 | depth] for b in np.unique(block)]
        others = np.concatenate(parts) if parts else np.zeros(0, bool)
        out &= (others | (n > 1))[which]
    return out


def exact_messages(chunk: int, keys: np.ndarray, n_blocks: int) -> Iterator[tuple[int, int, int, bytes]]:
    """Distinct 128-bit keys (two 64-bit columns, sorted), one message per block."""
    # The top bits of the first half pick the block, so that sorted keys are in the order of their blocks.
    block = (keys[:, 0] >> np.uint64(40)).astype(np.int64) * n_blocks >> 24
    edges = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
    for low, high in zip(edges[:-1], edges[1:], strict=True):
        yield int(block[low]), chunk, int(high - low), keys[low:high].astype("<u8").tobytes()


def sorted_keys(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs in order, the place of each input pair among them, and how often each occurs."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.cumsum(new) - 1
    place = np.empty(len(a), np.int64)
    place[order] = number
    return np.stack([a[new], b[new]], axis=1), place, np.bincount(number, minlength=int(new.sum()))


def merge_exact(table: pa.Table) -> pa.Table:
    """For the keys of one block, an answer to each message: for every key sent, whether another chunk sent it."""
    sent = list(zip(table.column("chunk").to_pylist(), table.column("n").to_pylist(), table.column("data").to_pylist(), strict=True))
    keys = np.concatenate([np.frombuffer(data, "<u8").reshape(-1, 2) for _, _, data in sent])
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    same = (keys[order][1:] == keys[order][:-1]).all(axis=1)
    repeated = np.zeros(len(keys), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    ends = np.cumsum([n for _, n, _ in sent])
    block = table.column("block")[0].as_py()
    return messages((block, chunk, n, np.packbits(repeated[end - n : end]).tobytes()) for (chunk, n, _), end in zip(sent, ends, strict=True))


def exact_repeated(answers: pa.Table) -> np.ndarray:
    """The answers to a chunk's exact messages, in the order of its keys."""
    found = _answers(answers)
    return np.concatenate([found[block] for block in sorted(found)]) if found else np.zeros(0, bool)
