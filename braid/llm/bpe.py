"""Byte-level BPE encoding and decoding by a file of ranks.

Texts are cut into units that no piece crosses; each distinct unit is encoded once per worker. The pieces of new units go into
padded matrices, one for each range of lengths: a row is a piece, an entry a token. In each round every row merges its leftmost
pair of least rank, found by a hashed table of pairs, and is moved together; rows without a pair leave the matrix. Pieces beyond
the longest matrix, whose rows would cost the square of their length, take the same pairs in the same order from a heap.

Null text is empty and has no ids. Ids that the file does not have are an error when decoded. Repeated rows are encoded alike.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braid.llm.pieces import split_texts
from braid.llm.rolling import slices

MOST_UNITS = 700_000
WIDTHS = (2, 4, 8, 12, 16, 24, 32, 64, 128, 256)
# Rows that are decoded at a time.
SLICE = 256
_NONE = np.int32(np.iinfo(np.int32).max)
# White space of the pattern.
_WHITE = frozenset([*map(chr, [*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])])
# White space but for blank and line feed.
_RARE = re.compile(f"[{''.join(_WHITE - {' ', chr(10)})}]")


class PairTable:
    """Ranks of pairs of tokens in an open hash table, looked up for whole arrays."""

    def __init__(self, pairs: list[tuple[int, int, int]]):
        """``pairs``: left, right and rank."""
        bits = max(4, (4 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.ranks = np.full(1 << bits, _NONE, np.int32)
        keys = np.array([left << 32 | right for left, right, _ in pairs], np.int64)
        values = np.array([rank for _, _, rank in pairs], np.int32)
        slots = self._slots(keys)
        while len(keys):
            free = self.keys[slots] == -1
            # Of several keys for a free slot one gets it; the others go on to the next.
            self.keys[slots[free]] = keys[free]
            mine = self.keys[slots] == keys
            self.ranks[slots[mine]] = values[mine]
            keys, values, slots = keys[~mine], values[~mine], (slots[~mine] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def look_up(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair; the greatest number where there is none, as for a negative entry."""
        keys = left.astype(np.int64) << 32 | right.astype(np.int64)
        out = np.full(keys.shape, _NONE, np.int32)
        todo = np.flatnonzero((left >= 0) & (right >= 0))
        keys = keys.ravel()[todo]
        slots = self._slots(keys)
        flat = out.ravel()
        while len(todo):
            seen = self.keys[slots]
            hit = seen == keys
            flat[todo[hit]] = self.ranks[slots[hit]]
            on = ~hit & (seen != -1)
            todo, keys, slots = todo[on], keys[on], (slots[on] + 1) & self.mask
        return flat.reshape(out.shape)


def merged(tokens: np.ndarray, pairs: PairTable, made: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Merge rows of tokens, -1 after their end: row numbers, numbers of ids, and ids, of rows as they are done. ``made`` has the
    token that a merge of each rank makes; without it that is the rank."""
    rows = np.arange(len(tokens))
    ranks = pairs.look_up(tokens[:, :-1], tokens[:, 1:])
    columns = np.arange(tokens.shape[1])
    while len(rows):
        at = ranks.argmin(axis=1)
        best = ranks[np.arange(len(rows)), at]
        done = best == _NONE
        if done.any():
            left = tokens[done]
            yield rows[done], (left >= 0).sum(axis=1), left[left >= 0]
            rows, tokens, ranks, at, best = rows[~done], tokens[~done], ranks[~done], at[~done], best[~done]
            if not len(rows):
                return
        # The pair becomes one token and what follows moves up; only the ranks on both sides of it are new.
        k = np.arange(len(rows))
        moved = np.minimum(columns + (columns > at[:, None]), len(columns) - 1)
        tokens = np.take_along_axis(tokens, moved, axis=1)
        tokens[:, -1] = -1
        tokens[k, at] = best if made is None else made[best]
        ranks = np.take_along_axis(ranks, np.minimum(moved[:, :-1], ranks.shape[1] - 1), axis=1)
        ranks[:, -1] = _NONE
        after = np.where(at + 1 < len(columns), tokens[k, np.minimum(at + 1, len(columns) - 1)], -1)
        inside = at < ranks.shape[1]
        ranks[k[inside], at[inside]] = pairs.look_up(tokens[k, at], after)[inside]
        some = at > 0
        ranks[k[some], at[some] - 1] = pairs.look_up(tokens[k[some], at[some] - 1], tokens[k[some], at[some]])


class Encoder:
    def __init__(self, path: str):
        with open(path, "rb") as file:
            lines = [line.split() for line in file if line.strip()]
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        ranks = self.ranks
        self.pairs = PairTable([(ranks[t[:k]], ranks[t[k:]], rank) for t, rank in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks])
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token
        self.token_bytes = np.frombuffer(b"".join(tokens), np.uint8)
        self.token_at = np.concatenate([[0], np.cumsum([len(t) for t in tokens])])
        self.forget()

    def forget(self) -> None:
        self.number: dict[str, int] = {}
        self.flat, self.edges = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces in one array, in the order of the pieces, and how many each has."""
        whole = np.fromiter((self.ranks.get(piece, -1) for piece in pieces), np.int64, len(pieces))
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        # Numbers of pieces, how many ids each has, and the ids, as they come.
        parts = [(np.flatnonzero(whole >= 0), np.ones(int((whole >= 0).sum()), np.int64), whole[whole >= 0])]
        todo = whole < 0
        for low, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            rows = np.flatnonzero(todo & (lengths > low) & (lengths <= width))
            if len(rows):
                data = np.frombuffer(b"".join([pieces[i].ljust(width, b"\0") for i in rows.tolist()]), np.uint8).reshape(len(rows), width)
                tokens = np.where(np.arange(width) < lengths[rows, None], self.of_byte[data], np.int32(-1))
                parts += [(rows[done], n, ids) for done, n, ids in merged(tokens, self.pairs)]
        for i in np.flatnonzero(todo & (lengths > WIDTHS[-1])).tolist():
            ids = self._by_heap(pieces[i])
            parts.append((np.array([i]), np.array([len(ids)]), ids))
        number, sizes, flat = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(number)
        starts = np.cumsum(sizes) - sizes
        return gathered(flat, starts[order], sizes[order]).astype(np.int32), sizes[order]

    def _by_heap(self, piece: bytes) -> np.ndarray:
        tokens = [piece[i : i + 1] for i in range(len(piece))]
        after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
        heap = []

        def offer(i: int) -> None:
            if i >= 0 and after[i] < len(piece) and (rank := self.ranks.get(tokens[i] + tokens[after[i]])) is not None:
                heapq.heappush(heap, (rank, i, tokens[i], tokens[after[i]]))

        for i in range(len(piece) - 1):
            offer(i)
        while heap:
            _, i, left, right = heapq.heappop(heap)
            if tokens[i] == left and left and after[i] < len(piece) and tokens[after[i]] == right:
                gone = after[i]
                tokens[i], tokens[gone] = left + right, b""
                after[i] = after[gone]
                if after[i] < len(piece):
                    before[after[i]] = i
                offer(before[i])
                offer(i)
        return np.array([self.ranks[t] for t in tokens if t], np.int32)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        split = [units(text) for text in texts]
        all_units = set().union(*split)
        new = all_units.difference(self.number)
        if self.number and len(self.number) + len(new) > MOST_UNITS:
            self.forget()
            new = all_units
        if new:
            self._learn(list(new))
        out = []
        for found in split:
            which = np.fromiter(map(self.number.__getitem__, found), np.int64, len(found))
            first = self.edges[which]
            out.append(gathered(self.flat, first, self.edges[which + 1] - first))
        return out

    def _learn(self, new: list[str]) -> None:
        # Units that follow a blank are kept without it and get it here.
        data, starts, counts = split_texts([unit[1:] if unit[:1] == " " else f" {unit}" for unit in new])
        real = np.ones(len(starts) - 1, bool)
        real[np.cumsum(counts + 1) - 1] = False
        pieces = [data[a:b] for a, b in zip(starts[:-1][real].tolist(), starts[1:][real].tolist(), strict=True)]
        distinct = {piece: k for k, piece in enumerate(dict.fromkeys(pieces))}
        ids, sizes = self.encode_pieces(list(distinct))
        which = np.fromiter(map(distinct.__getitem__, pieces), np.int64, len(pieces))
        per_unit = np.concatenate([[0], np.cumsum(sizes[which])])[np.cumsum(counts)]
        self.number.update(zip(new, range(len(self.number), len(self.number) + len(new)), strict=True))
        self.edges = np.concatenate([self.edges, len(self.flat) + per_unit])
        self.flat = np.concatenate([self.flat, gathered(ids, (np.cumsum(sizes) - sizes)[which], sizes[which])])

    def decode(self, ids: np.ndarray) -> bytes:
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.token_at) - 1):
            raise ValueError("an id is not in the file of ranks")
        first = self.token_at[ids]
        return gathered(self.token_bytes, first, self.token_at[ids + 1] - first).tobytes()


def gathered(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` from each start, one after another."""
    ends = np.cumsum(lengths)
    return values[np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)]


def units(text: str) -> list[str]:
    """Parts of a text that no piece crosses: a cut before every single blank that stands between other characters than white
    space. Units go without that blank; the first, which follows none, has a blank in front to tell it from the others."""
    if not text:
        return []
    out = text.split(" ")
    if "" in out or " \n" in text or "\n " in text or _RARE.search(text):
        joined = [out[0]]
        for unit in out[1:]:
            last = joined[-1]
            if unit and last and unit[0] not in _WHITE and last[-1] not in _WHITE:
                joined.append(unit)
            else:
                joined[-1] = f"{last} {unit}"
        out = joined
    out[0] = f" {out[0]}"
    return out


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def encode_texts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id and ``ids``, the tokens of its text."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                ids = encoder(path).encode(part.column("text").fill_null("").to_pylist())
                at = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate([np.zeros(0, np.int32), *ids])))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists], names=["id", "ids"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, ids array<int>").withColumnRenamed("id", id_col)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: its id, ``ids`` and ``decoded``, the bytes that the ids stand for. Null ids are none."""
    rows = encoded.select(F.col(id_col).alias("id"), F.col(ids_col).alias("ids"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), SLICE):
                part = batch.slice(low, SLICE)
                lists = part.column("ids")
                flat, at = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                decoded = [encoder(path).decode(flat[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, pa.array(decoded, pa.binary())], names=["id", "ids", "decoded"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, ids array<int>, decoded binary").withColumnRenamed("id", id_col)
