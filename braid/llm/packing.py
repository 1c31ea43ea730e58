"""Mixture-controlled packing: token sequences of one length, each filled from all sources in target proportions.

Texts are tokenised once and dealt into shards of bounded size by a hash of the row, so that a shard holds all sources in
about their global shares, however large one source is. Within a shard, deficit round-robin serves the source queues: each
window credits every source with its share of the window, and the source with the largest deficit gives its next tokens, at
least ``quantum`` at a time, a document being cut where the window is full. What a source gave too much or too little
carries over to the next window. It carries over between shards, too: a shard uses up all its tokens, so that the deficits
with which the next one starts are running sums of a small table of counts by shard and source, and all shards still run
side by side.

The last tokens of a shard do not fill a window; they go to sequences whose lengths are powers of two and need no padding.

Null and empty texts become the end token alone. A null source is a source of its own. Repeated rows are packed each; their
pieces tell themselves apart by sequence and offset only. No rows, no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.llm.word_tokens import TextEncoder
from braid.shared import written

LENGTH = 2048
# A source gives at least so many tokens at a time, unless its document or the window ends before.
QUANTUM = 256
# Bytes of text per shard, on average.
SHARD_BYTES = 8 << 20


@cache
def _encoder(path: str, end_id: int) -> TextEncoder:
    return TextEncoder(path, end_id)


def tokenised(docs: DataFrame, path: str, end_id: int, shards: int, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """id, source, shard, n_tokens and ids (little-endian unsigned, of 16 bits where these suffice, else of 32) of every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).alias("text"))
    rows = rows.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)))
    id_type = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, ids, at in _encoder(path, end_id).encode_blocks(batch.column("text"), ended=True):
                part = batch.slice(first, len(at) - 1)
                offsets = pa.py_buffer((at * ids.itemsize).astype(np.int32))
                held = pa.Array.from_buffers(pa.binary(), len(part), [None, offsets, pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("source"), part.column("shard"), pa.array(np.diff(at)), held], names=["id", "source", "shard", "n_tokens", "ids"])
        # Workers go on to other stages: they should not keep what this one needed.
        pa.default_memory_pool().release_unused()

    return rows.mapInArrow(run, f"id {id_type}, source string, shard bigint, n_tokens bigint, ids binary")


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4").astype("<u4")


def fill_windows(sizes: list[list[int]], shares: np.ndarray, deficits: np.ndarray, length: int, quantum: int) -> Iterator[list[tuple[int, int, int, int]]]:
    """Windows as lists of (source, document, start, tokens). ``sizes``: the documents of each source's queue in order."""
    deficits = deficits.astype(float).copy()
    at = [[0, 0] for _ in sizes]
    live = [bool(queue) for queue in sizes]
    rest = sum(map(sum, sizes))
    while rest:
        size = min(length, rest)
        room, window = size, []
        deficits += shares * size
        while room:
            source = max((s for s in range(len(sizes)) if live[s]), key=lambda s: deficits[s])
            document, start = at[source]
            whole = sizes[source][document] - start
            take = min(whole, room, max(quantum, int(deficits[source])))
            window.append((source, document, start, take))
            room -= take
            deficits[source] -= take
            at[source] = [document, start + take] if take < whole else [document + 1, 0]
            live[source] = at[source][0] < len(sizes[source])
        rest -= size
        yield window


def _sequences(window: list[tuple[int, int, int, int]], length: int) -> Iterator[list[tuple[int, int, int, int, int]]]:
    """The window's pieces with their offsets; a window that is not full is cut into powers of two."""
    left = sum(piece[3] for piece in window)
    pieces = list(reversed(window))
    while left:
        size = length if left >= length else 1 << (left.bit_length() - 1)
        offset, sequence = 0, []
        while offset < size:
            source, document, start, tokens = pieces.pop()
            take = min(tokens, size - offset)
            sequence.append((source, document, start, take, offset))
            if take < tokens:
                pieces.append((source, document, start + take, tokens - take))
            offset += take
        left -= size
        yield sequence


def _pack_shard(rows: pa.Table, credit: dict, length: int, quantum: int) -> dict[str, list]:
    shard = rows.column("shard")[0].as_py()
    ids, sources, data = rows.column("id").to_pylist(), rows.column("source").to_pylist(), rows.column("ids").to_pylist()
    # In order of content: the same shard is packed alike wherever and whenever its task runs.
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i], data[i]))
    names = sorted(credit, key=lambda s: (s is None, s or ""))
    queues = [[i for i in order if sources[i] == name] for name in names]
    sizes = rows.column("n_tokens").to_pylist()
    tokens = {i: _wide(data[i], sizes[i]) for i in order}
    shares, deficits = (np.array([credit[name][k] for name in names]) for k in (0, 1))
    out: dict[str, list] = {name: [] for name in ("id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids")}
    sequence_id = shard << 32
    for window in fill_windows([[len(tokens[i]) for i in queue] for queue in queues], shares, deficits, length, quantum):
        for sequence in _sequences(window, length):
            for source, document, start, take, offset in sequence:
                i = queues[source][document]
                piece = tokens[i][start : start + take].tobytes()
                for name, value in zip(out, (ids[i], start, take, zlib.crc32(piece), len(tokens[i]), sequence_id, offset, piece), strict=True):
                    out[name].append(value)
            sequence_id += 1
    return out


def pack(
    docs: DataFrame, path: str, end_id: int, mixture: dict[str | None, float] | None = None, length: int = LENGTH, quantum: int = QUANTUM,
    shard_bytes: int = SHARD_BYTES, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", with_ids: bool = True,
) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset and ``ids`` (its token ids, unless
    ``with_ids`` is off).

    ``path`` is a tokenizer file; ``end_id`` follows every document. ``mixture`` gives the target share of each source; by
    default each source's share of all tokens. Sources that run out leave their part of a window to the others.
    """
    size = docs.select(F.sum(F.octet_length(F.col(text_col).cast("string")))).first()[0] or 0
    shards = max(1, -(-size // shard_bytes))
    # Written, so that counting and packing tokenise each text once.
    rows = written(tokenised(docs, path, end_id, shards, id_col, text_col, source_col), "tokens")
    counts = rows.groupBy("shard", "source").agg(F.sum("n_tokens").alias("n"))
    owed = _credits(counts, mixture)
    numbers = ["start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    fields = [T.StructField(id_col, docs.schema[id_col].dataType), *[T.StructField(name, T.LongType()) for name in numbers]]
    if with_ids:
        fields.append(T.StructField("ids", T.BinaryType()))

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        credit = {row["name"]: (row["share"], row["deficit"]) for row in right.to_pylist()}
        out = _pack_shard(left, credit, length, quantum)
        columns = {id_col: pa.array(out["id"], left.schema.field("id").type)}
        columns |= {name: pa.array(out[name], pa.int64()) for name in numbers}
        return pa.table(columns | ({"ids": pa.array(out["ids"], pa.binary())} if with_ids else {}))

    return rows.groupBy("shard").cogroup(owed.groupBy("at")).applyInArrow(run, T.StructType(fields))


def _credits(counts: DataFrame, mixture: dict[str | None, float] | None) -> DataFrame:
    """Per shard and source in it: the target share, and the deficit that all shards before leave behind, which is the share
    of their tokens that the source should have had less what it had."""
    totals = counts.groupBy(F.col("source").alias("of")).agg(F.sum("n").alias("w"))
    if mixture is not None:
        wanted = counts.sparkSession.createDataFrame([(k, float(v)) for k, v in mixture.items()], "named string, wanted double")
        # A source that the mixture does not name has no share; it is used where others have run out.
        totals = totals.join(wanted, F.col("of").eqNullSafe(F.col("named")), "left").select("of", F.coalesce("wanted", F.lit(0.0)).alias("w"))
    shares = totals.select("of", F.coalesce(F.try_divide(F.col("w"), F.sum("w").over(Window.partitionBy())), F.lit(0.0)).alias("share"))
    # One row per shard: few enough for the one task that a running sum over all of them takes.
    before = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    sizes = counts.groupBy(F.col("shard").alias("s")).agg(F.sum("n").alias("s_n")).select("s", F.coalesce(F.sum("s_n").over(before), F.lit(0)).alias("all_before"))
    own = Window.partitionBy("name").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    owed = counts.select(F.col("shard").alias("at"), F.col("source").alias("name"), "n").select("at", "name", F.coalesce(F.sum("n").over(own), F.lit(0)).alias("had_before"))
    joined = owed.join(sizes, F.col("at") == F.col("s")).join(shares, F.col("name").eqNullSafe(F.col("of")))
    return joined.select("at", "name", "share", (F.col("share") * F.col("all_before") - F.col("had_before")).alias("deficit"))
