"""Substring dedup: words in a window of words that stands anywhere else go.

Two passes decide. A count-min sketch (``sketch``) of all windows estimates which are repeated, never too few; a second pass
groups exactly, by 128-bit hashes, only those. A third walks the texts and drops the words that a repeated window covers. The
three passes read one and the same shuffle of the texts into chunks.

Windows are judged on the input, the same text included. Null text has no words. Of repeated rows each one's windows stand
elsewhere, so that all their words in full windows go. Texts shorter than a window keep all words.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braid.llm import sketch
from braid.llm.rolling import blocks, window_hashes

WINDOW = 35


def _windows(texts: pa.ChunkedArray, size: int, seeds: tuple[int, ...]) -> list[np.ndarray]:
    """The hashes of all windows of the texts, in order, one array per seed."""
    found: list[list[np.ndarray]] = [[] for _ in seeds]
    for block in blocks(texts):
        at, _ = block.windows(size)
        for out, seed in zip(found, seeds, strict=True):
            out.append(window_hashes(block.word_hashes(seed), at, size, seed))
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in found]


def _kept(texts: pa.ChunkedArray, size: int, repeated: np.ndarray) -> tuple[list[int], list[int], list[bytes]]:
    """Per text: its words, the words that repeated windows cover, and the words left, joined by one blank."""
    n_words, n_removed, kept, done = [], [], [], 0
    for block in blocks(texts):
        at, _ = block.windows(size)
        hit = at[repeated[done : done + len(at)]]
        done += len(at)
        cover = np.zeros(len(block.starts) + size + 1, np.int64)
        cover[hit] += 1
        cover[hit + size] -= 1
        gone = np.cumsum(cover)[: len(block.starts)] > 0
        removed = np.concatenate([[0], np.cumsum(gone)])
        n_words += np.diff(block.word_at).tolist()
        n_removed += np.diff(removed[block.word_at]).tolist()
        whole = block.data.tobytes()
        keep = ~gone
        starts, ends = block.starts[keep].tolist(), block.ends[keep].tolist()
        edge = (block.word_at - removed[block.word_at]).tolist()
        words = [whole[a:b] for a, b in zip(starts, ends, strict=True)]
        kept += [b" ".join(words[a:b]) for a, b in zip(edge[:-1], edge[1:], strict=True)]
    return n_words, n_removed, kept


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_words``, ``n_removed`` and ``kept_text``."""
    size = sketch.text_bytes(docs, text_col)
    bits, n_blocks = sketch.cell_bits(size), max(1, -(-size // sketch.EXACT_BLOCK_BYTES))
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    rows = rows.select("id", "text", sketch.chunk_of(size, "id", "text"))
    id_type = rows.schema["id"].dataType.simpleString()
    by_chunk = rows.groupBy("chunk")

    def sketched(table: pa.Table) -> pa.Table:
        (first,) = _windows(table.column("text"), window, (0,))
        return sketch.messages(sketch.partial_sketch(table.column("chunk")[0].as_py(), first, bits))

    estimates = by_chunk.applyInArrow(sketched, sketch.MESSAGE).groupBy("block").applyInArrow(sketch.merge_sketches, sketch.MESSAGE)

    def candidates(table: pa.Table, answers: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        first, second = _windows(table.column("text"), window, (0, 1))
        maybe = sketch.estimated_repeated(first, answers, bits)
        return (maybe, *sketch.sorted_keys(first[maybe], second[maybe]))

    def asked(table: pa.Table, answers: pa.Table) -> pa.Table:
        if not table.num_rows:
            return sketch.messages(iter(()))
        _, keys, _, _ = candidates(table, answers)
        return sketch.messages(sketch.exact_messages(table.column("chunk")[0].as_py(), keys, n_blocks))

    exact = by_chunk.cogroup(estimates.groupBy("chunk")).applyInArrow(asked, sketch.MESSAGE).groupBy("block").applyInArrow(sketch.merge_exact, sketch.MESSAGE)
    # Both kinds of answers come to the chunk, told apart by a flag.
    answers = estimates.select("*", F.lit(False).alias("exact")).unionAll(exact.select("*", F.lit(True).alias("exact")))

    def finished(table: pa.Table, answers: pa.Table) -> pa.Table:
        is_exact = answers.column("exact").combine_chunks() if answers.num_rows else pa.array([], pa.bool_())
        maybe, keys, place, n = candidates(table, answers.filter(pc.invert(is_exact)))
        repeated = np.zeros(len(maybe), bool)
        repeated[maybe] = (sketch.exact_repeated(answers.filter(is_exact)) | (n > 1))[place]
        n_words, n_removed, kept = _kept(table.column("text"), window, repeated)
        return pa.table({"id": table.column("id"), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()), "kept_text": pa.array(kept, pa.binary()).cast(pa.string())})

    out = by_chunk.cogroup(answers.groupBy("chunk")).applyInArrow(finished, f"id {id_type}, n_words bigint, n_removed bigint, kept_text string")
    return out.withColumnRenamed("id", id_col)
