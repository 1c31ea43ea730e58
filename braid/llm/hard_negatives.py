"""Hard negatives: for every anchor and positive, the best rows of other labels in a window of scores below the positive's.

Anchors and candidates are cut into blocks; each pair of blocks is one tile, whose scores are one product of integer matrices by
Strassen's recursion. A tile keeps a bounded heap per anchor (its best rows of the same label) or, in a second pass, per anchor and
positive (its best rows of other labels inside the window that the positive's score opens). Heaps merge by taking the best of
both, which Spark does before and after the shuffle (a row number limited within groups). Every anchor meets every row, and no
task holds more than a tile and its heaps.

Scores are inner products of ``floor(256 x)`` components; a shorter vector counts as if zeros followed. Higher scores come first,
then smaller ids. Rows with a null id, label or vector, or with a component that is null, infinite or not a number, take no part;
those of an anchor's own id are neither its positives nor its negatives. Repeated rows count each. Components whose products
could leave 64 bits are an error. No rows, no pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braid.llm.strassen import product
from braid.shared import written

SCALE = 256
# Rows of a block: anchors, candidates; and of the part of a tile that is scored at once.
ANCHORS, CANDIDATES = 1024, 8192
PART = (512, 4096)
# The sum of the products' sizes must stay below this, so that percentages of a score fit 64 bits as well.
LARGEST = 2**63 // 128


def quantised(rows: DataFrame, id_col: str, label_col: str, vector_col: str, *more: str) -> DataFrame:
    """``id``, ``label`` and ``v`` (whole numbers) of the rows that take part, and ``more`` columns."""
    x = F.col(vector_col)
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) < float("inf")))
    rows = rows.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & x.isNotNull() & fine)
    whole = F.transform(x, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")))
    # A sum of n products of numbers up to m stays below n m^2.
    size = F.aggregate(x, F.lit(0.0), lambda m, c: F.greatest(m, F.abs(c.cast("double")) * SCALE + 1))
    checked = F.when(F.size(x) * size * size < LARGEST, whole).otherwise(F.raise_error(F.lit("a vector's components are too large for scores of 64 bits")))
    return rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(label_col).cast("bigint").alias("label"), checked.alias("v"), *more)


def hard_negatives(
    rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
    id_col: str = "vec_id", label_col: str = "label", vector_col: str = "embedding",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score. Negatives of a positive score ``low`` to ``high``
    percent of what it scores."""
    # Numbered and written: blocks are dealt by these numbers, alike in both passes, also among rows that are alike.
    marked = quantised(rows.withColumn("_is_anchor", F.coalesce(is_anchor, F.lit(False))), id_col, label_col, vector_col, "_is_anchor")
    numbered = written(marked.withColumn("at", F.monotonically_increasing_id()), "vectors")
    anchors = numbered.filter("_is_anchor").select("at", "id", "label", "v")
    n_anchors, n_all = anchors.count(), numbered.count()
    blocks = (max(1, -(-n_anchors // ANCHORS)), max(1, -(-n_all // CANDIDATES)))

    best = _tiles(anchors, numbered, blocks, _Same(positives))
    order = [F.desc("score"), F.asc("other")]
    best = best.withColumn("k", F.row_number().over(Window.partitionBy("at").orderBy(*order))).filter(F.col("k") <= positives)
    best = written(best.select("at", "id", "k", F.col("other").alias("positive_id"), F.col("score").alias("positive_score")), "positives")
    # At most ``positives`` rows each.
    opened = best.groupBy(F.col("at").alias("of")).agg(F.sort_array(F.collect_list(F.struct("k", "positive_score"))).alias("w"))
    windows = anchors.join(opened, F.col("at") == F.col("of")).select("at", "id", "label", "v", F.col("w.k").alias("ks"), F.col("w.positive_score").alias("scores"))

    found = _tiles(windows, numbered, blocks, _Windows(negatives, low, high))
    place = F.row_number().over(Window.partitionBy("at", "k").orderBy(*order))
    found = found.withColumn("rank", place).filter(F.col("rank") <= negatives).withColumnsRenamed({"at": "found_at", "k": "found_k", "id": "anchor_id"})
    found = found.join(best.select("at", "k", "positive_id", "positive_score"), (F.col("found_at") == F.col("at")) & (F.col("found_k") == F.col("k")))
    return found.select("anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def _tiles(anchors: DataFrame, candidates: DataFrame, blocks: tuple[int, int], pick) -> DataFrame:
    """Every block of anchors with every block of candidates: at, id, k, other and score of what ``pick`` takes from a tile."""
    deal = lambda n: F.pmod(F.xxhash64("at"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.withColumns({"tile_row": deal(blocks[0])}).withColumn("tile_column", every(blocks[1]))
    # Names of their own, for both sides come from one table.
    right = candidates.select(F.col("id").alias("c_id"), F.col("label").alias("c_label"), F.col("v").alias("c_v"), deal(blocks[1]).alias("of_column")).withColumn("of_row", every(blocks[0]))

    def run(one: pa.Table, other: pa.Table) -> pa.Table:
        out = [pa.table({"at": pa.array([], pa.int64()), "id": pa.array([], pa.int64()), "k": pa.array([], pa.int32()), "other": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})]
        if len(one) and len(other):
            # By id, so that of equal scores the first is the one with the smallest id.
            other = other.sort_by("c_id")
            ids, labels = (other.column(c).to_numpy() for c in ("c_id", "c_label"))
            a, b = _matrices(one.column("v"), other.column("c_v"))
            for r in range(0, len(one), PART[0]):
                part = one.slice(r, PART[0])
                at, own, own_labels = (part.column(c).to_numpy() for c in ("at", "id", "label"))
                for c in range(0, len(ids), PART[1]):
                    cut = slice(c, c + PART[1])
                    scores = product(a[r : r + PART[0]], b[:, cut])
                    others = ids[cut][None, :] != own[:, None]
                    alike = labels[cut][None, :] == own_labels[:, None]
                    for k, line, column, score in pick(scores, others, alike, part):
                        out.append(pa.table({"at": at[line], "id": own[line], "k": k.astype(np.int32), "other": ids[cut][column], "score": score}))
        return pa.concat_tables(out)

    return left.groupBy("tile_row", "tile_column").cogroup(right.groupBy("of_row", "of_column")).applyInArrow(run, "at bigint, id bigint, k int, other bigint, score bigint")


def _matrices(anchors: pa.ChunkedArray, candidates: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Anchors as rows, candidates as columns, with zeros where vectors are shorter than the longest."""
    lists = [pa.concat_arrays(column.chunks) for column in (anchors, candidates)]
    sizes = [np.diff(column.offsets.to_numpy()) for column in lists]
    width = max(1, *(int(size.max()) for size in sizes))
    out = []
    for column, size in zip(lists, sizes, strict=True):
        matrix = np.zeros((len(column), width), np.int64)
        matrix[np.arange(width) < size[:, None]] = column.flatten().to_numpy()
        out.append(matrix)
    return out[0], np.ascontiguousarray(out[1].T)


def _heaps(scores: np.ndarray, allowed: np.ndarray, size: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The ``size`` best allowed columns of every row: line, column and score, best ones first."""
    left = np.where(allowed, scores, -LARGEST)
    every = np.arange(len(left))
    for _ in range(min(size, left.shape[1])):
        column = left.argmax(axis=1)
        best = left[every, column]
        line = np.flatnonzero(best > -LARGEST)
        if not len(line):
            return
        yield line, column[line], best[line]
        left[every, column] = -LARGEST


class _Same:
    """Rows of the anchor's label."""

    def __init__(self, size: int):
        self.size = size

    def __call__(self, scores: np.ndarray, others: np.ndarray, alike: np.ndarray, part: pa.Table) -> Iterator[tuple]:
        for line, column, score in _heaps(scores, others & alike, self.size):
            yield np.zeros(len(line)), line, column, score


class _Windows:
    """Rows of other labels, once for each of the anchor's positives, within the window that its score opens."""

    def __init__(self, size: int, low: int, high: int):
        self.size, self.low, self.high = size, low, high

    def __call__(self, scores: np.ndarray, others: np.ndarray, alike: np.ndarray, part: pa.Table) -> Iterator[tuple]:
        ks, opened = part.column("ks").to_pylist(), part.column("scores").to_pylist()
        percent, allowed = 100 * scores, others & ~alike
        for i in range(max(map(len, ks))):
            rows = np.array([r for r, k in enumerate(ks) if len(k) > i])
            k, score = (np.array([x[r][i] for r in rows], np.int64) for x in (ks, opened))
            inside = allowed[rows] & (self.low * score[:, None] <= percent[rows]) & (percent[rows] <= self.high * score[:, None])
            for line, column, found in _heaps(scores[rows], inside, self.size):
                yield k[line], rows[line], column, found
