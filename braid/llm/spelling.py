"""Groups of spelling variants: words one edit apart, found by pivotal grams.

Bigrams are ranked from rare to frequent over all distinct words. A word's prefix is its three rarest bigrams (and further
places of the last of them); its pivots are two of the first three that do not overlap, the pair of least frequency by dynamic
programming. One edit leaves one of two disjoint grams whole. So of two words one edit apart, the one whose prefix ends with the
rarer gram has a pivot in the other's prefix: pivots are looked up among prefixes.

Position limits make the look-up narrow. The edit lies behind the left pivot, and all up to and with this gram is the same, at the
same distance from the start; or it lies before the right pivot, and all from this gram on is the same, at the same distance from
the end. Of what remains, the half that the edit is not in is the same, too. These places and parts, hashed, are the keys of the
index. Letters in common, lengths and at last a comparison of the words decide about what a key brings together.

Words are maximal runs of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z in lower case. A null text has none, a null id counts as empty in the
checksum that corrupts some of them; repeated rows count each. Ties among near words of equal count go to the first in
code-point order. No rows, no words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braid.llm.rolling import mix, window_hashes
from braid.operators.skew import heavy_hashes, partitions, skew_join
from braid.shared import discard, written

# What a word is, and which words are corrupted.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
CORRUPTED = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3

PREFIX = 3
# Rows of the index taken at once, pairs compared at once, and the longest words that are compared in matrices.
ROWS, PAIRS, WIDTH = 1 << 17, 1 << 19, 40
_LETTERS = np.random.default_rng(97).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)


def corrupted(run: Column, doc_id: Column) -> Column:
    """The run, or for one in 97 checksums of id and run, the run without one of its letters."""
    checksum = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (checksum % F.length(run)).cast("int")
    return F.when(checksum % CORRUPTED == 0, F.concat(run.substr(F.lit(1), at), run.substr(at + 2, F.length(run)))).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word`` and ``n``, the number of its occurrences in all texts, of long enough and frequent enough words."""
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(RUN), F.lit(0))).alias("run"))
    # A run loses one letter at most: shorter ones can be left out before anything is worked out for them.
    runs = runs.filter(F.length("run") >= LEAST_LENGTH).withColumn("run", F.translate("run", UPPER, LOWER))
    words = runs.select(corrupted(F.col("run"), F.col("id")).alias("word")).filter(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= LEAST_COUNT)


def gram_counts(words: DataFrame) -> np.ndarray:
    """Occurrences of every bigram in distinct words, by its two letters' codes. There are at most 90 letters."""
    grams = words.select(F.explode(F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring("word", i, F.lit(2)))).alias("gram"))
    counts = np.zeros(1 << 16, np.int64)
    for row in grams.groupBy("gram").count().collect():
        first, second = row["gram"].encode("latin-1")
        counts[first << 8 | second] = row["count"]
    return counts


def _letters(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All letters as one array of bytes, and where each word starts."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8), np.concatenate([[0], np.cumsum(lengths)])


def prefixes(data: np.ndarray, at: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For words of four letters or more: the word and place of every prefix gram, each word's two pivots (n, 2) from left to
    right, and the rank of the last gram of its prefix."""
    rank = np.empty(1 << 16, np.int64)
    rank[np.lexsort((np.arange(1 << 16), counts))] = np.arange(1 << 16)
    lengths = np.diff(at)
    word = np.repeat(np.arange(len(lengths)), lengths - 1)
    place = np.arange(len(word)) - np.repeat(at[:-1] - np.arange(len(lengths)), lengths - 1)
    start = at[word] + place
    gram = data[start].astype(np.int64) << 8 | data[start + 1]
    order = np.lexsort((place, rank[gram], word))
    first = order[(at[:-1] - np.arange(len(lengths)))[:, None] + np.arange(PREFIX)]
    last = rank[gram[first[:, -1]]]
    chosen = np.sort(first, axis=1)
    where, cost = place[chosen], counts[gram[chosen]]
    # By dynamic programming: the least cost of one gram up to each, then of two that do not overlap.
    least, pivots = np.full(len(lengths), np.iinfo(np.int64).max), np.zeros((len(lengths), 2), np.int64)
    for j in range(PREFIX):
        one, left = np.full(len(lengths), np.iinfo(np.int64).max), np.zeros(len(lengths), np.int64)
        for i in range(j):
            better = (where[:, i] + 2 <= where[:, j]) & (cost[:, i] < one)
            one, left = np.where(better, cost[:, i], one), np.where(better, where[:, i], left)
        both = np.where(one < np.iinfo(np.int64).max, one + cost[:, j], one)
        better = both < least
        least = np.where(better, both, least)
        pivots[better, 0], pivots[better, 1] = left[better], where[better, j]
    listed = rank[gram] <= last[word]
    return word[listed], place[listed], pivots, last


def _keys(values: np.ndarray, at: np.ndarray, word: np.ndarray, place: np.ndarray, slack: tuple[int, ...], sides: str) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Keys of grams, with the words that they belong to. ``slack`` says by how much the word looked for may be longer."""
    start, end = at[word], at[word + 1]
    hashed = lambda a, b, on: window_hashes(values, a[on], b[on] - a[on])
    tagged = lambda key, tag, distance, on: mix(key + mix(distance[on].astype(np.uint64) * np.uint64(8) + np.uint64(tag)))
    for more in slack:
        if "L" in sides:
            rest = end - start - place - 2 + more
            near, far = rest // 2, rest - rest // 2
            on = (rest >= 0) & (start + place + 2 + near <= end)
            yield tagged(hashed(start, start + place + 2 + near, on), 1, place, on), word[on]
            on = (rest >= 0) & (far <= end - start - place - 2)
            yield tagged(hashed(start, start + place + 2, on) * np.uint64(3) + hashed(end - far, end, on), 2, place, on), word[on]
        if "R" in sides:
            rest = place + more
            near, far = rest // 2, rest - rest // 2
            on = (rest >= 0) & (near <= place)
            yield tagged(hashed(start + place - near, end, on), 3, end - start - place, on), word[on]
            on = (rest >= 0) & (far <= place)
            yield tagged(hashed(start + place, end, on) * np.uint64(3) + hashed(start, start + far, on), 4, end - start - place, on), word[on]


_ENTRY = "key bigint, pivot boolean, last int, n bigint, word string"


def entries(words: DataFrame, counts: np.ndarray) -> DataFrame:
    """The index: a row for every key of a word's prefix grams, and one for every key of its pivots."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            data, at = _letters(batch.column("word").to_pylist())
            values = mix(_LETTERS[data])
            word, place, pivots, last = prefixes(data, at, counts)
            every = np.arange(len(batch))
            found = [(k, w, False) for k, w in _keys(values, at, word, place, (-1, 0, 1), "LR")]
            found += [(k, w, True) for k, w in _keys(values, at, every, pivots[:, 0], (0,), "L")]
            found += [(k, w, True) for k, w in _keys(values, at, every, pivots[:, 1], (0,), "R")]
            key = np.concatenate([k for k, _, _ in found]).view(np.int64)
            of = np.concatenate([w for _, w, _ in found])
            pivot = np.repeat([p for _, _, p in found], [len(k) for k, _, _ in found])
            # Words of neighbouring lengths may ask for the same part.
            order = np.lexsort((key, pivot, of))
            new = np.ones(len(order), bool)
            new[1:] = (key[order][1:] != key[order][:-1]) | (pivot[order][1:] != pivot[order][:-1]) | (of[order][1:] != of[order][:-1])
            for rows in np.array_split(order[new], len(order) // 200_000 + 1):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[rows]), pa.array(pivot[rows]), pa.array(last[of[rows]].astype(np.int32)), batch.column("n").take(pa.array(of[rows])), batch.column("word").take(pa.array(of[rows]))],
                    names=["key", "pivot", "last", "n", "word"],
                )

    return words.select("word", "n").mapInArrow(run, _ENTRY)


def one_edit(a: str, b: str) -> bool:
    """Whether one letter inserted, deleted or replaced, and no less, makes ``b`` of ``a``."""
    a, b = sorted((a, b), key=len)
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((i for i in range(len(a)) if a[i] != b[i]), len(a))
    return a[i + (len(a) == len(b)) :] == b[i + 1 :]


def _near(matrix: np.ndarray, lengths: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``one_edit`` for pairs of rows of a matrix of letters; rows of ``a`` are not longer than those of ``b``."""
    one, other, size = matrix[a], matrix[b], lengths[a]
    inside = np.arange(matrix.shape[1]) < size[:, None]
    differ = (one != other) & inside
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), size)
    shifted = np.zeros_like(other)
    shifted[:, :-1] = other[:, 1:]
    later = ((one != shifted) & inside & (np.arange(matrix.shape[1]) >= first[:, None])).any(axis=1)
    return np.where(lengths[a] == lengths[b], differ.sum(axis=1) == 1, ~later)


def _pairs(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Words one edit apart among the rows of each key; ``table`` holds whole keys, in their order, pivots first."""
    coded = table.column("word").combine_chunks().dictionary_encode()
    coded = coded.combine_chunks() if isinstance(coded, pa.ChunkedArray) else coded
    order = pc.sort_indices(coded.dictionary).to_numpy()
    words, at = coded.dictionary.take(pa.array(order)), np.argsort(order)[coded.indices.to_numpy()]
    n = np.zeros(len(words), np.int64)
    n[at] = table.column("n").to_numpy()
    last = np.zeros(len(words), np.int64)
    last[at] = table.column("last").to_numpy()
    data, edges = _letters(words.to_pylist())
    lengths = np.diff(edges)
    of = np.repeat(np.arange(len(words)), lengths)
    bits = np.zeros(len(words), np.uint64)
    np.bitwise_or.at(bits, of, np.uint64(1) << (data.astype(np.uint64) & np.uint64(63)))
    short = lengths <= WIDTH
    matrix = np.zeros((len(words), WIDTH + 1), np.uint8)
    on = short[of]
    matrix[of[on], (np.arange(len(data)) - edges[:-1][of])[on]] = data[on]

    key, piece, pivot = (table.column(c).to_numpy() for c in ("key", "piece", "pivot"))
    edge = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (piece[1:] != piece[:-1])]))
    group = np.cumsum(np.isin(np.arange(len(key)), edge)) - 1
    pivots = np.add.reduceat(pivot.astype(np.int64), edge)
    first = edge + pivots
    others = np.append(edge[1:], len(key)) - first
    rows = np.flatnonzero(pivot)
    rows = rows[others[group[rows]] > 0]
    load = np.cumsum(others[group[rows]])
    low = 0
    while low < len(rows):
        done = load[low - 1] if low else 0
        high = max(int(np.searchsorted(load, done + PAIRS, "right")), low + 1)
        part = rows[low:high]
        size = others[group[part]]
        a = np.repeat(at[part], size)
        b = at[np.arange(len(a)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first[group[part]], size)]
        good = (a != b) & (last[a] <= last[b]) & (np.abs(lengths[a] - lengths[b]) <= 1) & (np.bitwise_count(bits[a] ^ bits[b]) <= 2)
        a, b = a[good], b[good]
        swap = lengths[a] > lengths[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        fits = short[a] & short[b]
        near = np.zeros(len(a), bool)
        near[fits] = _near(matrix, lengths, a[fits], b[fits])
        near[~fits] = [one_edit(words[i].as_py(), words[j].as_py()) for i, j in zip(a[~fits], b[~fits], strict=True)]
        a, b = np.minimum(a[near], b[near]), np.maximum(a[near], b[near])
        # ``words`` is in code-point order, so that each pair always comes the same way round.
        a, b = np.unique(np.stack([a, b]), axis=1) if len(a) else (a, b)
        yield pa.RecordBatch.from_arrays(
            [words.take(pa.array(a)), pa.array(n[a]), words.take(pa.array(b)), pa.array(n[b])], names=["a", "n_a", "b", "n_b"]
        )
        low = high


def near_words(words: DataFrame) -> DataFrame:
    """``a``, ``n_a``, ``b``, ``n_b``: each pair of ``words`` (word, n) that are one edit apart once, ``a`` before ``b``."""
    tasks = partitions(words)
    # A word makes some twenty rows: what fits one task as words would not as an index.
    index = entries(words.repartition(tasks, "word"), gram_counts(words))
    # A key with more rows than an even share of a task: its pivots are dealt over pieces, its other rows go to each of them.
    heavy, total = heavy_hashes(index, F.col("key"), 1 / (2 * tasks))
    if heavy:
        pieces = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for k, c in heavy.items() for x in (k, 2 * tasks * c // total)]), F.col("key")), F.lit(1)).cast("int")
        own = F.array(F.pmod(F.xxhash64("word"), pieces).cast("int"))
        index = index.withColumn("piece", F.explode(F.when(F.col("pivot"), own).otherwise(F.sequence(F.lit(0), pieces - 1))))
    else:
        index = index.withColumn("piece", F.lit(0))
    index = index.repartition("key", "piece").sortWithinPartitions("key", "piece", F.desc("pivot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, enough = [], 0, ROWS
        for batch in batches:
            held.append(batch)
            size += len(batch)
            if size < enough:
                continue
            # All but the last key of what came so far is whole.
            table = pa.Table.from_batches(held)
            key, piece = table.column("key").to_numpy(), table.column("piece").to_numpy()
            begin = int(np.flatnonzero((key != key[-1]) | (piece != piece[-1]))[-1:].sum() + 1) if key[0] != key[-1] or piece[0] != piece[-1] else 0
            if begin:
                yield from _pairs(table.slice(0, begin))
            held, size = table.slice(begin).to_batches(), size - begin
            enough = max(ROWS, 2 * size)
        if size:
            yield from _pairs(pa.Table.from_batches(held))

    return index.mapInArrow(run, "a string, n_a bigint, b string, n_b bigint").distinct()


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n. A word's form is its most frequent near word, if that is ``times`` as frequent as
    itself; its root is the end of the chain of forms."""
    words = written(vocabulary(docs, id_col, text_col), "words")
    pairs = near_words(words)
    # Both ways at once: a union would work out all pairs twice.
    ways = [F.struct(F.col(a).alias("of"), F.col(b).alias("near"), F.col(f"n_{b}").alias("n_of_near")) for a, b in (("a", "b"), ("b", "a"))]
    both = pairs.select(F.inline(F.array(*ways)))
    best = F.min(F.struct((-F.col("n_of_near")).alias("less"), F.col("near")))
    chosen = both.groupBy("of").agg(F.count("*").alias("n_near"), best.alias("best"))
    found = words.join(chosen, F.col("word") == F.col("of"), "left")
    frequent = -F.col("best.less") >= times * F.col("n")
    found = written(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(frequent, F.col("best.near")).alias("form"), F.when(frequent, -F.col("best.less")).alias("form_n")), "forms")
    discard(words)
    roots = _roots(found.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    out = found.join(roots.withColumnRenamed("word", "of"), F.col("word") == F.col("of"), "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _roots(steps: DataFrame) -> DataFrame:
    """The end of each chain of steps (word, root). Every round doubles the length of a step; as counts at least double along a
    chain, six rounds do for any."""
    steps = written(steps, "steps")
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("further"))
        # Many words may have one root.
        further = written(skew_join(steps, ahead, ["root"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")), "steps")
        discard(steps)
        steps = further.select("word", "root")
        if further.filter("moved").isEmpty():
            return steps
