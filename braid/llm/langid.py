"""Language identification by interpolated Kneser-Ney character models.

One model per language, of character n-grams up to ``ORDER``: counts are discounted, the rest goes to the next lower order, and
lower orders count in how many contexts a character is seen, not how often. All languages share one sorted array of n-gram
hashes per order, with the log probability in each language beside it, so that one binary search scores a character in all of
them. The language with the least cross-entropy per character wins. Calibration turns the lead over the others into a
probability, the ``score``; below ``reject`` the text counts as ``rejected``.

Models are fitted on a bounded part of the labelled rows: those with the least hashes, about ``FIT_ROWS`` per language,
each with its whole text. Counting is done by Spark; the model that comes to the driver is bounded by that sample.

Texts are lower-cased; each run of other characters than letters is one space. Null text and text without letters give
``und`` with score 0. Without any labelled row every text is ``und``. Repeated rows are predicted alike.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braid.llm.rolling import mix, slices

ORDER = 4
FIT_ROWS = 1_500
# Rows per language, of those fitted, that set the calibration only.
CALIBRATE_SHARE = 0.2
REJECT = 0.5
UNKNOWN = "und"


def _tables() -> np.ndarray:
    """For each code point its lower-case letter, or a blank."""
    found = np.full(0x110000, 32, np.uint32)
    for point in [*range(0xD800), *range(0xE000, 0x110000)]:
        char = chr(point)
        if char.isalpha():
            low = char.lower()
            found[point] = ord(low) if len(low) == 1 else point
    return found


_letters: list[np.ndarray] = []


def characters(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The texts' letters with single blanks around words, and where each text starts (one entry more than texts). Every
    text begins and ends with a blank; one without letters is a blank alone."""
    if not _letters:
        _letters.append(_tables())
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes + 2)
    joined = "".join(f" {text} " for text in texts)
    points = _letters[0][np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)]
    starts = ends - sizes - 2
    blank = points == 32
    keep = np.ones(len(points), bool)
    keep[1:] = ~(blank[1:] & blank[:-1])
    keep[starts] = True
    at = np.concatenate([[0], np.cumsum(keep)])
    return points[keep], at[np.append(starts, len(points))]


# Characters that are scored at a time.
STRIP = 1 << 18


def gram_hashes(points: np.ndarray, order: int) -> np.ndarray:
    """A hash of the ``order`` characters that end at each place; the first ``order - 1`` places take what there is."""
    padded = np.concatenate([np.zeros(order - 1, np.uint64), points.astype(np.uint64)])
    out = np.full(len(points), order, np.uint64)
    for k in range(order):
        out = out * np.uint64(0x100000001B3) + padded[k : k + len(points)] + np.uint64(1)
        out ^= out << np.uint64(21)
    return mix(out)


@dataclass
class Model:
    """Per order, from the highest: sorted hashes and a row of log probabilities per hash; ``back`` holds, for the hash of a
    context, the log weight with which a character not seen after it falls to the next lower order."""

    languages: list[str]
    grams: list[tuple[np.ndarray, np.ndarray]]
    back: list[tuple[np.ndarray, np.ndarray]]
    floor: float
    scale: float = 1.0

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Cross-entropy per character in each language, and the number of letters, of each text. Characters are scored in strips,
        so that memory beyond the texts' own does not grow with their length."""
        points, at = characters(texts)
        sums = np.zeros((len(texts), len(self.languages)))
        for low in range(0, len(points), STRIP):
            high = min(low + STRIP, len(points))
            first, last = np.searchsorted(at, low, "right") - 1, np.searchsorted(at, high, "left")
            sums[first:last] += np.add.reduceat(self._logs(points, at, low, high), np.maximum(at[first:last], low) - low, axis=0)
        letters = np.add.reduceat(points != 32, at[:-1], dtype=np.int64) if len(texts) else np.zeros(0, np.int64)
        return -sums / np.maximum(np.diff(at) - 1, 1)[:, None], letters

    def _logs(self, points: np.ndarray, at: np.ndarray, low: int, high: int) -> np.ndarray:
        """Log probabilities of the characters from ``low`` to ``high``, 0 for the blank that begins a text."""
        begin = max(low - ORDER + 1, 0)
        part = points[begin:high]
        place = np.arange(begin, high)
        place -= at[np.searchsorted(at, place, "right") - 1]
        logs = np.zeros((len(part), len(self.languages)), np.float32)
        todo = low - begin + np.flatnonzero(place[low - begin :] > 0)
        weight = np.zeros((len(todo), len(self.languages)), np.float32)
        for order, (hashes, values), (contexts, backs) in zip(range(ORDER, 0, -1), self.grams, self.back, strict=True):
            own = gram_hashes(part, order)[todo]
            which, hit = _find(hashes, own)
            hit &= place[todo] >= order - 1
            logs[todo[hit]] = weight[hit] + values[which[hit]]
            todo, weight = todo[~hit], weight[~hit]
            if order == 1:
                logs[todo] = weight + self.floor
            elif len(todo):
                which, known = _find(contexts, gram_hashes(part, order - 1)[todo - 1])
                known &= place[todo] >= order - 1
                weight[known] += backs[which[known]]
        return logs[low - begin :]

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        if not self.languages:
            return [UNKNOWN] * len(texts), np.zeros(len(texts))
        entropy, letters = self.entropies(texts)
        best = entropy.argmin(axis=1)
        score = np.where(letters > 0, confidence(entropy, letters, self.scale), 0.0)
        return [self.languages[b] if n else UNKNOWN for b, n in zip(best, letters, strict=True)], score


def confidence(entropy: np.ndarray, letters: np.ndarray, scale: float) -> np.ndarray:
    """Probability of the best language: lead in total cross-entropy, in which long texts count as ``scale`` lets them."""
    lead = (entropy - entropy.min(axis=1, keepdims=True)) * (np.maximum(letters, 1) ** 0.5)[:, None] * scale
    return 1 / np.exp(-np.minimum(lead, 700)).sum(axis=1)


def _find(sorted_hashes: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(sorted_hashes):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    which = np.minimum(np.searchsorted(sorted_hashes, wanted), len(sorted_hashes) - 1)
    return which, sorted_hashes[which] == wanted


def counted(rows: DataFrame) -> DataFrame:
    """How often each ``ORDER``-gram, and each shorter one at the start of a text, stands in the texts of each language.

    ``rows``: lang, text. ``gram`` is the characters as text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, "text")):
            langs = batch.column(0).to_pylist()
            texts = batch.column(1).fill_null("").to_pylist()
            for lang in sorted(set(langs)):
                points, at = characters([t for t, x in zip(texts, langs, strict=True) if x == lang])
                place = np.arange(len(points)) - np.repeat(at[:-1], np.diff(at))
                for size in range(2, ORDER + 1):
                    ends = np.flatnonzero(place >= size - 1 if size == ORDER else place == size - 1)
                    grams = np.stack([points[ends - size + 1 + k] for k in range(size)], axis=1)
                    unique, n = np.unique(grams, axis=0, return_counts=True)
                    names = [bytes(x.astype("<u4").tobytes()).decode("utf-32-le") for x in unique]
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(names, pa.string()), pa.array(n)], names=["lang", "gram", "n"])

    return rows.mapInArrow(run, "lang string, gram string, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def kneser_ney(counts: dict[str, dict[str, int]]) -> Model:
    """``counts``: per language, as ``counted`` has them."""
    languages = sorted(counts)
    per_order: dict[int, dict[str, np.ndarray]] = {order: {} for order in range(1, ORDER + 1)}
    per_back: dict[int, dict[str, np.ndarray]] = {order: {} for order in range(1, ORDER + 1)}
    letters = {gram[-1] for grams in counts.values() for gram in grams}
    floor = -math.log(len(letters) + 1)
    for k, lang in enumerate(languages):
        n = {ORDER: {}, **{order: {} for order in range(1, ORDER)}}
        for gram, count in counts[lang].items():
            n[len(gram)][gram] = n[len(gram)].get(gram, 0) + count
        # A shorter n-gram counts once for each character seen before it; at the start of a text nothing stands before.
        for order in range(ORDER - 1, 0, -1):
            for gram in n[order + 1]:
                n[order][gram[1:]] = n[order].get(gram[1:], 0) + 1
        lower: dict[str, float] = {}
        for order in range(1, ORDER + 1):
            total: dict[str, int] = {}
            kinds: dict[str, int] = {}
            ones = sum(c == 1 for c in n[order].values())
            twos = sum(c == 2 for c in n[order].values())
            discount = min(max(ones / max(ones + 2 * twos, 1), 0.1), 0.9)
            for gram, count in n[order].items():
                total[gram[:-1]] = total.get(gram[:-1], 0) + count
                kinds[gram[:-1]] = kinds.get(gram[:-1], 0) + 1
            share = {context: discount * kinds[context] / total[context] for context in total}
            for context, weight in share.items():
                per_back[order].setdefault(context, np.zeros(len(languages)))[k] = math.log(weight)
            now = {}
            for gram, count in n[order].items():
                context = gram[:-1]
                rest = lower.get(gram[1:], math.exp(floor)) if order > 1 else math.exp(floor)
                now[gram] = (count - discount) / total[context] + share[context] * rest
                per_order[order].setdefault(gram, np.full(len(languages), np.nan))[k] = math.log(now[gram])
            lower = now
    # A gram that one language has not seen gets there what falling back gives it.
    for order in range(1, ORDER + 1):
        for gram, row in per_order[order].items():
            gaps = np.isnan(row)
            if gaps.any():
                down = per_order[order - 1].get(gram[1:]) if order > 1 else None
                fall = down if down is not None else np.full(len(languages), floor)
                back = per_back[order].get(gram[:-1], np.zeros(len(languages)))
                row[gaps] = (back + fall)[gaps]
    return Model(
        languages,
        [_sorted(per_order[order], order, len(languages)) for order in range(ORDER, 0, -1)],
        [_sorted(per_back[order], order - 1, len(languages)) if order > 1 else (np.zeros(0, np.uint64), np.zeros((0, len(languages)))) for order in range(ORDER, 0, -1)],
        floor,
    )


def _sorted(rows: dict[str, np.ndarray], size: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    if not rows:
        return np.zeros(0, np.uint64), np.zeros((0, width), np.float32)
    grams = np.frombuffer("".join(rows).encode("utf-32-le"), np.uint32).reshape(-1, size)
    hashes = gram_hashes(grams.ravel(), size)[size - 1 :: size]
    order = np.argsort(hashes)
    return hashes[order], np.array(list(rows.values()), np.float32)[order]


def fit(rows: DataFrame, fit_rows: int = FIT_ROWS) -> Model:
    """A model of ``rows`` (key, lang, text, all languages non-null), from about ``fit_rows`` rows per language."""
    # A hash of the key, not chance, picks the rows: the same ones again after a task is lost.
    draw = F.pmod(F.xxhash64("key", F.lit("fit")), F.lit(1 << 20)) / F.lit(1 << 20)
    # Two numbers per language come here, as the whole model does.
    found = sorted(rows.groupBy("lang").agg(F.count("*").alias("n"), F.min(draw).alias("least")).collect())
    if not found:
        return kneser_ney({})
    share = F.create_map(*[F.lit(x) for row in found for x in (row.lang, min(1.0, fit_rows / row.n))])[F.col("lang")]
    least = F.create_map(*[F.lit(x) for row in found for x in (row.lang, row.least)])[F.col("lang")]
    drawn = rows.withColumn("draw", draw).withColumn("share", share).filter(F.col("draw") < F.col("share"))
    # The least draw of a language is for fitting, however few rows there are: a language without counts is never predicted.
    late = (F.col("draw") >= F.col("share") * (1 - CALIBRATE_SHARE)) & (F.col("draw") > least)
    counts: dict[str, dict[str, int]] = {}
    for row in counted(drawn.filter(~late).select("lang", "text")).toLocalIterator():
        counts.setdefault(row.lang, {})[row.gram] = row.n
    model = kneser_ney(counts)
    if model.languages:
        model.scale = _calibrated(model, drawn.filter(late).select("lang", "text"))
    return model


def _calibrated(model: Model, rows: DataFrame) -> float:
    """The scale under which rows kept back get the highest likelihood. Sums for each candidate come from the tasks."""
    candidates = [2.0**k for k in range(-4, 8)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (part for batch in batches for part in slices(batch, "text")):
            langs = batch.column(0).to_pylist()
            entropy, letters = model.entropies(batch.column(1).fill_null("").to_pylist())
            right = np.array([model.languages[b] == lang for b, lang in zip(entropy.argmin(axis=1), langs, strict=True)])
            sums = [float(np.log(np.clip(np.where(right, p, 1 - p), 1e-9, 1))[letters > 0].sum()) for p in (confidence(entropy, letters, s) for s in candidates)]
            yield pa.RecordBatch.from_arrays([pa.array(range(len(candidates)), pa.int64()), pa.array(sums, pa.float64())], names=["k", "s"])

    found = rows.mapInArrow(run, "k bigint, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
    return candidates[max(found, key=lambda r: (round(r.s, 6), -r.k)).k] if found else 1.0


def identified(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """One row per row of ``docs``: its id, ``lang_pred``, ``score`` and ``rejected``."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    context = docs.sparkSession.sparkContext
    # Bounded by the sample that it was fitted on.
    shared = context.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                langs, score = shared.value.predict(part.column("text").fill_null("").to_pylist())
                rejected = (score < reject) | np.array([x == UNKNOWN for x in langs], bool)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(langs, pa.string()), pa.array(score), pa.array(rejected)], names=["id", "lang_pred", "score", "rejected"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, lang_pred string, score double, rejected boolean").withColumnRenamed("id", id_col)
