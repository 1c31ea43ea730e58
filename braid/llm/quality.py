"""Quality rules: fixed rules and thresholds that adapt to each language and source.

Every text is measured (words, symbols, repeated lines, repeated 5-word windows). Per language and source, mergeable
quantile sketches of the measures give fences: a text is dropped when a measure lies far beyond what is usual there. A small
group's quantiles are drawn towards its language's and the corpus's. The sketches are counts per bin, so a source that holds most
rows is summed up task by task, and two runs give the same fences; the table of fences has one row per language and source and
meets the texts in an ordinary join, broadcast only if Spark finds it small.

Null text is empty text. A null language or source is a group of its own. Repeated rows are judged alike. Without rows
there are no fences and no results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.llm.rolling import IS_SPACE, blocks, window_hashes
from braid.shared import written

WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Not part of the results: the lines with a word, of which the repeated ones are a share.
_MEASURED = (*MEASURES, "n_lines")
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>")] = True


def measure_texts(texts: pa.Array) -> dict[str, np.ndarray]:
    """The measures of each text; all counts are over whole texts."""
    out = {name: np.zeros(len(texts), np.int64) for name in _MEASURED}
    for block in blocks(texts):
        rows = slice(block.first_row, block.first_row + len(block.text_at) - 1)
        out["n_words"][rows] = np.diff(block.word_at)
        # Code points are the bytes that do not continue one.
        for name, wanted in (("word_chars", ~IS_SPACE & (np.arange(256) >> 6 != 2)), ("n_symbols", _SYMBOLS)):
            sums = np.concatenate([[0], np.cumsum(wanted[block.data])])
            out[name][rows] = np.diff(sums[block.text_at])
        out["n_repeat_words"][rows] = _repeat_words(block)
        out["n_lines"][rows], out["n_dup_lines"][rows] = _lines(block)
    return out


def _repeat_words(block) -> np.ndarray:
    """Words in windows that a text has twice or more."""
    at, text = block.windows(WINDOW)
    # The text's number joins the hash, so that equal windows of two texts differ.
    own = window_hashes(block.word_hashes(), at, WINDOW) + text.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    order = np.argsort(own)
    same = np.zeros(len(own) + 1, bool)
    same[1:-1] = own[order][1:] == own[order][:-1]
    repeated = at[order[same[1:] | same[:-1]]]
    cover = np.zeros(len(block.starts) + WINDOW + 1, np.int64)
    np.add.at(cover, repeated, 1)
    np.add.at(cover, repeated + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(cover)[: len(block.starts)] > 0)])
    return np.diff(covered[block.word_at])


def _lines(block) -> tuple[np.ndarray, np.ndarray]:
    """Lines with a word, and how many of them equal an earlier line of their text."""
    n = np.minimum(np.diff(block.word_at), 1)
    out = np.zeros(len(block.text_at) - 1, np.int64)
    whole = block.data.tobytes()
    for row, (low, high) in enumerate(zip(block.text_at[:-1], block.text_at[1:], strict=True)):
        if whole.find(b"\n", low, high) >= 0:
            lines = [line for line in whole[low:high].split(b"\n") if line.strip(b" \t\n\x0b\x0c\r")]
            n[row], out[row] = len(lines), len(lines) - len(set(lines))
    return n, out


def measured(rows: DataFrame, text_col: str = "text") -> DataFrame:
    """``row``, a struct that has the text, with a struct ``m`` of its measures."""
    kind = pa.struct([(name, pa.int64()) for name in _MEASURED])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = measure_texts(batch.column("row").field(text_col))
            struct = pa.StructArray.from_arrays([pa.array(found[name]) for name in _MEASURED], fields=list(kind))
            yield pa.RecordBatch.from_arrays([batch.column("row"), struct], names=["row", "m"])

    struct = T.StructType([T.StructField(name, T.LongType()) for name in _MEASURED])
    return rows.mapInArrow(run, T.StructType([rows.schema["row"], T.StructField("m", struct)]))


# The rates that adapt: name, measure as a share, the quantiles that stand for what is usual (low or none, middle, high), how many
# times their distance beyond them is still usual, and by how much a text's own length widens the fence: a mean over few words
# strays more, and two repeated lines, or one passage of twenty words that stands twice, are a large share of a short text.
# Length and symbols of junk may fill a good part of a group, so that quartiles speak for the rest there. Repetition beyond a fifth
# of a text is gone already, and most texts have none, so that its tail has to speak.
def _rates() -> list[tuple[str, Column, tuple[float | None, float, float], float, Column]]:
    words, chars, lines = (F.greatest(F.col(f"m.{name}"), F.lit(1)) for name in ("n_words", "word_chars", "n_lines"))
    return [
        ("word_length", F.col("m.word_chars") / words, (0.25, 0.25, 0.75), 3.0, 10 / F.sqrt(words)),
        ("symbol_rate", F.col("m.n_symbols") / chars, (None, 0.25, 0.75), 3.0, 1 / F.sqrt(chars)),
        ("dup_line_rate", F.col("m.n_dup_lines") / lines, (None, 0.5, 0.95), 2.0, 2 / lines),
        ("repeat_rate", F.col("m.n_repeat_words") / words, (None, 0.5, 0.95), 2.0, 40 / words),
    ]


# A sketch is a count per bin; a bin's upper edge is this much above its lower one, and nothing at all has a bin of its own. Counts
# are whole numbers, so that sketches merge to the same result in any order; a group has some 2,000 bins a rate at most.
BIN_RATIO = 1.01
_NOTHING = -(2**30)
# A group counts as this many texts of its language more, and a language as this many of the corpus.
PRIOR_TEXTS = 10


def base_failed() -> Column:
    """The fixed rules: too few words, or too many in repeated windows."""
    return (F.col("m.n_words") < 10) | (100 * F.col("m.n_repeat_words") > 20 * F.col("m.n_words"))


def sketches(rows: DataFrame) -> DataFrame:
    """Per group (``g0``, ``g1``), rate and bin, the number of texts. Texts that fail the fixed rules do not count."""
    bins = []
    for name, rate, *_ in _rates():
        number = F.ceil(F.log(F.when(rate > 0, rate)) / math.log(BIN_RATIO)).cast("int")
        bins.append(F.struct(F.lit(name).alias("name"), F.coalesce(number, F.lit(_NOTHING)).alias("bin")))
    each = rows.filter(~base_failed()).select("g0", "g1", F.inline(F.array(*bins)))
    return each.groupBy("g0", "g1", "name", "bin").agg(F.count("*").alias("n"))


def quantiles(sketched: DataFrame, groups: list[str]) -> DataFrame:
    """Per group and rate: ``n`` texts and ``q``, the low, middle and high quantile of the rate in the merged sketches."""
    merged = sketched.groupBy(*groups, "name", "bin").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*groups, "name")
    so_far = F.sum("n").over(group.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    merged = merged.withColumn("so_far", so_far).withColumn("all", F.sum("n").over(group))
    edge = F.when(F.col("bin") == _NOTHING, F.lit(0.0)).otherwise(F.pow(F.lit(BIN_RATIO), F.col("bin")))
    wanted = F.lit(None).cast("array<double>")
    for name, _, at, _, _ in _rates():
        wanted = F.when(F.col("name") == name, F.array(*[F.lit(x).cast("double") for x in at])).otherwise(wanted)
    merged = merged.select(*groups, "name", "all", "so_far", edge.alias("edge"), wanted.alias("at"))
    reached = [F.min(F.when(F.col("so_far") >= F.col("at")[i] * F.col("all"), F.col("edge"))) for i in range(3)]
    return merged.groupBy(*groups, "name").agg(F.first("all").alias("n"), F.array(*reached).alias("q"))


def fences(sketched: DataFrame, prior: int = PRIOR_TEXTS) -> DataFrame:
    """Per group (``g0``, ``g1``), the lowest and highest usual value of each rate, from the group's quantiles drawn towards its
    language's, and these towards the corpus's, the more so the fewer texts there are."""

    def drawn(q: Column, n: Column, towards: Column) -> Column:
        return F.zip_with(q, towards, lambda x, y: (n * x + prior * y) / (n + prior))

    corpus = quantiles(sketched, []).select(F.col("name").alias("corpus_name"), F.col("q").alias("corpus_q"))
    language = quantiles(sketched, ["g0"]).join(corpus, F.col("name") == F.col("corpus_name"))
    language = language.select(F.col("g0").alias("l0"), F.col("name").alias("l_name"), drawn(F.col("q"), F.col("n"), F.col("corpus_q")).alias("l_q"))
    both = F.col("g0").eqNullSafe(F.col("l0")) & (F.col("name") == F.col("l_name"))
    found = quantiles(sketched, ["g0", "g1"]).join(language, both)
    found = found.select("g0", "g1", "name", drawn(F.col("q"), F.col("n"), F.col("l_q")).alias("q"))
    limits = []
    for name, _, _, spread, _ in _rates():
        low, middle, high = (F.col("q")[i] for i in range(3))
        limit = F.struct((low - spread * (high - low)).alias("low"), (high + spread * (high - middle)).alias("high"))
        limits.append(F.max(F.when(F.col("name") == name, limit)).alias(name))
    return found.groupBy("g0", "g1").agg(F.struct(*limits).alias("fence"))


def judged(docs: DataFrame, text_col: str = "text", groups: tuple[str, str] = ("lang", "source"), prior: int = PRIOR_TEXTS) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns), ``m`` (its measures), ``base_failed`` and ``kept``.

    The texts are measured twice, once for the sketches and once for the verdict, rather than shuffled or stored. The sketches,
    some bins for each group, are written once.
    """

    def rows(columns: list[str]) -> DataFrame:
        found = measured(docs.select(F.struct(*[F.col(f"`{c}`") for c in dict.fromkeys(columns)]).alias("row")), text_col)
        return found.select("*", *[F.col(f"row.`{g}`").alias(f"g{i}") for i, g in enumerate(groups)])

    sketched = written(sketches(rows([text_col, *groups]).drop("row")), "sketches")
    limits = fences(sketched, prior).select(F.col("g0").alias("f0"), F.col("g1").alias("f1"), "fence")
    out = rows(docs.columns).join(limits, F.col("g0").eqNullSafe(F.col("f0")) & F.col("g1").eqNullSafe(F.col("f1")), "left")
    usual = F.lit(True)
    for name, rate, (low, _, _), _, more in _rates():
        if low is not None:
            usual &= F.coalesce(rate >= F.col(f"fence.{name}.low") - more, F.lit(True))
        usual &= F.coalesce(rate <= F.col(f"fence.{name}.high") + more, F.lit(True))
    return out.select("row", "m", base_failed().alias("base_failed"), (~base_failed() & usual).alias("kept"))


def quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """One row per row of ``docs``: its id, the measures, ``base_failed`` and ``kept``. Other columns are not looked at."""
    rows = judged(docs.select(*dict.fromkeys([id_col, text_col, *groups])), text_col, groups)
    return rows.select(F.col(f"row.`{id_col}`").alias(id_col), *[F.col(f"m.{name}").alias(name) for name in MEASURES], "base_failed", "kept")


def with_quality(docs: DataFrame, text_col: str = "text", groups: tuple[str, str] = ("lang", "source")) -> DataFrame:
    """The rows of ``docs`` that are kept, with their columns."""
    return judged(docs, text_col, groups).filter("kept").select("row.*")
