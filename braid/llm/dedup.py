"""Exact dedup by content sort, in DataFrame operations only.

Texts are compared after lower-casing A-Z. Sampled splitters range-partition the normalised bytes by their first bytes and a
hash of the whole, each partition is sorted (externally, if need be) so that equals are adjacent, and each row is compared
in full with its neighbour. Copies that crowd one text are cut beforehand into slices of bounded size by a hash of the row;
each slice is sorted on its own and its totals are added up.

Of equal texts the row with the largest id stays; a null id is smaller than any other. Of rows with equal text and id exactly
one stays. Null text is empty text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from braid.shared import written

# A text with more rows than this is cut into slices of about so many.
SLICE_ROWS = 1_000
PREFIX = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def normalised(text: Column) -> Column:
    """``text`` with A-Z in lower case and nothing else changed. Where all bytes are ASCII, ``lower`` does just that, faster."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, _UPPER, _LOWER))


def marked_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Per row of ``docs``: ``row`` (all its columns) and ``copy``: ``keep_id``, ``group_size``, ``kept`` and ``sha256``."""
    crowded = docs.select(F.xxhash64(normalised(F.col(text_col))).alias("crowded")).groupBy("crowded").count().filter(F.col("count") > slice_rows)
    # One entry per slice_rows rows at most; written, it shows Spark its true size.
    crowded = written(crowded.select("crowded", F.ceil(F.col("count") / slice_rows).alias("slices")), "crowded")

    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    text = F.col(f"row.`{text_col}`")
    norm = F.encode(normalised(text), "UTF-8")
    rows = rows.select("row", F.xxhash64(normalised(text)).alias("hash"), F.substring(norm, 1, PREFIX).alias("prefix"))
    rows = rows.join(crowded, rows["hash"] == crowded["crowded"], "left")
    slice_of = F.coalesce(F.pmod(F.xxhash64("row"), "slices"), F.lit(0)).alias("slice")
    rows = rows.select("row", "prefix", "hash", slice_of, F.col("slices").isNotNull().alias("cut"))
    # Slices of one text meet in their totals only, of the crowded texts alone. The first slice with the largest id keeps it.
    cut = _runs(rows.filter("cut"), norm, id_col).filter("nth = 1").groupBy(F.col("sha256").alias("of")).agg(
        F.sum("n").alias("all_n"), F.max("top").alias("all_top"), F.max_by("slice", F.struct("top", -F.col("slice"))).alias("at")
    )
    cut = written(cut, "cut_totals")
    rows = _runs(rows, norm, id_col)
    rows = rows.join(cut, rows["sha256"] == cut["of"], "left")
    copy = F.struct(
        F.coalesce(F.when(F.col("cut"), F.col("all_top")), F.col("top")).alias("keep_id"),
        F.coalesce(F.col("all_n"), F.col("n")).alias("group_size"),
        ((F.col("nth") == 1) & (F.col("at").isNull() | (F.col("at") == F.col("slice")))).alias("kept"),
        F.col("sha256"),
    )
    return rows.select("row", copy.alias("copy"))


def _runs(rows: DataFrame, norm: Column, id_col: str) -> DataFrame:
    """Sort the rows into runs of equal texts: each row's place in its run, the run's size and its largest id.

    The range cut already puts equals together, so that the window only sorts. It tells runs apart by comparing each row with
    the one before it, in full: equal hashes of different texts stay apart.
    """
    rows = rows.repartitionByRange("prefix", "hash", "slice").select("*", norm.alias("norm"), F.col(f"row.`{id_col}`").alias("id"))
    run = Window.partitionBy("prefix", "hash", "slice", "norm").orderBy(F.col("id").desc_nulls_last())
    whole = run.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.select(
        "row", "cut", "slice", F.sha2("norm", 256).alias("sha256"),
        F.row_number().over(run).alias("nth"), F.count("*").over(whole).alias("n"), F.max("id").over(whole).alias("top"),
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """One row per row of ``docs``: its id, ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = marked_copies(slim, "id", "text", slice_rows)
    return found.select(F.col("row.id").alias(id_col), "copy.keep_id", "copy.group_size", "copy.kept", F.col("copy.sha256").alias("text_sha256"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """The rows of ``docs`` that stay, with their columns."""
    return marked_copies(docs, id_col, text_col, slice_rows).filter("copy.kept").select("row.*")
