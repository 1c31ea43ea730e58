"""Exact distinct counts for several grouping sets, without a copy of each row per set."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_BUCKET, _BITS, _VALUE = "_distinct_bucket", "_distinct_bits", "_distinct_value"


def rollup_sets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    """All columns, all but the last, and so on to none."""
    return [tuple(columns[:n]) for n in range(len(columns), -1, -1)]


def cube_sets(columns: Sequence[str]) -> list[tuple[str, ...]]:
    return [chosen for n in range(len(columns), -1, -1) for chosen in combinations(columns, n)]


def distinct_counts(
    df: DataFrame, value: str, sets: Sequence[Sequence[str]], name: str = "n", set_name: str = "grouping_id", dense: bool = False
) -> DataFrame:
    """One row per grouping set and group: the grouping columns (null where rolled up), ``set_name`` as SQL's ``GROUPING_ID``
    over the columns in the order in which the sets name them first, and ``name``, the number of distinct values.

    Rows are shuffled once, after each task has summed up its own. With ``dense``, for whole numbers that lie close together
    such as ids, each group keeps a bitmap of 4 KB per 32,768 numbers in use; a coarser set merges the bitmaps of a finer one.
    Otherwise, for values of any type, a value's distinct groups meet in one task, the first row of each group of each set is
    marked, and marks are added up. What meets there is at most one row per group, however many rows have the value.

    Null values are not counted; a group with no others has 0. Null is a group of its own. Without rows the set of no
    columns has one row of 0, the others none.
    """
    sets = [tuple(dict.fromkeys(columns)) for columns in sets]
    if not sets or len(set(map(frozenset, sets))) < len(sets):
        raise ValueError("at least one grouping set is needed, and each only once")
    columns = list(dict.fromkeys(c for chosen in sets for c in chosen))
    clash = [c for c in (name, set_name, _BUCKET, _BITS, _VALUE) if c in columns]
    if clash:
        raise ValueError(f"grouping columns and results share the name '{clash[0]}'")
    df = df.select(*[_quoted(c) for c in columns], _quoted(value).alias(_VALUE))
    counts = (_by_bitmaps if dense else _by_firsts)(df, columns, sets, name)
    kinds = {c: df.schema[c].dataType for c in columns}
    parts = []
    for chosen, part in zip(sets, counts, strict=True):
        number = sum(1 << (len(columns) - 1 - i) for i, c in enumerate(columns) if c not in chosen)
        shown = [_quoted(c) if c in chosen else F.lit(None).cast(kinds[c]).alias(c) for c in columns]
        parts.append(part.select(*shown, F.lit(number).cast("bigint").alias(set_name), F.coalesce(_quoted(name), F.lit(0)).cast("bigint").alias(name)))
    return reduce(DataFrame.unionAll, parts)


def _quoted(column: str) -> Column:
    return F.col("`" + column.replace("`", "``") + "`")


def _by_bitmaps(df: DataFrame, columns: list[str], sets: list[tuple[str, ...]], name: str) -> list[DataFrame]:
    number = F.col(_VALUE).cast("bigint")
    finest = df.groupBy(*map(_quoted, columns), F.bitmap_bucket_number(number).alias(_BUCKET))
    merged = {frozenset(columns): finest.agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(_BITS))}
    # Finer sets first; each set starts from the smallest one that has its columns.
    for chosen in sorted(sets, key=len, reverse=True):
        if frozenset(chosen) not in merged:
            source = min((s for s in merged if s.issuperset(chosen)), key=len)
            merged[frozenset(chosen)] = merged[source].groupBy(*map(_quoted, chosen), _BUCKET).agg(F.bitmap_or_agg(_BITS).alias(_BITS))
    return [merged[frozenset(chosen)].groupBy(*map(_quoted, chosen)).agg(F.sum(F.bitmap_count(_BITS)).alias(name)) for chosen in sets]


def _by_firsts(df: DataFrame, columns: list[str], sets: list[tuple[str, ...]], name: str) -> list[DataFrame]:
    marks = [f"_distinct_first_{i}" for i in range(len(sets))]
    # All windows find their rows together once these are dealt by value.
    each = df.distinct().repartition(_VALUE)
    for mark, chosen in zip(marks, sets, strict=True):
        rest = [_quoted(c) for c in columns if c not in chosen] or [F.col(_VALUE)]
        first = F.row_number().over(Window.partitionBy(_VALUE, *map(_quoted, chosen)).orderBy(*rest)) == 1
        each = each.withColumn(mark, (first & F.col(_VALUE).isNotNull()).cast("bigint"))
    summed = each.groupBy(*map(_quoted, columns)).agg(*[F.sum(mark).alias(mark) for mark in marks])
    return [summed.groupBy(*map(_quoted, chosen)).agg(F.sum(mark).alias(name)) for mark, chosen in zip(marks, sets, strict=True)]
