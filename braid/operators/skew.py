"""Joins by keys of which some hold a large part of all rows.

A sketch of fixed size (``approx_top_k``, merged over all tasks) names the heavy keys of both sides. Their rows are dealt over
several pieces, and the other side's rows of these keys are repeated for each piece; all other rows join as usual. It is one
join: heavy keys differ only in the numbers of their pieces. Whether a heavy key occurs on both sides is counted beforehand, so
that outer rows come out once, however many pieces a key has.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Items that the sketch tracks for each one that it may name; its error is below their share of all rows.
TRACKED = 32
# A heavy key is cut finer than even shares need, so that its pieces spread evenly, as long as repeating the other side for it
# adds at most this part of that side's rows.
FINER, REPEATED = 8, 8
KINDS = ("inner", "left", "right", "full", "left_semi", "left_anti")


def partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def plain(column: Column, kind: T.DataType) -> Column:
    """The value as joins and groups compare it: one zero and one NaN."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(F.isnan(column), F.lit(float("nan")).cast(kind)).when(column == 0, F.lit(0.0).cast(kind)).otherwise(column)
    return column


def key_hash(df: DataFrame, keys: list[str]) -> Column:
    """A 64-bit hash of the key columns, equal for equal keys; nulls count as a value."""
    if not keys:
        return F.lit(0).cast("bigint")
    return F.xxhash64(*[plain(df[f"`{k}`"], df.schema[k].dataType) for k in keys])


def row_hash(df: DataFrame) -> Column:
    """Spreads rows, also rows alike in all columns where they come from several partitions; the same if a task is repeated."""
    hashable = [F.col(f"`{field.name}`") for field in df.schema if not _has_map(field.dataType)]
    return F.xxhash64(F.spark_partition_id(), *hashable)


def _has_map(kind: T.DataType) -> bool:
    if isinstance(kind, T.ArrayType):
        return _has_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_has_map(field.dataType) for field in kind)
    return isinstance(kind, (T.MapType, T.VariantType))


def heavy_hashes(df: DataFrame, hashed: Column, share: float) -> tuple[dict[int, int], int]:
    """The values of ``hashed`` that about ``share`` of all rows or more have, with their estimated rows, and the number of all
    rows. There are at most 1 / ``share`` of them."""
    return _heavy([df.select(hashed.alias("h"))], share)[0]


def _heavy(columns: list[DataFrame], share: float) -> list[tuple[dict[int, int], int]]:
    """``heavy_hashes`` of several one-column frames, in one job."""
    most = math.ceil(1 / share)
    facts = [F.expr(f"approx_top_k(h, {most}, {min(TRACKED * most, 1_000_000)})").alias("top"), F.count("*").alias("n")]
    if len(columns) == 1:
        found = {0: columns[0].agg(*facts).first()}
    else:
        marked = reduce(DataFrame.unionAll, [column.withColumn("side", F.lit(i)) for i, column in enumerate(columns)])
        found = {row["side"]: row for row in marked.groupBy("side").agg(*facts).collect()}
    out = []
    for i in range(len(columns)):
        top, n = (found[i]["top"] or [], found[i]["n"]) if i in found else ([], 0)
        out.append(({item["item"]: item["count"] for item in top if item["count"] >= share * n}, n))
    return out


def skew_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", share: float | None = None) -> DataFrame:
    """``left.join(right, on, how)``, with the rows of heavy keys dealt over several tasks.

    ``how`` is inner, left, right, full, left_semi or left_anti. A key is heavy if it has ``share`` of a side's rows; by default,
    half of what an even shuffle gives a task. Null keys match nothing, as in any join, and are spread as well. Columns come as
    from ``join`` with names: the keys once, then the others of the left side and, but for semi and anti, of the right side;
    a name may stand on both sides.
    """
    how = {"outer": "full", "full_outer": "full", "left_outer": "left", "right_outer": "right", "semi": "left_semi", "anti": "left_anti"}.get(how, how)
    if how not in KINDS:
        raise ValueError(f"unsupported join '{how}'; use {', '.join(KINDS)}")
    tasks = partitions(left)
    share = share or 1 / (2 * tasks)
    names = [f"_k{i}" for i in range(len(on))]
    kinds = [left.select(f"`{k}`").limit(0).unionAll(right.select(f"`{k}`").limit(0)).schema[0].dataType for k in on]
    a, b = (_named(side, on, names, kinds, mark) for side, mark in ((left, "_l"), (right, "_r")))
    if how in ("left_semi", "left_anti"):
        # Each key once, reduced before the shuffle: it can only be heavy on the left then.
        b = b.select(*names).distinct()
    facts = _facts(a, b, names, share, tasks, distinct=how in ("left_semi", "left_anti"))
    a = _dealt(a, names, facts, "_a", "_b", tasks).withColumn("_in_a", F.lit(True))
    b = _dealt(b, names, facts, "_b", "_a", tasks).withColumn("_in_b", F.lit(True))
    at = [*names, "_a", "_b"]
    # Analysed only, never run: the key's type is that of the side that it is taken from.
    key_types = left.select(*[f"`{k}`" for k in on]).limit(0).join(right.select(*[f"`{k}`" for k in on]).limit(0), on, how).schema
    keys = [F.col(name).cast(key_types[k].dataType).alias(name) for name, k in zip(names, on, strict=True)]
    left_rest, right_rest = ([c for c in side.columns if c.startswith(mark)] for side, mark in ((a, "_l"), (b, "_r")))
    if how in ("left_semi", "left_anti"):
        return a.join(b.select(*at), at, how).select(*keys, *left_rest).toDF(*on, *[c for c in left.columns if c not in on])
    joined = a.join(b.withColumnRenamed("_known", "_known_b"), at, how)
    # A row of a key that is known to be on both sides may meet an empty piece: that is no outer row.
    stray = (F.col("_in_b").isNull() & F.col("_known")) | (F.col("_in_a").isNull() & F.col("_known_b"))
    joined = joined.filter(~F.coalesce(stray, F.lit(False)))
    return joined.select(*keys, *left_rest, *right_rest).toDF(*on, *[c for c in left.columns if c not in on], *[c for c in right.columns if c not in on])


def _named(side: DataFrame, on: list[str], names: list[str], kinds: list[T.DataType], mark: str) -> DataFrame:
    """The keys under names of their own, in the type that both sides share, and the other columns under the side's mark."""
    rest = [c for c in side.columns if c not in on]
    keys = [F.col(f"`{k}`").cast(kind).alias(name) for k, kind, name in zip(on, kinds, names, strict=True)]
    return side.select(*keys, *[F.col(f"`{c}`").alias(f"{mark}{i}") for i, c in enumerate(rest)])


def _facts(a: DataFrame, b: DataFrame, names: list[str], share: float, tasks: int, distinct: bool) -> DataFrame | None:
    """For every heavy key: into how many pieces the rows of each side go, and whether both sides have it. At most 2 / ``share``
    rows, for that many keys can be heavy."""
    # The right side's distinct keys cannot be heavy.
    sides = [side.select(key_hash(side, names).alias("h")) for side in ((a,) if distinct else (a, b))]
    (hashes, n_a), (more, n_b) = [*_heavy(sides, share), ({}, 0)][:2]
    heavy = sorted({*hashes, *more})
    if not heavy:
        return None
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in names])
    held = [side.filter(key_hash(side, names).isin(heavy) & whole).select(*names, F.lit(i).alias("side")) for i, side in enumerate((a, b))]
    both = held[0].unionAll(held[1]).groupBy(*names).agg(F.sum(1 - F.col("side")).alias("n_a"), F.sum("side").alias("n_b"))
    found = both.collect()
    rows = []
    for row in found:
        if distinct:
            pieces_a, pieces_b = max(1, math.ceil(FINER * row["n_a"] * tasks / max(n_a, 1))), 1
        else:
            pieces_a, pieces_b = _pieces(row["n_a"], row["n_b"], n_a, n_b, tasks)
        rows.append((*[row[k] for k in names], pieces_a, pieces_b, row["n_a"] > 0 and row["n_b"] > 0))
    schema = T.StructType([*[a.schema[k] for k in names], *[T.StructField(c, T.IntegerType()) for c in ("_of_a", "_of_b")], T.StructField("_both", T.BooleanType())])
    return a.sparkSession.createDataFrame(rows, schema) if rows else None


def _pieces(n_a: int, n_b: int, all_a: int, all_b: int, tasks: int) -> tuple[int, int]:
    """Pieces of a key's rows on each side: as many as its share of all rows asks for, at the least repetition of rows."""
    if not n_a or not n_b:
        return (max(1, math.ceil(FINER * n_a * tasks / max(all_a, 1))), max(1, math.ceil(FINER * n_b * tasks / max(all_b, 1))))
    want_a, want_b = math.ceil(n_a * tasks / all_a), math.ceil(n_b * tasks / all_b)
    if want_b <= 1:
        return max(want_a, min(FINER * want_a, all_b // (REPEATED * n_b))), 1
    if want_a <= 1:
        return 1, max(want_b, min(FINER * want_b, all_a // (REPEATED * n_a)))
    pieces = max(want_a, want_b)
    first = min(max(round(math.sqrt(pieces * n_a / n_b)), 1), pieces)
    return first, math.ceil(pieces / first)


def _dealt(side: DataFrame, names: list[str], facts: DataFrame | None, own: str, other: str, tasks: int) -> DataFrame:
    """Each row with its piece in ``own``, once for every piece of the other side in ``other``."""
    spread = F.pmod(row_hash(side), F.lit(tasks * FINER)).cast("int")
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in names])
    if facts is None:
        return side.withColumns({own: F.when(whole, 0).otherwise(spread), other: F.lit(0), "_known": F.lit(False)})
    side = side.withColumn("_h", row_hash(side))
    mine, theirs = f"_of{own}", f"_of{other}"
    # Few keys are heavy, by the definition of their share: the table is bounded by the number of tasks.
    side = side.join(F.broadcast(facts), names, "left")
    known = F.coalesce("_both", F.lit(False))
    piece = F.when(~whole, F.pmod("_h", F.lit(tasks * FINER))).otherwise(F.pmod("_h", F.coalesce(mine, F.lit(1)))).cast("int")
    copies = F.when(known & whole, F.col(theirs)).otherwise(1)
    side = side.withColumns({own: piece, "_known": known, other: F.explode(F.sequence(F.lit(0), copies - 1))})
    return side.drop("_h", "_of_a", "_of_b", "_both")
