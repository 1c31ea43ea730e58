"""Leave out rows of a large input whose keys a small one does not have, before they are shuffled or fetched.

The small side's keys go into a filter of fixed size: 64-bit words, of which a key sets four bits in one. It is built by an
aggregate (``bit_or``, merged over all tasks) as part of the query that uses it, and looked up in the scan of the large side.
The least and greatest key become a plain condition, which Spark hands to Parquet files and databases. Both may let rows through
that match nothing, and never drop one that does.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.operators.skew import plain

BITS_PER_KEY = 16
# Beyond so many bytes of filter there is none, and the range alone decides.
MOST_BYTES = 8 << 20
# Places of a key's bits in its word, as shifts of its hash; the word's number takes the bits below.
_SHIFTS = (40, 46, 52, 58)
# Whose rows a join may do without if they match nothing, by the side that is small.
_REDUCIBLE = {"right": ("inner", "left_semi", "right"), "left": ("inner", "left_semi", "left_anti", "left")}


def key_filtered(big: DataFrame, keys: DataFrame, on: list[str], bits_per_key: int = BITS_PER_KEY, most_bytes: int = MOST_BYTES) -> DataFrame:
    """The rows of ``big`` whose values in ``on`` may be a row of ``keys``, which has as many columns, in this order.

    Rows with a null among these values are left out, as they match nothing. ``keys`` is read once here, for its bounds and the
    number of its values, and once more whenever the result is.
    """
    if len(on) != len(keys.columns):
        raise ValueError(f"{len(on)} columns cannot meet {len(keys.columns)} columns of keys")
    names = [f"k{i}" for i in range(len(on))]
    kinds = [big.select(f"`{c}`").limit(0).unionAll(keys.select(f"`{k}`").limit(0)).schema[0].dataType for c, k in zip(on, keys.columns, strict=True)]
    whole = reduce(Column.__and__, [F.col(name).isNotNull() for name in names])
    found = keys.toDF(*names).filter(whole).select(*[F.col(name).cast(kind).alias(name) for name, kind in zip(names, kinds, strict=True)])
    hashed = F.xxhash64(*[plain(F.col(name), kind) for name, kind in zip(names, kinds, strict=True)])
    bounds = [f(name).alias(f"{label}_{name}") for name in names for label, f in (("low", F.min), ("high", F.max))]
    facts = found.agg(F.approx_count_distinct(hashed, 0.02).alias("n"), F.count("*").alias("rows"), *bounds).first()
    if not facts["rows"]:
        return big.filter(F.lit(False))
    kept = reduce(Column.__and__, [F.col(f"`{c}`").between(F.lit(facts[f"low_{k}"]), F.lit(facts[f"high_{k}"])) for c, k in zip(on, names, strict=True)])
    words = 1 << max(0, math.ceil(math.log2(max(facts["n"], 1) * bits_per_key / 64)))
    if words * 8 <= most_bytes:
        own = F.xxhash64(*[plain(F.col(f"`{c}`").cast(kind), kind) for c, kind in zip(on, kinds, strict=True)])
        mask = _mask(own)
        kept = kept & (F.get(_words(found.select(hashed.alias("h")), words), _number(own, words)).bitwiseAND(mask) == mask)
    return big.filter(kept)


def _mask(hashed: Column) -> Column:
    one = F.lit(1).cast("bigint")
    bits = [F.call_function("shiftleft", one, F.shiftrightunsigned(hashed, n).bitwiseAND(63).cast("int")) for n in _SHIFTS]
    return reduce(Column.bitwiseOR, bits)


def _number(hashed: Column, words: int) -> Column:
    return hashed.bitwiseAND(words - 1).cast("int")


def _words(hashes: DataFrame, words: int) -> Column:
    """All words of the filter in order, as one value. Their number is fixed before."""
    set_bits = hashes.select(_number(F.col("h"), words).alias("i"), _mask(F.col("h")).alias("w"))
    every = hashes.sparkSession.range(words).select(F.col("id").cast("int").alias("i"), F.lit(0).cast("bigint").alias("w"))
    merged = set_bits.unionAll(every).groupBy("i").agg(F.bit_or("w").alias("w"))
    return merged.agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "w"))), lambda x: x["w"]).alias("words")).scalar()


def filtered_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", small: str = "right") -> DataFrame:
    """``left.join(right, on, how)``, where the side that is not ``small`` loses the rows that cannot match before the join.

    The join has to be one that does not return such rows: with a small right side inner, left_semi and right; with a small left
    side inner, left, left_semi and left_anti.
    """
    if how not in _REDUCIBLE.get(small, ()):
        raise ValueError(f"a '{how}' join returns rows without a match, or knows no small side '{small}'")
    columns = [f"`{k}`" for k in on]
    if small == "right":
        left = key_filtered(left, right.select(*columns), on)
    else:
        right = key_filtered(right, left.select(*columns), on)
    return left.join(right, on, how)
