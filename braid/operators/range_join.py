"""Joins of points to the intervals they lie in, without comparing each with each.

A quantile sketch of the points cuts the axis into bins of about equal numbers of points, the leaves of a tree with ``FAN`` children
a node. An interval becomes the few nodes that cover its bins exactly: a long one takes large nodes, so that their number grows
with the logarithm of the bins that it covers. A point meets them at its own bin and the nodes above it, of those levels that any
interval uses. Nodes with many points or intervals are dealt over several tasks. The interval's true bounds decide at the end.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.operators.skew import partitions, skew_join
from braid.shared import written

FAN = 8
# Bins for each task, and at most; the sketch tells no more apart.
BINS_PER_TASK, MOST_BINS = 4, FAN**4
MOST_BRANCHES = 128
CLOSED = ("left", "right", "both", "neither")


def range_join(points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, closed: str = "left") -> DataFrame:
    """Each point with every interval that holds it, as columns of ``points`` and then of ``intervals``.

    ``closed`` says which ends belong to an interval. Values are numbers, dates or timestamps. Nulls match nothing, nor does an
    interval whose low end lies above its high end. A row that occurs several times matches as often.
    """
    if closed not in CLOSED:
        raise ValueError(f"unsupported closed '{closed}'; use {', '.join(CLOSED)}")
    p, a, b = (_measured(df, c) for df, c in ((points, point), (intervals, low), (intervals, high)))
    depth = 1
    while FAN**depth < min(BINS_PER_TASK * partitions(points), MOST_BINS):
        depth += 1
    cuts = _cuts(points.select(p.alias("p")), FAN**depth)
    left = points.select(*[F.col(f"`{c}`").alias(f"_p{i}") for i, c in enumerate(points.columns)], p.alias("_p")).filter("_p IS NOT NULL")
    left = left.withColumn("_bin", _bin("_p", cuts)).drop("_p")
    right = intervals.select(*[F.col(f"`{c}`").alias(f"_i{i}") for i, c in enumerate(intervals.columns)], a.alias("_a"), b.alias("_b")).filter("_a IS NOT NULL AND _b IS NOT NULL")
    right = right.withColumns({"_a": _bin("_a", cuts), "_b": _bin("_b", cuts)})
    right = right.withColumn("_node", F.explode(covering(F.col("_a"), F.col("_b"), depth))).drop("_a", "_b")
    # Written: its true size then decides whether Spark sends it to all tasks.
    right = written(right, "intervals")
    used = sorted(row[0] for row in right.select(F.shiftright("_node", 32)).distinct().collect())
    if not used:
        return _bounded(left.drop("_bin").join(right.drop("_node"), F.lit(False)), points, intervals, point, low, high, closed)
    left = left.withColumn("_node", F.explode(F.array(*[_node(level, F.col("_bin") / FAN**level) for level in used]))).drop("_bin")
    threshold = points.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if int(str(right._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) <= threshold:
        joined = left.join(right, "_node")
    else:
        joined = skew_join(left, right, ["_node"])
    return _bounded(joined, points, intervals, point, low, high, closed)


def _bounded(joined: DataFrame, points: DataFrame, intervals: DataFrame, point: str, low: str, high: str, closed: str) -> DataFrame:
    p, a, b = (F.col(f"_p{points.columns.index(point)}"), *(F.col(f"_i{intervals.columns.index(c)}") for c in (low, high)))
    inside = ((a <= p) if closed in ("left", "both") else (a < p)) & ((p <= b) if closed in ("right", "both") else (p < b))
    columns = [f"_p{i}" for i in range(len(points.columns))] + [f"_i{i}" for i in range(len(intervals.columns))]
    return joined.filter(inside).select(*columns).toDF(*points.columns, *intervals.columns)


def _measured(df: DataFrame, name: str) -> Column:
    """The value as a number in the same order; values that are close may become one."""
    kind, column = df.schema[name].dataType, F.col(f"`{name}`")
    if isinstance(kind, T.NumericType):
        return column.cast("double")
    if isinstance(kind, T.DateType):
        return F.unix_date(column) * 86400.0
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_date(column.cast("date")) * 86400.0 + F.hour(column) * 3600 + F.minute(column) * 60 + F.second(column)
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column) / 1e6
    raise ValueError(f"column '{name}' is not a number, a date or a timestamp")


def _cuts(values: DataFrame, bins: int) -> list[float]:
    found = values.agg(F.percentile_approx("p", [i / bins for i in range(1, bins)], 4 * MOST_BINS)).first()[0]
    return sorted({x for x in found or [] if x == x})


def _bin(name: str, cuts: list[float]) -> Column:
    """The number of cuts at or below the column's value, by bisection."""

    def among(low: int, high: int) -> str:
        if low == high:
            return str(low)
        middle = (low + high) // 2
        return f"CASE WHEN {name} < DOUBLE('{cuts[middle]!r}') THEN {among(low, middle)} ELSE {among(middle + 1, high)} END"

    value = F.col(name)
    if len(cuts) <= MOST_BRANCHES:
        found = F.expr(among(0, len(cuts)))
    else:
        # As a loop, for code with a branch for each of so many cuts could not be compiled.
        steps = F.array(*[F.lit(1 << i) for i in reversed(range(len(cuts).bit_length()))])
        every = F.lit(np.array(cuts, np.float64))
        reached = lambda at: (at < len(cuts)) & (F.get(every, at) <= value)
        found = F.aggregate(steps, F.lit(0), lambda low, size: F.when(reached(low + size - 1), low + size).otherwise(low))
    return F.when(value.isNotNull(), found)


def _node(level: int, number: Column) -> Column:
    return (F.lit(level << 32) + F.floor(number)).cast("bigint")


def covering(first: Column, last: Column, depth: int) -> Column:
    """The nodes that together cover the bins ``first`` to ``last`` and no other; none if there are no such bins.

    At each level, the nodes at both ends whose parents reach beyond are taken; what is between goes to the parents' level.
    """
    none = F.array().cast("array<bigint>")
    run = lambda level, a, b: F.when(a <= b, F.transform(F.sequence(a, F.greatest(a, b)), lambda i: _node(level, i))).otherwise(none)
    # The first and last node of each level that lie wholly inside.
    inside = [(F.ceil(first / FAN**level), F.floor((last + 1) / FAN**level) - 1) for level in range(depth + 1)]
    parts = []
    for level, ((a, b), (above_a, above_b)) in enumerate(zip(inside, inside[1:], strict=False)):
        ends = F.concat(run(level, a, above_a * FAN - 1), run(level, (above_b + 1) * FAN, b))
        parts.append(F.when(above_a <= above_b, ends).otherwise(run(level, a, b)))
    return F.concat(*parts, run(depth, *inside[-1]))
