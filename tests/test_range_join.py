"""Range joins against comparing each with each."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from braid import range_join
from braid.operators import range_join as module
from braid.operators.range_join import FAN, covering

OPS = {"left": ("<=", "<"), "right": ("<", "<="), "both": ("<=", "<="), "neither": ("<", "<")}


def leaves(node):
    level, number = node >> 32, node & 0xFFFFFFFF
    return list(range(number * FAN**level, (number + 1) * FAN**level))


@pytest.mark.parametrize("depth", [1, 2, 3])
def test_nodes_cover_just_the_bins_and_are_few(spark, depth):
    bins, rng = FAN**depth, random.Random(depth)
    pairs = [(0, bins - 1), (0, 0), (3, 2), (1, bins - 2), *[(rng.randrange(bins), rng.randrange(bins)) for _ in range(300)]]
    for row in spark.createDataFrame(pairs, "a int, b int").select("a", "b", covering(F.col("a"), F.col("b"), depth).alias("nodes")).collect():
        assert sorted(x for node in row.nodes for x in leaves(node)) == list(range(row.a, row.b + 1))
        assert len(row.nodes) <= 2 * (FAN - 1) * depth + 1
    assert spark.createDataFrame([(0, bins - 1)], "a int, b int").select(covering(F.col("a"), F.col("b"), depth).alias("n")).first().n == [depth << 32]


def rows_of(df):
    return sorted(map(str, df.collect()))


def data(spark, seed=3):
    """A third of all points has one value; intervals of all lengths, empty, turned round, over everything; nulls, infinities, NaN."""
    rng = random.Random(seed)
    points = [(i, rng.choice([5.0, rng.uniform(0, 100), rng.expovariate(0.1)])) for i in range(900)] + [(i, x) for i, x in enumerate([None, float("inf"), float("-inf"), float("nan"), -0.0, 0.0])]
    ends = [(x, x + rng.choice([0, 0.001, 1, 30, 1000])) for x in (rng.uniform(-10, 110) for _ in range(60))]
    ends += [(5.0, 5.0), (float("-inf"), float("inf")), (7.0, 3.0), (None, 4.0), (4.0, None), (0.0, 0.0), (float("nan"), float("nan")), (-1e300, 1e300)] * 2
    return spark.createDataFrame(points, "i int, x double").repartition(4), spark.createDataFrame([(i, *e) for i, e in enumerate(ends)], "i int, a double, b double")


@pytest.mark.parametrize("closed", OPS)
@pytest.mark.parametrize("broadcast", ["10m", "-1"])
def test_same_as_each_with_each(spark, closed, broadcast):
    points, intervals = data(spark)
    low, high = OPS[closed]
    p, v = points.alias("p"), intervals.alias("v")
    wanted = p.join(v, F.expr(f"a {low} x AND x {high} b")).select("p.*", "v.*")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        found = range_join(points, intervals, "x", "a", "b", closed)
        assert found.columns == ["i", "x", "i", "a", "b"]
        assert rows_of(found) == rows_of(wanted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_many_bins_are_found_by_a_loop(spark, monkeypatch):
    points, intervals = data(spark, 4)
    wanted = rows_of(range_join(points, intervals, "x", "a", "b"))
    monkeypatch.setattr(module, "BINS_PER_TASK", 64)
    monkeypatch.setattr(module, "MOST_BRANCHES", 16)
    assert rows_of(range_join(points, intervals, "x", "a", "b")) == wanted


def test_times_and_dates(spark):
    start = datetime(2024, 3, 30)
    points = spark.createDataFrame([(start + timedelta(minutes=17 * i, microseconds=i),) for i in range(400)], "t timestamp_ntz")
    intervals = spark.createDataFrame([(start + timedelta(hours=h), start + timedelta(hours=h + h % 5)) for h in range(-3, 120)], "a timestamp_ntz, b timestamp_ntz")
    for kind in ("timestamp_ntz", "timestamp", "date"):
        p, v = points.select(F.col("t").cast(kind).alias("t")), intervals.select(F.col("a").cast(kind).alias("a"), F.col("b").cast(kind).alias("b"))
        assert rows_of(range_join(p, v, "t", "a", "b", "both")) == rows_of(p.join(v, F.expr("a <= t AND t <= b")))


def test_no_rows(spark):
    points, intervals = data(spark)
    for p, v in ((points.limit(0), intervals), (points, intervals.limit(0)), (points.limit(0), intervals.limit(0)), (points.filter("x IS NULL"), intervals)):
        assert range_join(p, v, "x", "a", "b").collect() == []


def test_what_cannot_be_compared_is_refused(spark):
    with pytest.raises(ValueError, match="not a number"):
        range_join(spark.sql("SELECT 'a' AS x"), spark.sql("SELECT 1 AS a, 2 AS b"), "x", "a", "b")
    with pytest.raises(ValueError, match="closed"):
        range_join(spark.sql("SELECT 1 AS x"), spark.sql("SELECT 1 AS a, 2 AS b"), "x", "a", "b", "open")
