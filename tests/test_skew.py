"""Skew-safe joins against plain ones."""

import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from braid.operators.skew import KINDS, heavy_hashes, key_hash, skew_join


def rows_of(df):
    plain = lambda value: "nan" if value != value else value
    return sorted((tuple(map(plain, row)) for row in df.collect()), key=lambda row: tuple((value is not None, str(value)) for value in row))


def same(left, right, on, how, **more):
    found, wanted = skew_join(left, right, on, how, **more), left.join(right, on, how)
    assert found.columns == wanted.columns
    assert found.dtypes == wanted.dtypes
    assert rows_of(found) == rows_of(wanted)


@pytest.fixture(scope="module")
def sides(spark):
    """Key 1 is heavy on both sides, 2 on the left, 3 on the right, 4 and 5 on one side only; nulls are many."""
    rng = random.Random(5)
    left = [(rng.choice([1, 1, 2, 2, 2, 4, None, None, *range(10, 40)]), i, "x") for i in range(900)]
    right = [(rng.choice([1, 3, 3, 3, 5, 5, None, *range(10, 40)]), str(i), "y") for i in range(500)] + [(2, "two", None)] * 3
    return spark.createDataFrame(left, "k int, a int, c string").repartition(4), spark.createDataFrame(right, "k bigint, b string, c string").repartition(3)


@pytest.mark.parametrize("how", KINDS)
def test_same_as_a_plain_join(sides, how):
    same(*sides, ["k"], how)


@pytest.mark.parametrize("how", KINDS)
def test_no_rows(sides, how):
    left, right = sides
    same(left.limit(0), right, ["k"], how)
    same(left, right.limit(0), ["k"], how)
    same(left.limit(0), right.limit(0), ["k"], how)


@pytest.mark.parametrize("how", KINDS)
def test_several_keys_rows_alike_zeros_and_nans(spark, how):
    left = spark.createDataFrame([(0.0, "a", 1)] * 40 + [(float("nan"), "a", 2)] * 40 + [(None, "a", 3), (1.0, None, 4)], "k double, s string, n int")
    right = spark.createDataFrame([(-0.0, "a", True)] * 3 + [(float("nan"), "a", False)] * 30 + [(None, "a", None)] * 9, "k float, s string, t boolean")
    same(left, right, ["k", "s"], how, share=0.1)


def test_columns_that_cannot_be_hashed_and_odd_names(spark):
    left = spark.sql("SELECT id % 3 AS `k.1`, map('a', id) AS m, id AS `_known` FROM range(60)")
    found = skew_join(left, left.select("`k.1`", F.col("_known").alias("_a")), ["k.1"], share=0.1)
    assert found.columns == ["k.1", "m", "_known", "_a"] and found.count() == 3 * 20 * 20


def test_unknown_kinds_are_errors(sides):
    with pytest.raises(ValueError, match="cross"):
        skew_join(*sides, ["k"], "cross")


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    left=st.lists(st.sampled_from([1, 1, 1, 2, 3, None]), max_size=30), right=st.lists(st.sampled_from([1, 2, 2, 2, 4, None]), max_size=30),
    how=st.sampled_from(KINDS), share=st.sampled_from([0.05, 0.3]),
)
def test_any_keys(spark, left, right, how, share):
    left = spark.createDataFrame([(k, i) for i, k in enumerate(left)], "k int, a int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "k int, b int")
    same(left, right, ["k"], how, share=share)


def test_the_sketch_finds_heavy_keys_among_many(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 10 == 1, 8).otherwise(F.col("id")).alias("k"))
    found, n = heavy_hashes(df, key_hash(df, ["k"]), 0.05)
    wanted = {row.h: row["count"] for row in df.select(key_hash(df, ["k"]).alias("h")).groupBy("h").count().filter("count > 10000").collect()}
    assert n == 200_000 and found.keys() == wanted.keys()
    assert all(abs(found[h] - wanted[h]) < 0.01 * n for h in wanted)


def test_no_task_of_a_full_join_gets_far_more_than_the_others(spark, tmp_path):
    """A third of all rows has one key on the left. The rows that reach each task are counted after the join's shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(60_000).select(F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("k"), F.col("id").alias("a")).repartition(6)
        right = spark.range(-20_000, 20_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("b"))
        def fullest(joined):
            sizes = sorted(row["count"] for row in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
            return sizes[-1] / sizes[len(sizes) // 2]
        assert fullest(left.join(right, ["k"], "full")) > 2
        assert fullest(skew_join(left, right, ["k"], "full")) < 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
