"""Filters by the keys of a small table: nothing that matches is dropped, most that does not is, and scans see the bounds."""

import math

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from braid import filtered_join, key_filtered, run_query
from braid.operators import key_filter

NUMBERS = st.one_of(st.none(), st.integers(-3, 3), st.integers(-(2**31), 2**31 - 1))
DOUBLES = st.one_of(st.none(), st.sampled_from([0.0, -0.0, math.nan, math.inf, -math.inf, 1.5]), st.floats(width=32))


def rows_of(df):
    return sorted(map(str, df.collect()))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(big=st.lists(st.tuples(NUMBERS, DOUBLES), max_size=30), small=st.lists(st.tuples(NUMBERS, DOUBLES), max_size=10), most=st.sampled_from([0, 8 << 20]))
def test_no_match_is_lost(spark, big, small, most):
    big, small = spark.createDataFrame(big, "k int, x double"), spark.createDataFrame(small, "k bigint, y float")
    for on, keys in ((["k"], ["k"]), (["x"], ["y"]), (["k", "x"], ["k", "y"])):
        kept = key_filtered(big, small.select(*keys), on, most_bytes=most)
        match = lambda df: df.join(small.select(*[F.col(k).alias(f"s{i}") for i, k in enumerate(keys)]).distinct(), [F.col(c) == F.col(f"s{i}") for i, c in enumerate(on)], "left_semi")
        assert rows_of(match(kept)) == rows_of(match(big))
        assert kept.exceptAll(big).isEmpty()


def test_most_rows_without_a_match_are_dropped(spark):
    big = spark.range(200_000).select((F.col("id") * 7 % 1_000_003).alias("k"))
    small = spark.range(0, 1_000_000, 200).select("id")
    matches = big.join(small, big["k"] == small["id"], "left_semi").count()
    kept = key_filtered(big, small, ["k"]).count()
    assert matches <= kept < matches + 0.03 * 200_000
    # Without a filter, the bounds alone.
    assert key_filtered(big, spark.range(100), ["k"], most_bytes=0).count() == big.filter("k <= 99").count()


def test_bounds_reach_the_scan_and_the_filter_comes_before_the_shuffle(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    parts = spark.read.parquet(f"{sf_dir}/part.parquet").filter("p_size = 7 AND p_partkey > 500")
    low, high = parts.agg(F.min("p_partkey"), F.max("p_partkey")).first()
    joined = filtered_join(lines.withColumnRenamed("l_partkey", "p_partkey"), parts, ["p_partkey"]).groupBy("p_brand").count()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "l_partkey" in line and "PushedFilters" in line)
    assert f"GreaterThanOrEqual(l_partkey,{low})" in scan and f"LessThanOrEqual(l_partkey,{high})" in scan


@pytest.mark.parametrize("how, small", [("inner", "right"), ("left_semi", "right"), ("right", "right"), ("inner", "left"), ("left", "left"), ("left_semi", "left"), ("left_anti", "left")])
def test_joins_stay_as_they_are(spark, how, small):
    left = spark.createDataFrame([(k, i) for i, k in enumerate([1, 1, 2, 3, None, 5, 9] * 4)], "k int, a int")
    right = spark.createDataFrame([(k, i) for i, k in enumerate([1, 2, 2, None, 7, 9])], "k bigint, b int")
    assert rows_of(filtered_join(left, right, ["k"], how, small)) == rows_of(left.join(right, ["k"], how))
    assert rows_of(filtered_join(left.limit(0), right, ["k"], how, small)) == rows_of(left.limit(0).join(right, ["k"], how))
    assert rows_of(filtered_join(left, right.limit(0), ["k"], how, small)) == rows_of(left.join(right.limit(0), ["k"], how))


@pytest.mark.parametrize("how, small", [("full", "right"), ("left", "right"), ("left_anti", "right"), ("right", "left"), ("inner", "middle")])
def test_joins_that_return_rows_without_a_match_are_refused(spark, how, small):
    with pytest.raises(ValueError, match="without a match"):
        filtered_join(spark.range(2), spark.range(2), ["id"], how, small)


def test_filters_of_a_query(spark):
    frames = {"A.b.big": spark.range(1000).withColumnRenamed("id", "k"), "A.b.few": spark.range(5).selectExpr("id * 10 AS f", "id AS n")}
    sql = "SELECT k, n FROM A.b.big JOIN A.b.few ON k = f WHERE n < :n AND $COND{1}"
    wanted = {"input": "A.b.big", "columns": ["k"], "keys": "SELECT f FROM A.b.few WHERE n < :n"}
    found = run_query(spark, frames, sql, {"n": 3}, ["k > 5"], [wanted])
    assert sorted(map(tuple, found.collect())) == [(10, 1), (20, 2)]
    assert "Subquery" in found._jdf.queryExecution().executedPlan().toString()
    for change, error in (({"input": "x"}, "no input 'x'"), ({"columns": ["k", "k"]}, "2 columns"), ({"keys": "DROP TABLE t"}, "read-only")):
        with pytest.raises(ValueError, match=f"key filter 1: .*{error}"):
            run_query(spark, frames, sql, {"n": 3}, ["k > 5"], [wanted | change])
    with pytest.raises(ValueError, match="lacks columns, keys"):
        run_query(spark, frames, sql, {"n": 3}, ["k > 5"], [{"input": "A.b.big"}])


def test_the_filter_has_a_fixed_size(spark):
    words = spark.range(1).select(F.size(key_filter._words(spark.range(9000).select(F.xxhash64("id").alias("h")), 256)).alias("n")).first().n
    assert words == 256
