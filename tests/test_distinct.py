"""Distinct counts over grouping sets: SQL's own counts, both ways of counting, one scan and one task per value at most."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from acceptance.counts import users_by_type_and_day
from braid import cube_sets, distinct_counts, rollup_sets

GROUP = st.one_of(st.none(), st.sampled_from("abc"))
ID = st.one_of(st.none(), st.integers(-3, 3), st.sampled_from([-(2**63), 2**63 - 1, 32767, 32768, 32769, -32768, 65536]))


def rows_of(df):
    return sorted(map(repr, map(tuple, df.collect())))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(st.tuples(GROUP, GROUP, ID), min_size=1, max_size=40))
def test_same_as_sql(spark, rows):
    df = spark.createDataFrame(rows, "a string, `b c` string, v bigint")
    df.createOrReplaceTempView("distinct_rows")
    for kind, sets in (("ROLLUP", rollup_sets(["a", "b c"])), ("CUBE", cube_sets(["a", "b c"]))):
        wanted = spark.sql(f"SELECT a, `b c`, GROUPING_ID(a, `b c`) AS g, COUNT(DISTINCT v) AS n FROM distinct_rows GROUP BY {kind} (a, `b c`)")
        for dense in (True, False):
            assert rows_of(distinct_counts(df, "v", sets, "n", "g", dense)) == rows_of(wanted)


@pytest.mark.parametrize("dense", [True, False])
def test_edges(spark, dense):
    none = spark.createDataFrame([], "a string, v bigint")
    assert rows_of(distinct_counts(none, "v", [("a",), ()], dense=dense)) == ["(None, 1, 0)"]
    # A set that is no part of another one, and the value as a grouping column.
    df = spark.createDataFrame([("x", "p", 1), ("x", "q", 1), ("y", "q", 2), ("y", "q", None)], "a string, b string, v bigint")
    found = distinct_counts(df, "v", [("b",), ("a",)], dense=dense)
    assert found.columns == ["b", "a", "grouping_id", "n"]
    assert rows_of(found) == sorted(map(repr, [("p", None, 1, 1), ("q", None, 1, 2), (None, "x", 2, 1), (None, "y", 2, 1)]))
    assert rows_of(distinct_counts(df, "v", [("v",)], dense=dense)) == sorted(map(repr, [(1, 0, 1), (2, 0, 1), (None, 0, 0)]))
    for sets in ([], [("a", "b"), ("b", "a")]):
        with pytest.raises(ValueError, match="grouping set"):
            distinct_counts(df, "v", sets, dense=dense)
    with pytest.raises(ValueError, match="share the name 'a'"):
        distinct_counts(df, "v", [("a",)], "a", dense=dense)


def test_any_type(spark):
    df = spark.sql("SELECT id % 3 AS g, CONCAT('v', id % 50) AS v FROM range(1000)")
    assert rows_of(distinct_counts(df, "v", rollup_sets(["g"]))) == sorted(map(repr, [(0, 0, 50), (1, 0, 50), (2, 0, 50), (None, 1, 50)]))


@pytest.mark.parametrize("dense", [True, False])
def test_one_scan_and_no_expansion(spark, sf_dir, dense):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    found = users_by_type_and_day(events) if dense else distinct_counts(events, "user_id", rollup_sets(["event_type"]))
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().partition("== Initial Plan ==")[0]
    assert plan.count("FileScan parquet") == 1 and "Expand" not in plan
