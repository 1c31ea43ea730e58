"""Window columns over sliced groups, against plain windows."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from acceptance.windows import FRAME, INTERVAL, RANK, SHARE, frame_events, interval_events, rank_orders, share_orders
from braid import over_groups
from braid.operators import windows

PLAIN = """
    SELECT id, g, a, b,
      ROW_NUMBER() OVER (PARTITION BY g ORDER BY a DESC, id) AS rn, RANK() OVER (PARTITION BY g ORDER BY a DESC) AS rk,
      DENSE_RANK() OVER (PARTITION BY g ORDER BY a DESC) AS dr, PERCENT_RANK() OVER (PARTITION BY g ORDER BY a DESC) AS pr,
      CUME_DIST() OVER (PARTITION BY g ORDER BY a DESC) AS cd, NTILE(4) OVER (PARTITION BY g ORDER BY a DESC, id) AS q,
      NTILE(900) OVER (PARTITION BY g ORDER BY a DESC, id) AS many
    FROM t"""
W = "PARTITION BY g ORDER BY a, id"
FRAMED = f"""
    SELECT id, COUNT(*) OVER ({W} ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS n5,
      MIN(b) OVER ({W} ROWS UNBOUNDED PRECEDING) AS low, SUM(b) OVER ({W} ROWS UNBOUNDED PRECEDING) AS total,
      COUNT(b) OVER ({W} ROWS UNBOUNDED PRECEDING) AS n, LAG(b) OVER ({W}) AS before, LEAD(b) OVER ({W}) AS after,
      LAG(b, 3) OVER ({W}) AS before3, LEAD(b, 70) OVER ({W}) AS after70, AVG(b) OVER ({W} ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS mean7,
      SUM(b) OVER ({W} ROWS BETWEEN 100 PRECEDING AND 2 FOLLOWING) AS sum103, MIN(b) OVER ({W} ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS low3,
      COUNT(b) OVER ({W} ROWS BETWEEN 40 PRECEDING AND 5 PRECEDING) AS gone, MAX(b) OVER ({W} ROWS BETWEEN 2 FOLLOWING AND 30 FOLLOWING) AS come
    FROM t"""
V = "PARTITION BY g ORDER BY a RANGE BETWEEN"
BY_VALUE = f"""
    SELECT id, SUM(b) OVER ({V} 3 PRECEDING AND CURRENT ROW) AS sum3, COUNT(b) OVER ({V} 5 PRECEDING AND 2 FOLLOWING) AS n8,
      SUM(c) OVER ({V} 1000 PRECEDING AND 1000 FOLLOWING) AS cents, COUNT(b) OVER ({V} 4 PRECEDING AND 2 PRECEDING) AS gone
    FROM t"""
BY_TIME = """
    SELECT id, SUM(b) OVER (PARTITION BY g ORDER BY t RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS week,
      COUNT(b) OVER (PARTITION BY g ORDER BY t RANGE BETWEEN INTERVAL '5400' SECOND PRECEDING AND INTERVAL '1' SECOND FOLLOWING) AS near
    FROM t"""


@pytest.fixture(params=["hot", "one group", "one value", "many"])
def rows(request, spark):
    """A third of all rows in one group; all in one; all peers; small groups. With nulls everywhere."""
    rng, n = random.Random(3), 1500
    some = lambda value: None if rng.random() < 0.1 else value
    group = {"hot": lambda: rng.choice([1, *range(2, 40)]) if rng.random() > 0.4 else 1, "many": lambda: rng.randrange(700)}.get(request.param, lambda: 1)
    value = (lambda: 5) if request.param == "one value" else (lambda: some(rng.choice([1, 1, 1, 2, 3, *range(60)])))
    made = [(i, some(group()) if request.param in ("hot", "many") else 1, value(), some(rng.randrange(100))) for i in range(n)]
    df = spark.createDataFrame(made, "id bigint, g int, a int, b int").repartition(5)
    df = df.withColumn("c", (F.col("b") / 7).cast("decimal(12,2)")).withColumn("t", F.expr("TIMESTAMP_NTZ '2024-03-01 00:00:00' + make_dt_interval(0, a * 7, b, a)"))
    df.createOrReplaceTempView("t")
    return df


def same(found, wanted):
    assert found.count() == wanted.count()
    assert wanted.exceptAll(found.select(*wanted.columns)).collect() == []


def test_ranks(spark, rows):
    found = over_groups(rows, ["g"], ["a DESC", "id"], row_number="rn", ntile={"q": 4, "many": 900})
    found = over_groups(found, ["g"], ["a DESC"], rank="rk", dense_rank="dr", percent_rank="pr", cume_dist="cd")
    same(found, spark.sql(PLAIN).selectExpr("*"))


def test_frames(spark, rows, monkeypatch):
    # Blocks no longer than the frames need; the other tests have one block.
    monkeypatch.setattr(windows, "HALO_ROWS", 1)
    found = over_groups(
        rows, ["g"], ["a", "id"], last_rows={"n5": 5}, running={"low": ("min", "b"), "total": ("sum", "b"), "n": ("count", "b")},
        previous={"before": "b", "before3": ("b", 3)}, following={"after": "b", "after70": ("b", 70)},
        sliding={"mean7": ("avg", "b", 6, 0), "sum103": ("sum", "b", 100, 2), "low3": ("min", "b", 1, 1), "gone": ("count", "b", 40, -5), "come": ("max", "b", -2, 30)},
    )
    same(found.drop("g", "a", "b", "c", "t"), spark.sql(FRAMED))


def test_frames_by_value(spark, rows):
    found = over_groups(rows, ["g"], ["a"], ranged={"sum3": ("sum", "b", 3, 0), "n8": ("count", "b", 5, 2), "cents": ("sum", "c", 1000, 1000), "gone": ("count", "b", 4, -2)})
    same(found.drop("g", "a", "b", "c", "t"), spark.sql(BY_VALUE))


def test_frames_by_time(spark, rows):
    found = over_groups(rows, ["g"], ["t"], ranged={"week": ("sum", "b", timedelta(days=7), timedelta()), "near": ("count", "b", timedelta(minutes=90), timedelta(seconds=1))})
    same(found.drop("g", "a", "b", "c", "t"), spark.sql(BY_TIME))


def test_frames_by_value_that_are_not_exact_are_refused(spark):
    df = spark.range(3).selectExpr("id", "CAST(id AS DOUBLE) AS x", "'a' AS s")
    for ranged, order in (({"y": ("sum", "x", 1, 0)}, ["id"]), ({"y": ("max", "id", 1, 0)}, ["id"]), ({"y": ("sum", "id", 1, 0)}, ["id DESC"]), ({"y": ("sum", "id", 1, 0)}, ["id", "s"])):
        with pytest.raises(ValueError, match="by value"):
            over_groups(df, [], order, ranged=ranged)


def test_all_rows_as_one_group_and_odd_names(spark):
    df = spark.range(500).selectExpr("id AS `a.b`", "array(id) AS m", "id % 7 AS `_slice.x`")
    found = over_groups(df, [], ["a.b"], row_number="r.n", rank="rk", running={"u": ("sum", "_slice.x")}, sliding={"s": ("sum", "_slice.x", 1, 1)}, previous={"p": "a.b"}, ranged={"v": ("count", "a.b", 2, 0)})
    rows = found.orderBy("`a.b`").collect()
    assert [r["r.n"] for r in rows] == [r.rk for r in rows] == list(range(1, 501))
    assert [r.p for r in rows] == [None, *range(499)] and [r.v for r in rows] == [1, 2, *[3] * 498]
    assert [r.s for r in rows][:4] == [1, 3, 6, 9] and rows[-1].u == sum(i % 7 for i in range(500))
    by = over_groups(df, ["_slice.x"], ["a.b DESC"], ntile={"q": 2}).filter("`_slice.x` = 3").orderBy("`a.b`").collect()
    assert [r.q for r in by] == [2] * 35 + [1] * 36


def test_the_acceptance_queries_use_several_slices(spark, sf_dir):
    orders, events = (spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("orders", "events"))
    orders = orders.withColumn("o_custkey", F.when(F.col("o_orderkey") % 2 == 0, 7).otherwise(F.col("o_custkey")))
    orders.createOrReplaceTempView("orders")
    events.createOrReplaceTempView("events")
    same(rank_orders(orders), spark.sql(RANK.format(orders="orders")))
    same(frame_events(events), spark.sql(FRAME.format(events="events")))
    same(share_orders(orders), spark.sql(SHARE.format(orders="orders")))
    events = events.withColumn("user_id", F.when(F.col("event_id") % 2 == 0, 7).otherwise(F.col("user_id")))
    events.createOrReplaceTempView("events")
    same(interval_events(events), spark.sql(INTERVAL.format(events="events")))


def test_rows_that_the_order_does_not_tell_apart_get_each_number_once(spark):
    df = spark.createDataFrame([(1, 2)] * 50 + [(1, 3)] * 50, "g int, a int")
    found = over_groups(df, ["g"], ["a"], row_number="rn").select("a", "rn").collect()
    assert sorted(row.rn for row in found) == list(range(1, 101))
    assert all((row.rn <= 50) == (row.a == 2) for row in found)


def test_a_large_group_is_many_slices_and_no_rows_are_none(spark):
    df = spark.range(4000).select(F.lit(1).alias("g"), "id")
    asked = windows._Asked(["g"], ["id"], df, {}, {}, {})
    rows = df.withColumn("_tie", F.xxhash64("g", "id")).withColumn("_group", F.lit(5).cast("bigint"))
    sizes = [row["count"] for row in asked.cut(rows, {5: 16}).groupBy("_slice").count().collect()]
    assert len(sizes) >= 16 and max(sizes) < 800
    assert over_groups(df.limit(0), ["g"], ["id"], row_number="rn", rank="rk").count() == 0


def test_without_heavy_groups_the_plan_is_a_plain_window(spark):
    df = spark.range(4000).select((F.col("id") % 1000).alias("g"), "id")
    plan = over_groups(df, ["g"], ["id"], row_number="rn")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan and "Union" not in plan
