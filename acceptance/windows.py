"""Window queries that hold up when one group has a large part of all rows."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.tables import loaded
from braid import over_groups

RANK = """
    SELECT o_custkey, o_orderkey,
      CAST(ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS rn,
      CAST(RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS rk,
      CAST(DENSE_RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS BIGINT) AS dr
    FROM {orders}"""
SHARE = """
    SELECT o_custkey, o_orderkey,
      CAST(NTILE(4) OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS BIGINT) AS quarter,
      PERCENT_RANK() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS pr,
      CUME_DIST() OVER (PARTITION BY o_custkey ORDER BY o_orderpriority) AS cd
    FROM {orders}"""
# Money in whole cents, so that sums and averages are exact on both sides.
FRAME = """
    SELECT event_id,
      COUNT(*) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n3,
      MAX(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running_max,
      LAG(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_id,
      LEAD(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_id,
      LAG(event_id, 3) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS third_last_id,
      AVG(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS moving_avg,
      MIN(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS least_around
    FROM (SELECT *, CAST(ROUND(value * 100) AS BIGINT) AS cents FROM {events}) e"""
INTERVAL = """
    SELECT event_id, user_id,
      CAST(SUM(cents) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND CURRENT ROW) AS BIGINT) AS week_cents,
      COUNT(value) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL 7 DAYS PRECEDING AND INTERVAL 7 DAYS FOLLOWING) AS around
    FROM (SELECT *, CAST(ROUND(value * 100) AS BIGINT) AS cents FROM {events}) e"""


def window_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_orders(loaded(spark, sf_dir, "SALES.tpch.orders"))


def rank_orders(orders: DataFrame) -> DataFrame:
    orders = orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    numbered = over_groups(orders, ["o_custkey"], ["o_totalprice DESC", "o_orderkey"], row_number="rn")
    ranked = over_groups(numbered.select("o_custkey", "o_orderkey", "o_orderpriority", "rn"), ["o_custkey"], ["o_orderpriority"], rank="rk", dense_rank="dr")
    return ranked.select("o_custkey", "o_orderkey", "rn", "rk", "dr")


def window_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    return frame_events(loaded(spark, sf_dir, "WEB.tpch.events"))


def frame_events(events: DataFrame) -> DataFrame:
    framed = over_groups(
        events.select("event_id", "user_id", "ts", "value", _cents()), ["user_id"], ["ts", "event_id"],
        last_rows={"n3": 3}, running={"running_max": ("max", "value")},
        previous={"prev_id": "event_id", "third_last_id": ("event_id", 3)}, following={"next_id": "event_id"},
        sliding={"moving_avg": ("avg", "cents", 6, 0), "least_around": ("min", "cents", 2, 2)},
    )
    return framed.drop("user_id", "ts", "value", "cents")


def _cents():
    return F.round(F.col("value") * 100).cast("bigint").alias("cents")


def window_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return share_orders(loaded(spark, sf_dir, "SALES.tpch.orders"))


def share_orders(orders: DataFrame) -> DataFrame:
    orders = orders.select("o_custkey", "o_orderkey", "o_totalprice", "o_orderpriority")
    parts = over_groups(orders, ["o_custkey"], ["o_totalprice DESC", "o_orderkey"], ntile={"quarter": 4})
    shares = over_groups(parts.drop("o_totalprice"), ["o_custkey"], ["o_orderpriority"], percent_rank="pr", cume_dist="cd")
    return shares.select("o_custkey", "o_orderkey", "quarter", "pr", "cd")


def window_interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interval_events(loaded(spark, sf_dir, "WEB.tpch.events"))


def interval_events(events: DataFrame) -> DataFrame:
    week = timedelta(days=7)
    framed = over_groups(
        events.select("event_id", "user_id", "ts", "value", _cents()), ["user_id"], ["ts"],
        ranged={"week_cents": ("sum", "cents", week, timedelta()), "around": ("count", "value", week, week)},
    )
    return framed.select("event_id", "user_id", "week_cents", "around")


def queries() -> dict:
    return {"window_rank": window_rank, "window_frame": window_frame, "window_share": window_share, "window_interval": window_interval}


def oracle_sql() -> dict[str, str]:
    texts = {"window_rank": RANK, "window_frame": FRAME, "window_share": SHARE, "window_interval": INTERVAL}
    return {key: text.format(orders="orders", events="events") for key, text in texts.items()}
