"""Distinct counts over several grouping sets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.tables import loaded
from braid import cube_sets, distinct_counts, rollup_sets


def distinct_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return users_by_type_and_day(loaded(spark, sf_dir, "WEB.tpch.events"))


def users_by_type_and_day(events: DataFrame) -> DataFrame:
    events = events.select("event_type", F.to_date("ts").alias("day"), "user_id")
    return distinct_counts(events, "user_id", rollup_sets(["event_type", "day"]), "users", dense=True)


def distinct_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = loaded(spark, sf_dir, "SALES.tpch.orders").select("o_orderstatus", "o_orderpriority", "o_orderdate")
    return distinct_counts(orders, "o_orderdate", cube_sets(["o_orderstatus", "o_orderpriority"]), "days")


def queries() -> dict:
    return {"distinct_rollup": distinct_rollup, "distinct_cube": distinct_cube}


def oracle_sql() -> dict[str, str]:
    return {
        "distinct_rollup": """
        SELECT event_type, day, CAST(GROUPING(event_type, day) AS BIGINT) AS grouping_id, COUNT(DISTINCT user_id) AS users
        FROM (SELECT event_type, CAST(ts AS DATE) AS day, user_id FROM events) e GROUP BY ROLLUP (event_type, day)""",
        "distinct_cube": """
        SELECT o_orderstatus, o_orderpriority, CAST(GROUPING(o_orderstatus, o_orderpriority) AS BIGINT) AS grouping_id,
          COUNT(DISTINCT o_orderdate) AS days
        FROM orders GROUP BY CUBE (o_orderstatus, o_orderpriority)""",
    }
