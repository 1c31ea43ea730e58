"""Joins by the library's own operators: of a large table with few keys, by heavy keys, and of values with ranges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.tables import ask, loaded
from braid import range_join, skew_join

# Lines of the few parts of one kind and size; their keys leave most lines out before the shuffle.
PARTS = "SELECT p_partkey FROM {part} WHERE p_size BETWEEN 20 AND 21 AND p_brand LIKE '%1'"
KEY_FILTER = f"""
    SELECT p_brand, l_suppkey, COUNT(*) AS n, CAST(SUM(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS gross
    FROM {{lineitem}} JOIN {{part}} ON l_partkey = p_partkey
    WHERE p_partkey IN ({PARTS})
    GROUP BY p_brand, l_suppkey"""

# A third of all orders is one customer's; some have no customer, and half of the customers are left out.
HOT = "SELECT CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey END AS k, o_orderkey, o_totalprice FROM {orders}"
SOME = "SELECT c_custkey AS k, c_name FROM {customer} WHERE c_custkey % 2 = 1"

# Price ranges of uneven width, one per part size; they overlap, and one covers everything.
RANGES = """
    SELECT DISTINCT p_size AS range_id, p_size * p_size * 150 AS low, p_size * p_size * 150 + 700 * p_size AS high FROM {part}
    UNION ALL SELECT 0, -1, 2000000000"""


def key_filter_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = {"lineitem": "SALES.tpch.lineitem", "part": "SALES.tpch.part"}
    wanted = {"input": names["lineitem"], "columns": "l_partkey", "keys": PARTS.format(**names)}
    return ask(spark, sf_dir, KEY_FILTER.format(**names), key_filters=[wanted])


def _hot(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return ask(spark, sf_dir, HOT.format(orders="SALES.tpch.orders")), ask(spark, sf_dir, SOME.format(customer="CRM.tpch.customer"))


def skew_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew_join(*_hot(spark, sf_dir), ["k"], "full")


def skew_anti_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return skew_join(*_hot(spark, sf_dir), ["k"], "left_anti")


def ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ask(spark, sf_dir, RANGES.format(part="SALES.tpch.part"))


def prices_in_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = loaded(spark, sf_dir, "SALES.tpch.orders").select("o_orderkey", "o_totalprice")
    return range_join(orders, ranges(spark, sf_dir), "o_totalprice", "low", "high").select("o_orderkey", "o_totalprice", F.col("range_id"))


def queries() -> dict:
    return {"key_filter_join": key_filter_join, "skew_full_join": skew_full_join, "skew_anti_join": skew_anti_join, "range_join": prices_in_ranges}


def oracle_sql() -> dict[str, str]:
    tables = {name: name for name in ("lineitem", "part", "orders", "customer")}
    hot, some = HOT.format(**tables), SOME.format(**tables)
    return {
        "key_filter_join": KEY_FILTER.format(**tables),
        "skew_full_join": f"SELECT COALESCE(o.k, c.k) AS k, o_orderkey, o_totalprice, c_name FROM ({hot}) o FULL JOIN ({some}) c ON o.k = c.k",
        "skew_anti_join": f"SELECT k, o_orderkey, o_totalprice FROM ({hot}) o WHERE NOT EXISTS (SELECT 1 FROM ({some}) c WHERE c.k = o.k)",
        "range_join": f"""
        SELECT o_orderkey, o_totalprice, range_id FROM orders
        JOIN ({RANGES.format(**tables)}) ON o_totalprice >= low AND o_totalprice < high""",
    }
