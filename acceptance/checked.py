"""Files with bad records: rows that keep to the declared schema, and rejects."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acceptance.tables import CSV, table
from braid import read_checked
from braid.shared import fresh_path

SCHEMA = [
    {"name": "o_orderkey", "datatype": "long", "nullable": True},
    {"name": "o_custkey", "datatype": "long", "nullable": True},
    {"name": "o_totalprice", "datatype": "double", "nullable": True},
]
COLUMNS = [field["name"] for field in SCHEMA]

_copies: dict[tuple, str] = {}


def bad_copy(spark: SparkSession, sf_dir: str, kind: str) -> dict:
    """Orders as text in which each seventh price is none, and each eleventh record of JSON is cut off."""
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    if key not in _copies:
        orders = table(spark, sf_dir, "orders").select(*COLUMNS)
        bad = F.col("o_orderkey") % 7 == 0
        path = fresh_path(spark, f"bad_{kind}")
        if kind == "csv":
            price = F.when(bad, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
            orders.withColumn("o_totalprice", price).write.options(**CSV).csv(path)
        else:
            whole = F.to_json(F.struct(*COLUMNS))
            wrong = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"), F.lit(',"o_totalprice":"n/a"}'))
            cut = F.concat(F.lit('{"o_orderkey":'), F.col("o_orderkey").cast("string"))
            orders.select(F.when(F.col("o_orderkey") % 11 == 0, cut).when(bad, wrong).otherwise(whole)).write.text(path)
        _copies[key] = path
    how = CSV if kind == "csv" else {}
    return {"datasource": "FILES", "name": "ORDERS", "file-type": kind, "file-path": _copies[key], "schema": SCHEMA, **how}


def _checked(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    rows, rejects = read_checked(spark, bad_copy(spark, sf_dir, kind))
    key = F.regexp_extract("record", "[0-9]+", 0).cast("bigint").alias("o_orderkey")
    no_values = [F.lit(None).cast(rows.schema[c].dataType).alias(c) for c in COLUMNS[1:]]
    return rows.withColumn("reason", F.lit(None).cast("string")).unionByName(rejects.select(key, *no_values, "reason"))


def scan_csv_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, "csv")


def scan_json_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir, "json")


def queries() -> dict:
    return {"scan_csv_checked": scan_csv_checked, "scan_json_checked": scan_json_checked}


def oracle_sql() -> dict[str, str]:
    def sql(reason: str) -> str:
        return f"""
        SELECT o_orderkey, CASE WHEN reason IS NULL THEN o_custkey END AS o_custkey,
          CASE WHEN reason IS NULL THEN o_totalprice END AS o_totalprice, reason
        FROM (SELECT *, {reason} AS reason FROM orders) o"""

    price = "CASE WHEN o_orderkey % 7 = 0 THEN 'o_totalprice: n/a' END"
    return {
        "scan_csv_checked": sql(price),
        "scan_json_checked": sql(f"CASE WHEN o_orderkey % 11 = 0 THEN 'not readable' ELSE {price} END"),
    }
