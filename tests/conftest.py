import os
import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("braid-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


# Changes that give the tables nulls and, to each column that joins or groups, one value in a third of all rows.
SKEWED = {
    "orders": """
        CASE WHEN o_orderkey % 3 = 0 THEN 7 WHEN o_orderkey % 50 = 1 THEN NULL ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 20 <> 3 THEN o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 40 <> 5 THEN o_totalprice END AS o_totalprice,
        CASE WHEN o_orderkey % 30 <> 5 THEN o_orderdate END AS o_orderdate""",
    "lineitem": """
        CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 33 WHEN l_orderkey % 50 = 1 THEN NULL ELSE l_orderkey END
          AS l_orderkey,
        CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 5 ELSE l_partkey END AS l_partkey,
        CASE WHEN l_partkey % 9 <> 0 THEN l_returnflag END AS l_returnflag,
        CASE WHEN l_partkey % 11 <> 0 THEN l_shipdate END AS l_shipdate""",
    "customer": """
        CASE WHEN c_custkey % 3 = 0 THEN 3 WHEN c_custkey % 20 = 1 THEN NULL ELSE c_nationkey END AS c_nationkey,
        CASE WHEN c_custkey % 25 <> 1 THEN c_mktsegment END AS c_mktsegment""",
    "supplier": "CASE WHEN s_suppkey % 3 = 0 THEN 3 WHEN s_suppkey % 10 = 1 THEN NULL ELSE s_nationkey END AS s_nationkey",
    "events": """
        CASE WHEN event_id % 3 = 0 THEN 7 WHEN event_id % 50 = 1 THEN NULL ELSE user_id END AS user_id,
        CASE WHEN event_id % 7 <> 1 THEN value END AS value,
        CASE WHEN event_id % 8 <> 1 THEN props END AS props""",
}


@pytest.fixture(scope="session")
def skewed_dir(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    for table in Path("/root/testdata/sf0.001").glob("*.parquet"):
        change = SKEWED.get(table.stem)
        columns = f"* REPLACE ({change})" if change else "*"
        duckdb.sql(f"COPY (SELECT {columns} FROM '{table}') TO '{folder / table.name}' (FORMAT parquet)")
    return str(folder)
