"""Plans that hold at scale: what reaches the scans, what is shuffled, what stays off the driver."""

import contextlib
import io
import re
from pathlib import Path

import pytest

from pyspark.sql import functions as F

import __spark_entry__ as contract
from acceptance import connectors, joins, relational, windows
from braid import load_inputs, run_query
from braid.operators.skew import heavy_hashes, key_hash

KEYS = sorted(key for part in (connectors, joins, relational, windows) for key in part.queries())
ROOT = Path(__file__).resolve().parents[1]


def plan(df):
    """The physical plan as ``explain`` prints it."""
    with contextlib.redirect_stdout(io.StringIO()) as printed:
        df.explain("formatted")
    return printed.getvalue()


@pytest.fixture
def no_broadcast(spark):
    """Plan joins as for tables that are too large to broadcast."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_filters_and_columns_reach_the_scan(spark, sf_dir):
    spec = {"name": "A.b.t", "config": {"type": "local"}, "file-type": "parquet", "file-path": f"{sf_dir}/orders.parquet"}
    found = plan(run_query(spark, load_inputs(spark, [spec]), "SELECT o_orderkey FROM A.b.t WHERE o_custkey = 5"))
    assert "EqualTo(o_custkey,5)" in found
    assert re.search(r"ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>", found)


@pytest.mark.parametrize("key", KEYS)
def test_no_nested_loops_or_forced_broadcasts(spark, sf_dir, key):
    found = plan(contract.queries()[key](spark, sf_dir))
    assert "NestedLoop" not in found and "Cartesian" not in found
    assert "ResolvedHint" not in found


SHUFFLES = {
    "left_join": 2, "semi_join_exists": 2, "in_subquery": 2, "inner_join_agg": 3, "multi_way_join": 9, "cube_agg": 2,
    "distinct_agg": 2, "top_k": 0, "filter_project": 0, "correlated_scalar": 3,
}


@pytest.mark.parametrize("key", sorted(SHUFFLES))
def test_number_of_shuffles(spark, sf_dir, no_broadcast, key):
    tree = plan(contract.queries()[key](spark, sf_dir)).split("\n\n\n")[0]
    assert len(re.findall(r"\bExchange \(", tree)) == SHUFFLES[key]


@pytest.mark.parametrize("key", ["left_join", "inner_join_agg", "semi_join_exists", "in_subquery", "except_distinct"])
def test_a_join_key_is_reduced_before_its_shuffle(spark, sf_dir, no_broadcast, key):
    """On the side that may have one very large key, a partial aggregate runs below the exchange."""
    tree = plan(contract.queries()[key](spark, sf_dir)).split("\n\n\n")[0]
    below = re.findall(r"Exchange \(\d+\)\n[^\n]*(HashAggregate|Scan|Filter|Project|ColumnarToRow)", tree)
    assert "HashAggregate" in below


def test_bucketed_tables_join_in_place(spark, sf_dir, no_broadcast, tmp_path):
    for name, key in (("orders", "o_orderkey"), ("lineitem", "l_orderkey")):
        writer = spark.read.parquet(f"{sf_dir}/{name}.parquet").write.bucketBy(8, key).sortBy(key)
        writer.option("path", str(tmp_path / name)).saveAsTable(f"default.bucketed_{name}")
    inputs = [
        {"datasource": "LAKE", "config": {"type": "hive"}, "database": "default", "table": f"bucketed_{name}"}
        for name in ("orders", "lineitem")
    ]
    sql = "SELECT COUNT(*) AS n FROM LAKE.default.bucketed_lineitem JOIN LAKE.default.bucketed_orders ON l_orderkey = o_orderkey"
    tree = plan(run_query(spark, load_inputs(spark, inputs), sql)).split("\n\n\n")[0]
    assert len(re.findall(r"\bExchange \(", tree)) == 1  # the final count alone


def test_partitions_are_pruned(spark, sf_dir, tmp_path):
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.partitionBy("o_orderstatus").parquet(str(tmp_path / "t"))
    spec = {"datasource": "FILES", "file-type": "parquet", "file-path": str(tmp_path / "t"), "name": "A.b.t"}
    found = plan(run_query(spark, load_inputs(spark, [spec]), "SELECT o_orderkey FROM A.b.t WHERE o_orderstatus = 'F'"))
    assert re.search(r"PartitionFilters: \[[^]]*o_orderstatus", found)


# What goes through the driver or to all tasks, and why it is small: heavy keys and cuts number a few for each task, as their share
# of all rows says; a tree of bins has five levels; a database gives one cut for each task that the input asks for.
BOUNDED = {"sources/jdbc.py": [".collect"], "operators/skew.py": [".collect", ".collect", "broadcast("], "operators/windows.py": ["broadcast(", ".collect", "broadcast("], "operators/range_join.py": [".collect"]}


def test_nothing_large_goes_through_the_driver_or_python():
    banned = r"\.(?:collect|toPandas|toLocalIterator|rdd|foreach|localCheckpoint|crossJoin|mapInPandas)\b|broadcast\(|@F\.udf"
    for part in ("braid", "acceptance"):
        for path in (path for path in (ROOT / part).rglob("*.py") if "llm" not in path.parts):
            assert re.findall(banned, path.read_text()) == BOUNDED.get(f"{path.parent.name}/{path.name}", []), path


def test_heavy_keys_are_as_few_as_their_share_says(spark):
    df = spark.range(3000).select((F.col("id") % 20).alias("k"))
    heavy, n = heavy_hashes(df, key_hash(df, ["k"]), 1 / 16)
    assert heavy == {} and n == 3000
    assert len(heavy_hashes(df, key_hash(df, ["k"]), 1 / 20)[0]) == 20
