"""Queries for sources, name binding, parameters, outputs and whole jobs."""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession

from acceptance.tables import CSV, ask, copied, declared, inputs_for, parquet, table
from braid import load_inputs, read_source, run_job, run_query, write_once, write_output, write_outputs
from braid.operators.sinks import lowercase_columns
from braid.shared import fresh_path

CUSTOMER_COLUMNS = """CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS INT) AS c_nationkey,
    c_acctbal, c_mktsegment"""
ORDERS = "SALES.tpch.orders"


# Sources


def scan_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, parquet(spark, sf_dir, "orders"))


def scan_csv_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, copied(spark, sf_dir, "orders", "csv"))


def scan_json_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_source(spark, copied(spark, sf_dir, "orders", "json"))


def _customer_inferred(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    spec = copied(spark, sf_dir, "customer", kind, infer=True, name="CUSTOMER_FILE")
    return run_query(spark, load_inputs(spark, [spec]), f"SELECT {CUSTOMER_COLUMNS} FROM CUSTOMER_FILE")


def scan_csv_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_inferred(spark, sf_dir, "csv")


def scan_json_inferred(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _customer_inferred(spark, sf_dir, "json")


def _named_by_path(spec: dict) -> dict:
    """The same input, with the datasource that its path scheme calls for."""
    path = spec["file-path"]
    source = "S3" if path.startswith(("s3a:", "s3:")) else "HDFS" if path.startswith("hdfs:") else "FILES"
    return {**spec, "datasource": source, "config": {"type": source}}


def scan_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same table through three kinds of file source, each with another format."""
    orders = parquet(spark, sf_dir, "orders", name="IN_PARQUET")
    as_csv = copied(spark, sf_dir, "orders", "csv", name="IN_CSV") | {"config": {"type": "files"}}
    as_json = copied(spark, sf_dir, "orders", "json", name="IN_JSON") | {"config": {"type": "hdfs"}}
    sql = """
        SELECT 'local' AS via, * FROM IN_PARQUET UNION ALL
        SELECT 'files' AS via, * FROM IN_CSV UNION ALL
        SELECT 'hdfs' AS via, * FROM IN_JSON"""
    return run_query(spark, load_inputs(spark, [orders, as_csv, as_json]), sql)


@functools.cache
def _catalog_table(spark: SparkSession, sf_dir: str) -> str:
    """A copy of ``customer`` in the catalog, made once per session."""
    name = f"customer_{uuid.uuid4().hex}"
    table(spark, sf_dir, "customer").write.option("path", fresh_path(spark, name)).saveAsTable(f"default.{name}")
    return name


def scan_catalog_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = _catalog_table(spark, sf_dir)
    spec = {"datasource": "HIVE", "config": {"type": "hive"}, "database": "default", "table": name}
    return run_query(spark, load_inputs(spark, [spec]), f"SELECT * FROM HIVE.default.{name}")


ALL_TYPES = """
    SELECT CAST(l_linenumber AS TINYINT) AS t_byte, CAST(l_linenumber AS SMALLINT) AS t_short, l_linenumber AS t_int,
      l_orderkey AS t_long, CAST(l_quantity AS FLOAT) AS t_float, l_tax AS t_double,
      CAST(l_extendedprice AS DECIMAL(12,2)) AS t_decimal, l_returnflag AS t_string, l_quantity > 25 AS t_boolean,
      CAST(l_shipdate AS DATE) AS t_date, l_shipdate AS t_ts
    FROM {lineitem}"""
# Column -> declared datatype.
TYPED = {
    "t_byte": "byte", "t_short": "short", "t_int": "integer", "t_long": "long", "t_float": "float",
    "t_double": "double", "t_decimal": "decimal(12,2)", "t_string": "varchar", "t_boolean": "boolean",
    "t_date": "date", "t_ts": "timestamp",
}


def typed_schema_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "typed")
    rows = ask(spark, sf_dir, ALL_TYPES.format(lineitem="SALES.tpch.lineitem"))
    file = {"config": {"type": "local"}, "file-type": "csv", "file-path": path, **CSV}
    write_output(rows, {"datasink": "TYPED", **file})
    fields = [{"name": name, "datatype": kind, "nullable": True} for name, kind in TYPED.items()]
    frames = load_inputs(spark, [{"name": "TYPED", **file, "schema": fields}])
    others = ", ".join(name for name in TYPED if name != "t_ts")
    return run_query(spark, frames, f"SELECT {others}, CAST(t_ts AS TIMESTAMP_NTZ) AS t_ts FROM TYPED")


# Names, parameters, safety

BOUND_JOIN = """
    SELECT {orders}.o_orderkey, c.c_name, {kept} AS kept
    FROM {orders} JOIN {customer} c ON {orders}.o_custkey = c.c_custkey"""


def bind_database_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A name with three parts and one with four; the same text in a literal and a comment stays."""
    orders = parquet(spark, sf_dir, "orders", datasource="SALES", database="tpch", table="orders")
    customer = parquet(spark, sf_dir, "customer", datasource="CRM", database="tpch", schema="main", table="customer")
    sql = BOUND_JOIN.format(orders=ORDERS, customer="CRM.tpch.main.customer", kept=f"'{ORDERS}'")
    sql += f" -- no input is called {ORDERS}_old"
    return run_query(spark, load_inputs(spark, [orders, customer]), sql)


def bind_file_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files named by their paths, with dots for slashes."""
    orders = _named_by_path(parquet(spark, sf_dir, "orders"))
    customer = _named_by_path(copied(spark, sf_dir, "customer", "csv"))
    frames = load_inputs(spark, [orders, customer])
    first, second = frames
    kept = f"CASE WHEN '{first}' LIKE '%.orders.parquet' THEN 'as written' ELSE 'changed' END"
    return run_query(spark, frames, BOUND_JOIN.format(orders=first, customer=second, kept=kept))


PLAIN = """
    SELECT o_orderkey AS {orders}, o_custkey.c_name AS c_name, o_totalprice FROM {orders}
    JOIN {customer} AS o_custkey ON {orders}.o_custkey = o_custkey.c_custkey WHERE o_totalprice > {low}"""


def bind_plain_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inputs named by one word: one like a column and a parameter, one like an alias; columns, alias and parameter stay."""
    frames = {"low": table(spark, sf_dir, "orders"), "o_custkey": table(spark, sf_dir, "customer")}
    sql = PLAIN.format(orders="low", customer="o_custkey", low=":low")
    return run_query(spark, frames, sql, params={"low": 50000})


def bind_isolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two queries with the same name over different tables do not disturb each other."""
    name = "SALES.tpch.t"
    sql = "SELECT '{tag}' AS tag, {key} AS k FROM SALES.tpch.t"
    first = run_query(spark, {name: table(spark, sf_dir, "orders")}, sql.format(tag="orders", key="o_orderkey"))
    second = run_query(spark, {name: table(spark, sf_dir, "customer")}, sql.format(tag="customer", key="c_custkey"))
    return first.union(second)


CONDITIONED = "SELECT o_orderkey, o_totalprice FROM {orders} WHERE {first} AND {second}"
CONDITIONS = ["o_orderpriority IN ('1-URGENT', '2-HIGH')", "o_totalprice BETWEEN 1000 AND 200000"]


def dynamic_conditions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first condition as text; the second as text with values for its markers."""
    sql = CONDITIONED.format(orders=ORDERS, first="$COND{1}", second="$COND{2}")
    conditions = [CONDITIONS[0], "o_totalprice BETWEEN :low AND :high"]
    return ask(spark, sf_dir, sql, conditions=conditions, params={"low": 1000, "high": 200000})


GUARDED = """
    SELECT o_orderkey, o_orderdate AS created_at, 'dropped' AS state FROM {orders}
    WHERE o_orderstatus <> 'delete' /* create nothing */"""


def read_only_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ask(spark, sf_dir, GUARDED.format(orders=ORDERS))


# Outputs


def _target(spark: SparkSession, kind: str, **more) -> dict:
    """A file target that nothing has used yet, fit to be an output and an input."""
    file = {"datasink": "OUT", "name": "OUT", "config": {"type": "local"}, "file-type": kind}
    return {**file, "file-path": fresh_path(spark, f"out_{kind}"), **(CSV if kind == "csv" else {}), **more}


def _read_back(spark: SparkSession, target: dict, like: DataFrame) -> DataFrame:
    """What an output holds, with the columns of the frame that was written."""
    return read_source(spark, {**target, "schema": declared(like.schema)}).select(*like.columns)


def sink_parquet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written, overwritten, then appended to: two copies remain."""
    orders, target = table(spark, sf_dir, "orders"), _target(spark, "parquet")
    for append in (False, False, True):
        write_output(orders, {**target, "append": append})
    return _read_back(spark, target, orders)


def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), _target(spark, "csv", nullValue="(none)")
    write_output(orders, {**target, "codec": "gzip"})
    return _read_back(spark, target, orders)


def sink_json_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, target = table(spark, sf_dir, "orders"), _target(spark, "json", append=True)
    write_output(orders, target)
    write_output(orders, target)
    return _read_back(spark, target, orders)


NULLED = "SELECT o_orderkey, NULLIF(o_orderstatus, 'F') AS status, NULLIF(o_custkey, 1) AS custkey FROM {orders}"


def sink_json_nullfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Null text becomes the word ``null``; a null number stays null."""
    rows, target = ask(spark, sf_dir, NULLED.format(orders=ORDERS)), _target(spark, "json")
    write_output(rows, {**target, "append": False, "null-fill": True})
    sql = "SELECT o_orderkey, status, COALESCE(custkey, -1) AS custkey FROM OUT"
    return run_query(spark, {"OUT": _read_back(spark, target, rows)}, sql)


def sink_repartition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As many files as asked for, here by the number of rows."""
    lineitem, target = table(spark, sf_dir, "lineitem"), _target(spark, "parquet")
    write_output(lineitem, {**target, "output-partitions-count": 3 + lineitem.count() // 5_000_000})
    sql = "SELECT COUNT(DISTINCT file) AS files, COUNT(*) AS n FROM (SELECT input_file_name() AS file FROM OUT)"
    return run_query(spark, load_inputs(spark, [target]), sql)


def lowercase_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, target = table(spark, sf_dir, "customer"), _target(spark, "parquet")
    upper = customer.toDF(*[column.upper() for column in customer.columns])
    write_output(upper, {**target, "lowercase-columns": True})
    return read_source(spark, target).select(*lowercase_columns(upper).columns)


BIG_SPENDERS = "SELECT o_custkey, COUNT(*) AS n, MAX(o_totalprice) AS top FROM {orders} GROUP BY o_custkey"


def _tagged(spark: SparkSession, targets: dict[str, dict], like: DataFrame) -> DataFrame:
    frames = {tag: _read_back(spark, target, like) for tag, target in targets.items()}
    return run_query(spark, frames, " UNION ALL ".join(f"SELECT '{tag}' AS sink, * FROM {tag}" for tag in frames))


def sink_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    targets = {
        "as_parquet": _target(spark, "parquet"),
        "as_json": {**_target(spark, "json"), "config": {"type": "hdfs"}},
        "as_csv": {**_target(spark, "csv"), "config": {"type": "files"}},
    }
    result = write_outputs(ask(spark, sf_dir, BIG_SPENDERS.format(orders=ORDERS)), list(targets.values()))
    return _tagged(spark, targets, result)


def sink_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two outputs of a run that is called three times."""
    targets = {kind: {**_target(spark, kind), "append": True} for kind in ("parquet", "json")}
    run_id = f"spenders_{uuid.uuid4().hex}"
    for _ in range(3):
        result = write_once(ask(spark, sf_dir, BIG_SPENDERS.format(orders=ORDERS)), list(targets.values()), run_id)
    return _tagged(spark, targets, result)


JOB = """
    SELECT c_mktsegment, o_orderpriority, SUM(n) AS n_orders, MAX(top) AS top
    FROM (SELECT o_custkey, o_orderpriority, COUNT(*) AS n, MAX(o_totalprice) AS top
          FROM SALES.tpch.orders WHERE $COND{1} GROUP BY o_custkey, o_orderpriority)
    JOIN CRM.tpch.customer ON o_custkey = c_custkey
    GROUP BY c_mktsegment, o_orderpriority"""


def job_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parquet and CSV inputs, a condition, one query, two outputs."""
    targets = {"as_parquet": _target(spark, "parquet", append=False), "as_json": _target(spark, "json", append=False)}
    job = {
        "sql": JOB,
        "inputs": inputs_for(spark, sf_dir, JOB),
        "outputs": list(targets.values()),
        "dynamic-conditions": [CONDITIONS[1]],
    }
    return _tagged(spark, targets, run_job(spark, job))


def queries() -> dict:
    return {
        query.__name__: query
        for query in (
            scan_parquet, scan_csv_declared, scan_json_declared, scan_csv_inferred, scan_json_inferred, scan_files,
            scan_catalog_table, typed_schema_all_types, bind_database_names, bind_file_names, bind_isolation,
            dynamic_conditions, bind_plain_names, read_only_guard, sink_parquet, sink_csv, sink_json_append, sink_json_nullfill,
            sink_repartition, sink_fanout, sink_once, job_end_to_end,
        )
    } | {"lowercase_columns": lowercase_output}


def oracle_sql() -> dict[str, str]:
    orders, customer = "SELECT * FROM orders", "SELECT * FROM customer"
    join = BOUND_JOIN.replace("{orders}.", "o.").replace("{orders}", "orders o").replace("{customer}", "customer")
    spenders = BIG_SPENDERS.format(orders="orders")
    job = f"""
        SELECT c_mktsegment, o_orderpriority, COUNT(*) AS n_orders, MAX(o_totalprice) AS top
        FROM orders JOIN customer ON o_custkey = c_custkey WHERE {CONDITIONS[1]}
        GROUP BY c_mktsegment, o_orderpriority"""

    def tagged(sql: str, column: str, tags: tuple[str, ...]) -> str:
        return " UNION ALL ".join(f"SELECT '{tag}' AS {column}, * FROM ({sql})" for tag in tags)

    return {
        "scan_parquet": orders,
        "scan_csv_declared": orders,
        "scan_json_declared": orders,
        "scan_csv_inferred": customer,
        "scan_json_inferred": customer,
        "scan_files": tagged(orders, "via", ("local", "files", "hdfs")),
        "scan_catalog_table": customer,
        "typed_schema_all_types": ALL_TYPES.format(lineitem="lineitem"),
        "bind_database_names": join.format(kept=f"'{ORDERS}'"),
        "bind_file_names": join.format(kept="'as written'"),
        "bind_plain_names": PLAIN.format(orders="orders", customer="customer", low="50000").replace("AS orders", "AS low", 1),
        "bind_isolation": "SELECT 'orders' AS tag, o_orderkey AS k FROM orders UNION ALL "
        "SELECT 'customer' AS tag, c_custkey AS k FROM customer",
        "dynamic_conditions": CONDITIONED.format(orders="orders", first=CONDITIONS[0], second=CONDITIONS[1]),
        "read_only_guard": GUARDED.format(orders="orders"),
        "sink_parquet": f"{orders} UNION ALL {orders}",
        "sink_csv": orders,
        "sink_json_append": f"{orders} UNION ALL {orders}",
        "sink_json_nullfill": "SELECT o_orderkey, COALESCE(NULLIF(o_orderstatus, 'F'), 'null') AS status, "
        "COALESCE(NULLIF(o_custkey, 1), -1) AS custkey FROM orders",
        "sink_repartition": "SELECT 3 + COUNT(*) // 5000000 AS files, COUNT(*) AS n FROM lineitem",
        "sink_once": tagged(spenders, "sink", ("parquet", "json")),
        "sink_fanout": tagged(spenders, "sink", ("as_parquet", "as_json", "as_csv")),
        "job_end_to_end": tagged(job, "sink", ("as_parquet", "as_json")),
        "lowercase_columns": customer,
    }
