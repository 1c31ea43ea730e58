"""Database tables through Spark's JDBC source."""

from __future__ import annotations

import math
from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from braid.spec import format_options, get

DATABASE_TYPES = ("mysql", "postgres", "mssql", "oracle", "ibmdb2")

FETCH_ROWS = 10_000


def connection_options(spec: dict, kind: str) -> dict[str, str]:
    """URL, driver, login and table as Spark's JDBC options; the same for reading and writing."""
    options = {
        "url": _url(get(spec, "jdbc-url"), kind, get(spec, "database", None)),
        "driver": get(spec, "driver"),
        "user": get(spec, "user"),
        "password": get(spec, "password"),
        "dbtable": _table(spec, kind),
    }
    if kind == "mysql":
        # Without a server-side cursor this driver loads a whole result into memory.
        options["useCursorFetch"] = "true"
    return {**options, **format_options(spec)}


def _table(spec: dict, kind: str) -> str:
    table = get(spec, "table")
    if kind == "mysql":
        return f"{get(spec, 'database')}.{table}"
    schema = get(spec, "schema", None)
    return f'"{schema}".{table}' if schema else table


def _url(url: str, kind: str, database: str | None) -> str:
    """Put the database into the URL, unless the URL names one already."""
    if database is None or kind in ("oracle", "ibmdb2"):
        return url
    if kind == "mssql":
        if "databasename=" in url.lower():
            return url
        return url + database if url.endswith("/") else f"{url.rstrip(';')};databaseName={database}"
    address, mark, settings = url.partition("?")
    host, _, path = address.partition("://")[2].partition("/")
    if not host or path:
        return url
    return f"{address.rstrip('/')}/{database}{mark}{settings}"


def read_table(spark: SparkSession, spec: dict, kind: str) -> DataFrame:
    """Scan a table in as many tasks as the input says; how large the table is does not matter.

    ``predicates`` (a list of conditions, one task each) is the way to split a table whose rows crowd around few values;
    together they have to hold for every row exactly once, rows with nulls included. ``partition-column`` with
    ``num-partitions`` splits by value range; its bounds are looked up in the database when not given, and only place the
    cuts, so no row is lost. With ``split`` set to ``depth`` the cuts are such that each task gets about as many rows, as the
    database counts them; a single value is never cut up. ``num-partitions`` of 1 alone reads the table in one task.
    """
    options = {"fetchsize": str(FETCH_ROWS), **connection_options(spec, kind)}
    predicates = get(spec, "predicates", None)
    if predicates:
        extra = {key: value for key, value in options.items() if key not in ("url", "dbtable")}
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=extra)
    column, count = get(spec, "partition-column", None), get(spec, "num-partitions", None)
    split = get(spec, "split", "range")
    if split not in ("range", "depth"):
        raise ValueError(f"unsupported split '{split}'; use range or depth")
    if split == "depth":
        if not column or count is None:
            raise ValueError("a split by depth needs 'partition-column' and 'num-partitions'")
        extra = {key: value for key, value in options.items() if key not in ("url", "dbtable")}
        ranges = depth_predicates(column, _cuts(spark, options, column, int(count)), kind)
        return spark.read.jdbc(options["url"], options["dbtable"], predicates=ranges, properties=extra)
    if column and count is not None:
        options.update(_ranges(spark, spec, options, column, str(count)))
    elif "partitionColumn" not in options and (column or str(count) != "1"):
        raise ValueError("say how to split the read: 'partition-column' with 'num-partitions', 'predicates', or 'num-partitions' of 1")
    return spark.read.format("jdbc").options(**options).load()


def _ranges(spark: SparkSession, spec: dict, options: dict, column: str, count: str) -> dict[str, str]:
    low, high = get(spec, "lower-bound", None), get(spec, "upper-bound", None)
    if low is None or high is None:
        found = _ask(spark, options, f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM {options['dbtable']}")
        low, high = (found[0] if low is None else low), (found[1] if high is None else high)
    if low is None or high is None:
        return {}
    # Spark takes whole numbers as bounds of a numeric column.
    low = math.floor(low) if isinstance(low, (Decimal, float)) else low
    high = math.ceil(high) if isinstance(high, (Decimal, float)) else high
    return {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": count}


def _cuts(spark: SparkSession, options: dict, column: str, count: int) -> list:
    """The least value of each of ``count`` parts of equal size, worked out by the database, in its own order of values."""
    parts = f"SELECT {column} AS cut, NTILE({count}) OVER (ORDER BY {column}) AS part FROM {options['dbtable']} WHERE {column} IS NOT NULL"
    plain = {key: value for key, value in options.items() if key != "dbtable"}
    question = f"SELECT part, MIN(cut) AS cut FROM ({parts}) parts GROUP BY part"
    found = spark.read.format("jdbc").options(**plain, query=question).load().collect()
    return [row[1] for row in sorted(found, key=lambda row: row[0])]


def depth_predicates(column: str, cuts: list, kind: str) -> list[str]:
    """One condition per part, of which each row meets exactly one: rows below the second cut and rows with a null in the first,
    then from each cut up to the next. Equal cuts, of a value that fills whole parts, are one."""
    # What is no finite number has no spelling that all databases share; its rows join the part before.
    cuts = [cut for cut in cuts if not isinstance(cut, float) or math.isfinite(cut)]
    spelled = list(dict.fromkeys(_literal(cut, kind) for cut in cuts[1:] if cut != cuts[0]))
    if not spelled:
        return ["1 = 1"]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(spelled, spelled[1:])]
    return [f"{column} < {spelled[0]} OR {column} IS NULL", *middle, f"{column} >= {spelled[-1]}"]


def _literal(value, kind: str) -> str:
    if isinstance(value, (bool, bytes, bytearray)):
        raise ValueError("a read is not split by truth values or bytes")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    word = "" if kind == "mssql" else "TIMESTAMP " if isinstance(value, datetime) else "DATE " if isinstance(value, date) else ""
    text = value.isoformat(sep=" ") if isinstance(value, datetime) else str(value)
    if kind == "mysql":
        text = text.replace("\\", "\\\\")
    return f"{word}'" + text.replace("'", "''") + "'"


def _ask(spark: SparkSession, options: dict, question: str):
    """One summary row, worked out by the database."""
    plain = {key: value for key, value in options.items() if key != "dbtable"}
    return spark.read.format("jdbc").options(**plain, query=question).load().first()
