"""The driver's tables as inputs of different kinds, under the names that the queries use."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from braid import load_inputs, run_query, write_output
from braid.shared import fresh_path

CSV = {"header": "true", "delimiter": ",", "quote": '"', "escape": '"'}

# Declared names of the column types that occur in the tables.
_DECLARED = {"bigint": "long", "int": "int", "double": "double", "string": "string", "timestamp_ntz": "timestamp_ntz"}

_copies: dict[tuple, str] = {}


def declared(schema: T.StructType) -> list[dict]:
    return [
        {"name": field.name, "datatype": _DECLARED[field.dataType.simpleString()], "nullable": True}
        for field in schema
    ]


@functools.cache
def declared_table(spark: SparkSession, sf_dir: str, name: str) -> list[dict]:
    return declared(table(spark, sf_dir, name).schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def copy_of(spark: SparkSession, sf_dir: str, name: str, kind: str) -> str:
    """Path of the table written out as ``kind``; written once per session."""
    key = (spark.sparkContext.applicationId, sf_dir, name, kind)
    if key not in _copies:
        output = {"datasink": "COPY", "config": {"type": "local"}, "file-type": kind}
        output["file-path"] = fresh_path(spark, f"{name}_{kind}")
        write_output(table(spark, sf_dir, name), {**output, **(CSV if kind == "csv" else {})})
        _copies[key] = output["file-path"]
    return _copies[key]


def parquet(spark: SparkSession, sf_dir: str, name: str, /, **where: str) -> dict:
    path = f"{sf_dir}/{name}.parquet"
    return {**where, "config": {"type": "local"}, "file-type": "parquet", "file-path": path}


def copied(spark: SparkSession, sf_dir: str, name: str, kind: str, /, infer: bool = False, **where: str) -> dict:
    """A CSV or JSON copy of the table, with its schema declared or inferred."""
    spec = {**where, "config": {"type": "local"}, "file-type": kind, **(CSV if kind == "csv" else {})}
    spec["file-path"] = copy_of(spark, sf_dir, name, kind)
    spec["inferSchema"] = str(infer).lower()
    if not infer:
        spec["schema"] = declared_table(spark, sf_dir, name)
    return spec


# Name in the queries -> table and format. One query over several of these crosses stores.
_INPUTS = {
    "SALES.tpch.lineitem": "parquet",
    "SALES.tpch.orders": "parquet",
    "SALES.tpch.part": "parquet",
    "WEB.tpch.events": "parquet",
    "CRM.tpch.customer": "csv",
    "CRM.tpch.supplier": "json",
    "GEO.tpch.nation": "json",
    "GEO.tpch.region": "csv",
}


def input_for(spark: SparkSession, sf_dir: str, name: str) -> dict:
    source, database, last = name.split(".")
    where = {"datasource": source, "database": database, "table": last}
    kind = _INPUTS[name]
    if kind == "parquet":
        return parquet(spark, sf_dir, last, **where)
    return copied(spark, sf_dir, last, kind, **where)


def inputs_for(spark: SparkSession, sf_dir: str, sql: str) -> list[dict]:
    """Inputs for the names that occur in the query."""
    return [input_for(spark, sf_dir, name) for name in _INPUTS if name in sql]


@functools.cache
def loaded(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input, opened once per session and used by many queries."""
    return load_inputs(spark, [input_for(spark, sf_dir, name)])[name]


def ask(spark: SparkSession, sf_dir: str, sql: str, frames: dict[str, DataFrame] | None = None, **how) -> DataFrame:
    """Run a query over the inputs it names, and over ``frames``."""
    named = {name: loaded(spark, sf_dir, name) for name in _INPUTS if name in sql}
    return run_query(spark, {**named, **(frames or {})}, sql, **how)
