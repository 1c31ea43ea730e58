"""Inputs as DataFrames: one reader per kind of store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from braid.operators.bind import input_name
from braid.sources.files import read_files
from braid.sources.jdbc import DATABASE_TYPES, read_table
from braid.spec import format_options, get, numbered, store_type

FILE_TYPES = ("files", "hdfs", "local", "s3")


def read_source(spark: SparkSession, spec: dict) -> DataFrame:
    """The table that an input describes, as a lazy DataFrame."""
    kind = store_type(spec, "datasource")
    if kind in FILE_TYPES:
        return read_files(spark, spec)
    if kind in DATABASE_TYPES:
        return read_table(spark, spec, kind)
    if kind == "hive":
        return spark.table(f"{get(spec, 'database')}.{get(spec, 'table')}")
    if kind == "mongo":
        return spark.read.format(get(spec, "driver", "mongodb")).options(**mongo_options(spec)).load()
    raise ValueError(f"unsupported input type '{kind}'")


def mongo_options(spec: dict) -> dict[str, str]:
    """The collection's address; the database and the collection may also stand in the URI."""
    options = {"connection.uri": get(spec, "uri")}
    options.update({key: spec[key] for key in ("database", "collection") if key in spec})
    return {**options, **format_options(spec)}


def load_inputs(spark: SparkSession, inputs: list[dict]) -> dict[str, DataFrame]:
    """Every input under the name that the query uses for it."""
    frames: dict[str, DataFrame] = {}
    for number, spec in enumerate(inputs, start=1):
        with numbered("input", number):
            name = input_name(spec)
            if name in frames:
                raise ValueError(f"two inputs are named '{name}'")
            frames[name] = read_source(spark, spec)
    return frames
