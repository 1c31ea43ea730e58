"""Write a result to files and databases."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, DataFrameWriter
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.shared import written
from braid.sources.files import CSV_KEYS, file_path, file_type, s3_options
from braid.sources.jdbc import connection_options
from braid.spec import flag, format_options, get, numbered, store_type

FILE_SINKS = ("files", "hdfs", "local", "s3")
DATABASE_SINKS = ("mysql", "postgres", "jdbc")
BATCH_ROWS = 10_000


def write_outputs(df: DataFrame, outputs: list[dict]) -> DataFrame:
    """Write one result to every output, in order, and return it.

    The query runs once: with several outputs its rows are kept in the session's shared folder, so that all outputs get the
    same rows, in the same order if the query sorts them, even when executors are lost in between. ``braid.shared.discard``
    removes what is kept.
    The outputs are not one transaction; those written before a failure stay.
    """
    if not outputs:
        raise ValueError("at least one output is needed")
    for number, output in enumerate(outputs, start=1):
        with numbered("output", number):
            check_output(output)
    kept = df if len(outputs) == 1 else _kept(df)
    for output in outputs:
        write_output(kept, output)
    return kept


def _kept(df: DataFrame) -> DataFrame:
    """The rows, written once; with a sorted result, the sorted order as well."""
    if df._jdf.queryExecution().optimizedPlan().outputOrdering().isEmpty():
        return written(df, "result")
    place = f"_place_{uuid.uuid4().hex}"
    return written(df.withColumn(place, F.monotonically_increasing_id()), "result").orderBy(place).drop(place)


def write_output(df: DataFrame, output: dict) -> None:
    kind = check_output(output)
    if flag(output, "lowercase-columns"):
        df = lowercase_columns(df)
    if flag(output, "null-fill"):
        df = df.na.fill("null")
    files = get(output, "output-partitions-count", None)
    if files is not None:
        df = df.repartition(int(files))
    writer = df.write.mode(mode_of(output))
    if kind in FILE_SINKS:
        _file_writer(writer, output).save(file_path(output))
    else:
        writer.format("jdbc").options(**database_options(output, kind)).save()


def check_output(output: dict) -> str:
    """The kind of store, after a look at all that can be wrong with an output before anything is written."""
    kind = store_type(output, "datasink")
    if kind in FILE_SINKS:
        file_type(output)
        file_path(output)
    elif kind in DATABASE_SINKS:
        database_options(output, kind)
    else:
        raise ValueError(f"unsupported output type '{kind}'")
    mode_of(output)
    return kind


def mode_of(output: dict) -> str:
    """``mode``, or the yes/no key ``append``; with neither, an existing target is an error."""
    chosen = get(output, "mode", None)
    if chosen is None and get(output, "append", None) is not None:
        chosen = "append" if flag(output, "append") else "overwrite"
    if chosen not in (None, "error", "append", "overwrite"):
        raise ValueError(f"unsupported mode '{chosen}'; use error, append or overwrite")
    return chosen or "error"


def _file_writer(writer: DataFrameWriter, output: dict) -> DataFrameWriter:
    kind = file_type(output)
    options = format_options(output, CSV_KEYS if kind == "csv" else ())
    if kind == "csv":
        # Spark's CSV writer would trim text.
        options = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", **options}
    codec = get(output, "codec", None)
    if codec:
        options.setdefault("compression", codec)
    return writer.format(kind).options(**{**s3_options(output), **options})


def database_options(output: dict, kind: str) -> dict[str, str]:
    """JDBC writer options: a known database, or ``jdbc`` with its ``url`` and ``table`` as they are."""
    if kind == "jdbc":
        options = {key: get(output, key) for key in ("url", "driver", "user", "password")}
        options["dbtable"] = get(output, "table")
        options.update(format_options(output))
    else:
        options = connection_options(output, kind)
    options.setdefault("batchsize", str(BATCH_ROWS))
    types = get(output, "column-types", None)
    if types:
        options["createTableColumnTypes"] = types
    return options


def lowercase_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[column.lower() for column in df.columns])


def column_types(schema: T.StructType, text_length: int) -> str:
    """Text for an output's ``column-types`` where a database needs text of a bounded length, as for keys. Without it Spark
    takes the database's own types: text of any length, double precision, whole numbers as they are."""
    return ", ".join(f"`{field.name}` VARCHAR({text_length})" for field in schema if isinstance(field.dataType, T.StringType))
