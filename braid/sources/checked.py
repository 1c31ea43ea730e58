"""CSV and JSON files with a declared schema, parted into rows that keep to it and rejects with a reason."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from braid.shared import written
from braid.sources.files import CSV_KEYS, file_path, file_type, s3_options
from braid.sources.schema import to_struct
from braid.spec import format_options, get


def read_checked(spark: SparkSession, spec: dict) -> tuple[DataFrame, DataFrame]:
    """The rows that keep to the declared schema, and ``rejects``: ``file``, ``record`` (the record's own text) and ``reason``.

    A record is rejected if a cell is no value of its column's type (``name: cell``, for each such cell), if cells are
    missing or too many, if a JSON line is no object (``not readable``), or if a column declared as not nullable has no value
    (``name is null``). A plain read turns such cells into nulls. Rows and rejects together are all records; empty lines are
    none. An empty cell, or one that is ``nullValue``, is null.

    The files are scanned once: the parsed rows are kept as Parquet in the session's shared folder, from which both frames
    read. ``braid.shared.discard`` removes them.
    """
    kind = file_type(spec)
    declared = get(spec, "schema", None)
    if kind == "parquet" or not isinstance(declared, list):
        raise ValueError("rejects need a csv or json input with a declared 'schema'")
    schema = to_struct(declared)
    taken = {field.name.lower() for field in schema}
    record, file, reason = (_free(name, taken) for name in ("_record", "_file", "_reason"))
    options = format_options(spec, CSV_KEYS if kind == "csv" else ())
    if str(options.get("mode", "PERMISSIVE")).upper() != "PERMISSIVE":
        raise ValueError("rejects need the reader's mode PERMISSIVE")
    parsed = T.StructType([T.StructField(f.name, f.dataType) for f in schema] + [T.StructField(record, T.StringType())])
    reader = spark.read.format(kind).schema(parsed).options(**{**s3_options(spec), **options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": record})
    rows = reader.load(file_path(spec)).withColumn(file, F.col("_metadata.file_path"))
    kept = written(rows.withColumn(reason, _reason(schema, F.col(_name(record)), kind, options)), "checked")
    # The text of a record that is rejected for a null alone is not at hand; its values are.
    values = F.to_json(F.struct(*[F.col(_name(f.name)) for f in schema]))
    good = kept.filter(F.col(reason).isNull()).select(*[F.col(_name(f.name)) for f in schema])
    bad = kept.filter(F.col(reason).isNotNull())
    return good, bad.select(F.col(file).alias("file"), F.coalesce(F.col(record), values).alias("record"), F.col(reason).alias("reason"))


def _free(name: str, taken: set[str]) -> str:
    while name in taken:
        name += "_"
    return name


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _reason(schema: T.StructType, record: Column, kind: str, options: dict[str, str]) -> Column:
    """Null for a good row. Only rejected records are parsed again, with all cells as text."""
    plain = {key: value for key, value in options.items() if key in (*CSV_KEYS, "sep")} if kind == "csv" else {}
    plain.pop("header", None)
    texts = ", ".join(f"{_name(field.name)} STRING" for field in schema)
    cells = F.from_csv(record, texts, plain) if kind == "csv" else F.from_json(record, texts)
    faults = []
    for field in schema:
        cell = cells.getField(field.name)
        faults.append(F.when(cell.isNotNull() & F.col(_name(field.name)).isNull(), F.concat(F.lit(f"{field.name}: "), cell)))
    found = F.array_compact(F.array(*faults))
    otherwise = F.lit("cells missing or too many" if kind == "csv" else "not readable")
    broken = F.when(record.isNotNull(), F.when(F.size(found) > 0, F.array_join(found, "; ")).otherwise(otherwise))
    empty = F.array_compact(F.array(*[F.when(F.col(_name(f.name)).isNull(), F.lit(f"{f.name} is null")) for f in schema if not f.nullable]).cast("array<string>"))
    return F.coalesce(broken, F.when(F.size(empty) > 0, F.array_join(empty, "; ")))
