"""Parquet, CSV and JSON files, in any store that Spark has a path scheme for."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from braid.sources.schema import to_struct
from braid.spec import flag, format_options, get

CSV_KEYS = ("header", "delimiter", "quote", "escape", "nullValue", "dateFormat")
_READER_KEYS = {"parquet": (), "csv": CSV_KEYS, "json": ()}


def file_type(spec: dict) -> str:
    kind = get(spec, "file-type").lower()
    if kind not in _READER_KEYS:
        raise ValueError(f"unsupported file-type '{kind}'; use parquet, csv or json")
    return kind


def read_files(spark: SparkSession, spec: dict) -> DataFrame:
    """Scan files: Parquet carries its schema, CSV and JSON have it declared or inferred.

    CSV with neither a schema nor ``inferSchema`` gives text columns. Inference reads the whole
    input once more, so large inputs are better declared.
    """
    kind = file_type(spec)
    reader = spark.read.format(kind).options(**{**s3_options(spec), **format_options(spec, _READER_KEYS[kind])})
    if kind != "parquet":
        infer = flag(spec, "inferSchema")
        declared = get(spec, "schema", None)
        if not infer and isinstance(declared, list):
            reader = reader.schema(to_struct(declared))
        elif not infer and kind == "json":
            raise ValueError("a json input needs a 'schema' or inferSchema=true")
        elif kind == "csv":
            reader = reader.option("inferSchema", str(infer).lower())
    return reader.load(file_path(spec))


def file_path(spec: dict) -> str:
    """The path as Spark opens it: the older S3 schemes become ``s3a``."""
    return re.sub(r"^s3n?://", "s3a://", get(spec, "file-path"))


def s3_options(spec: dict) -> dict[str, str]:
    """Access keys as options of this one reader or writer, for this bucket alone.

    They never touch the session's Hadoop settings, so two buckets with different keys can meet in
    one query.
    """
    bucket = re.match(r"s3a://([^/]+)", file_path(spec))
    access = get(spec, "fs.s3.awsAccessKeyId", None)
    if bucket is None or access is None:
        return {}
    prefix = f"fs.s3a.bucket.{bucket.group(1)}"
    return {f"{prefix}.access.key": access, f"{prefix}.secret.key": get(spec, "password")}
