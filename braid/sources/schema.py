"""Declared schema (``[{name, datatype, nullable}]``) to a Spark ``StructType``."""

from __future__ import annotations

import re

from pyspark.errors import ParseException
from pyspark.sql import types as T

# Declared names that Spark's own DDL type syntax lacks or reads differently.
# varchar and char are plain strings to a file reader, with or without a length.
_OWN_NAMES = {"byte[]": T.BinaryType(), "varchar": T.StringType(), "char": T.StringType()}


def to_type(datatype: str) -> T.DataType:
    """``int``, ``decimal(12,2)``, ``byte[]``, ``array<string>``, ... as a Spark type."""
    name = datatype.strip().lower()
    own = _OWN_NAMES.get(re.sub(r"^(varchar|char)\s*\(\s*\d+\s*\)$", r"\1", name))
    if own is not None:
        return own
    try:
        return T.DataType.fromDDL(datatype.strip())
    except ParseException as error:
        raise ValueError(f"unsupported datatype '{datatype}'") from error


def to_struct(fields: list[dict]) -> T.StructType:
    schema = T.StructType()
    for number, field in enumerate(fields, start=1):
        missing = [key for key in ("name", "datatype", "nullable") if key not in field]
        if missing:
            raise ValueError(f"schema field {number} lacks {', '.join(missing)}")
        schema.add(field["name"], to_type(field["datatype"]), field["nullable"])
    return schema
