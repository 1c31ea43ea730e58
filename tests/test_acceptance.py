"""Every registered query against DuckDB: same columns, types and rows."""

import duckdb
import pytest

import __spark_entry__ as contract
from acceptance import checked, connectors, counts, joins, relational, windows

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SPARK_TYPES = {
    "BIGINT": "bigint", "HUGEINT": "bigint", "INTEGER": "int", "SMALLINT": "smallint", "TINYINT": "tinyint",
    "DOUBLE": "double", "FLOAT": "float", "VARCHAR": "string", "BOOLEAN": "boolean", "DATE": "date",
    "TIMESTAMP": "timestamp_ntz", "TIMESTAMP_NS": "timestamp_ntz", "DECIMAL(12,2)": "decimal(12,2)",
}


def oracle(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def in_order(rows):
    return sorted(rows, key=lambda row: tuple((value is not None, str(value)) for value in row))


def check(spark, folder, key, **more):
    expected = oracle(folder).sql(contract.oracle_sql()[key])
    found = contract.queries()[key](spark, folder, **more)
    columns = sorted(expected.columns)
    assert sorted(found.columns) == columns
    kinds = dict(zip(expected.columns, map(str, expected.types)))
    assert {c: found.schema[c].dataType.simpleString() for c in columns} == {c: SPARK_TYPES[kinds[c]] for c in columns}
    rows = [tuple(row) for row in found.select(*columns).collect()]
    wanted = expected.project(", ".join(columns)).fetchall()
    assert wanted and len(rows) == len(wanted)
    assert in_order(rows) == in_order(wanted)


KEYS = sorted(key for part in (checked, connectors, counts, joins, relational, windows) for key in part.queries())


@pytest.mark.parametrize("key", KEYS)
def test_same_result(spark, sf_dir, key):
    check(spark, sf_dir, key)


@pytest.mark.parametrize("key", KEYS)
def test_same_result_with_skew_and_nulls(spark, skewed_dir, key):
    check(spark, skewed_dir, key)


def test_every_query_has_its_expected_result():
    assert contract.queries().keys() >= set(KEYS)
    assert contract.oracle_sql().keys() >= set(KEYS)


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0
