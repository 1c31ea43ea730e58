"""Records that break a declared schema: who they are, why, and that none is lost."""

import json

import pytest

from braid import read_checked, run_job
from braid.sources import jdbc

FIELDS = [("k", "long", False), ("d", "date", True), ("x", "decimal(5,2)", True), ("s", "string", True)]
SCHEMA = [{"name": n, "datatype": t, "nullable": ok} for n, t, ok in FIELDS]


def spec(path, kind, **more):
    return {"datasource": "IN", "name": "T", "config": {"type": "local"}, "file-type": kind, "file-path": str(path), "schema": SCHEMA, **more}


def test_csv(spark, tmp_path):
    lines = ["k;d;x;s", "1;2020-01-02;3.50;a b", "2;;;", "x3;2020-13-01;1;t", "4;2020-01-02;1", "5;2020-01-02;1;t;more", ";2020-01-02;1;'q;r'", "", "7;NA;12345.6;t"]
    (tmp_path / "t.csv").write_text("\n".join(lines))
    given = spec(tmp_path / "t.csv", "csv", header="true", delimiter=";", quote="'", nullValue="NA", dateFormat="yyyy-MM-dd")
    good, rejects = read_checked(spark, given)
    assert good.columns == ["k", "d", "x", "s"] and sorted(r.k for r in good.collect()) == [1, 2]
    found = {r.record: r.reason for r in rejects.collect()}
    assert found.pop("x3;2020-13-01;1;t") == "k: x3; d: 2020-13-01" and found.pop("7;NA;12345.6;t") == "x: 12345.6"
    assert found.pop("4;2020-01-02;1") == found.pop("5;2020-01-02;1;t;more") == "cells missing or too many"
    [(record, reason)] = found.items()
    assert reason == "k is null" and json.loads(record)["s"] == "q;r"
    assert {r.file.rpartition("/")[2] for r in rejects.collect()} == {"t.csv"}


def test_json(spark, tmp_path):
    lines = ['{"k":1,"d":"2020-01-02","x":3.5,"s":"a"}', '{"k":"one"}', '{"k":2', '{"s":"t"}', '{"k":3,"more":1}', '[1]']
    (tmp_path / "t.json").write_text("\n".join(lines))
    good, rejects = read_checked(spark, spec(tmp_path / "t.json", "json"))
    assert sorted(r.k for r in good.collect()) == [1, 3]
    assert sorted((r.record, r.reason) for r in rejects.collect()) == sorted(
        [('{"k":"one"}', "k: one"), ('{"k":2', "not readable"), ("[1]", "not readable"), ('{"s":"t"}', "k is null")]
    )


def test_columns_with_the_names_of_ours(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,2,3\nx,2,3\n")
    schema = [{"name": n, "datatype": "int", "nullable": True} for n in ("_record", "_reason", "_file")]
    good, rejects = read_checked(spark, {**spec(tmp_path / "t.csv", "csv"), "schema": schema})
    assert [tuple(r) for r in good.collect()] == [(1, 2, 3)] and [r.reason for r in rejects.collect()] == ["_record: x"]
    (tmp_path / "none").mkdir()
    good, rejects = read_checked(spark, spec(tmp_path / "none", "csv"))
    assert good.isEmpty() and rejects.isEmpty()


def test_a_job_writes_rejects(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1,2020-01-02,1,a\nx,2020-01-02,1,b\n")
    out = lambda name: {"datasink": "OUT", "config": {"type": "local"}, "file-type": "parquet", "file-path": str(tmp_path / name)}
    given = spec(tmp_path / "t.csv", "csv", rejects=out("rejects"))
    assert [r.k for r in run_job(spark, {"sql": "SELECT k FROM T", "inputs": [given], "outputs": [out("rows")]}).collect()] == [1]
    assert [r.reason for r in spark.read.parquet(str(tmp_path / "rejects")).collect()] == ["k: x"]


def test_what_cannot_be_checked(spark, tmp_path):
    for wrong in ({"file-type": "parquet"}, {"schema": None}, {"options": {"mode": "FAILFAST"}}):
        with pytest.raises(ValueError, match="rejects need"):
            read_checked(spark, {**spec(tmp_path, "csv"), **wrong})


VALUES = {
    "bigint": [1, 1, 1, 1, 1, 1, 2, 3, 4, 5, 900, None, None],
    "varchar": ["a", "o'k", "o'k", "z", "", "é", None],
    "date": ["2020-01-01", "2020-01-02", "2021-05-05", None],
    "timestamp": ["2020-01-01 00:00:00", "2020-01-02 10:00:00.5", None],
    "double": [1.5, -2.0, 1e300, float("nan"), float("inf"), None],
    "integer": [None, None],
}


@pytest.mark.parametrize("kind", VALUES)
@pytest.mark.parametrize("parts", [1, 3, 8])
def test_each_row_meets_one_condition(kind, parts):
    import duckdb

    connection = duckdb.connect()
    connection.execute(f"CREATE TABLE t (k {kind})")
    connection.executemany("INSERT INTO t VALUES (?)", [(v,) for v in VALUES[kind]])
    cuts = connection.execute(f"SELECT MIN(k) FROM (SELECT k, NTILE({parts}) OVER (ORDER BY k) AS part FROM t WHERE k IS NOT NULL) GROUP BY part ORDER BY part").fetchall()
    conditions = jdbc.depth_predicates("k", [c for (c,) in cuts], "postgres")
    assert len(conditions) <= parts
    met = " + ".join(f"CAST(COALESCE(({c}), false) AS INT)" for c in conditions)
    assert connection.execute(f"SELECT COUNT(*) FROM t WHERE {met} = 1").fetchone() == (len(VALUES[kind]),)


def test_parts_of_a_skewed_column_are_even():
    """One value has a third of the rows; the rest crowd at one end of a wide range."""
    values = [5] * 3000 + [10**6 + i % 4000 for i in range(6000)]
    cuts = [sorted(values)[len(values) * i // 9] for i in range(9)]
    conditions = jdbc.depth_predicates("k", cuts, "mysql")
    import duckdb

    sizes = [duckdb.sql(f"SELECT COUNT(*) FROM (SELECT UNNEST({values}) AS k) WHERE {c}").fetchall()[0][0] for c in conditions]
    assert sum(sizes) == 9000 and sorted(sizes)[-1] == 3000 and sorted(sizes)[-2] <= 1010


def test_how_values_are_spelled():
    from datetime import date, datetime

    assert jdbc.depth_predicates("k", [date(2020, 1, 1), date(2020, 1, 2)], "oracle")[1] == "k >= DATE '2020-01-02'"
    assert jdbc.depth_predicates("k", [datetime(2020, 1, 1), datetime(2020, 1, 2)], "mssql")[1] == "k >= '2020-01-02 00:00:00'"
    assert jdbc.depth_predicates("k", ["a", "b\\'c"], "mysql")[1] == "k >= 'b\\\\''c'"
    with pytest.raises(ValueError, match="truth"):
        jdbc.depth_predicates("k", [False, True], "mysql")
