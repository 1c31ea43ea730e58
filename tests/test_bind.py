"""Names, placeholders and the read-only rule."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.errors import AnalysisException

from braid import load_inputs, run_query
from braid.operators.bind import bind_names, fill_conditions, input_name, view_name

V = {"A.b.t": "v1", "A.b.t_more": "v2", "A.b.t.x": "v3"}


@pytest.mark.parametrize(
    "sql, bound",
    [
        ("SELECT * FROM A.b.t", "SELECT * FROM v1"),
        ("SELECT A.b.t.c FROM A.b.t,A.b.t_more", "SELECT v1.c FROM v1,v2"),
        ("SELECT * FROM A.b.t.x JOIN A.b.t", "SELECT * FROM v3 JOIN v1"),
        ("SELECT 'A.b.t', \"A.b.t\", `A.b.t` FROM(A.b.t)", "SELECT 'A.b.t', \"A.b.t\", `A.b.t` FROM(v1)"),
        ("SELECT 'it''s A.b.t', 'it\\'s A.b.t' FROM A.b.t", "SELECT 'it''s A.b.t', 'it\\'s A.b.t' FROM v1"),
        ("SELECT r'\\' AS s FROM A.b.t", "SELECT r'\\' AS s FROM v1"),
        ("SELECT 1 -- A.b.t's\nFROM A.b.t", "SELECT 1 -- A.b.t's\nFROM v1"),
        ("SELECT /* A.b.t' */ 1 FROM A.b.t", "SELECT /* A.b.t' */ 1 FROM v1"),
        ("SELECT /*+ BROADCAST(A.b.t) */ 1 FROM A.b.t", "SELECT /*+ BROADCAST(v1) */ 1 FROM v1"),
        ("SELECT * FROM AxbXt, ZA.b.t, A.b.t2, Z.A.b.t", "SELECT * FROM AxbXt, ZA.b.t, A.b.t2, Z.A.b.t"),
        ("SELECT ';' FROM A.b.t; -- done; A.b.t", "SELECT ';' FROM v1 -- done; A.b.t"),
        ("SELECT 1; SELECT 2", "SELECT 1; SELECT 2"),
        ("SELECT /* /* x */ it's */ id, 'a' FROM A.b.t WHERE 'z'='z'", "SELECT /* /* x */ it's */ id, 'a' FROM v1 WHERE 'z'='z'"),
        ("SELECT /* /* A.b.t */ A.b.t */ 1 FROM A.b.t /* open", "SELECT /* /* A.b.t */ A.b.t */ 1 FROM v1 /* open"),
        ("SELECT ';';", "SELECT ';'"),
    ],
)
def test_bind_names(sql, bound):
    assert bind_names(sql, V) == bound


def test_no_names_leaves_the_text():
    assert bind_names("SELECT 1", {}) == "SELECT 1"


@pytest.mark.parametrize(
    "spec, name",
    [
        ({"datasource": "DB", "database": "d", "table": "t"}, "DB.d.t"),
        ({"datasource": "DB", "database": "d", "schema": "s", "table": "t"}, "DB.d.s.t"),
        ({"datasource": "DB", "database": "d", "table": "t", "schema": [{"name": "c"}]}, "DB.d.t"),
        ({"datasource": "S3", "file-path": "s3a://bucket/a-b/t.csv"}, "S3.bucket.a-b.t.csv"),
        ({"datasource": "S3", "file-path": "s3://bucket/t"}, "S3.bucket.t"),
        ({"datasource": "FILES", "file-path": "file:///data/t.parquet"}, "FILES.data.t.parquet"),
        ({"datasource": "FILES", "file-path": "/data/t/"}, "FILES.data.t"),
        ({"datasource": "FILES", "file-path": "file:/data/t"}, "FILES.data.t"),
        ({"datasource": "HDFS", "file-path": "hdfs:///data/t.json"}, "HDFS.data.t.json"),
        ({"datasource": "HDFS", "file-path": "hdfs://node:8020/t"}, "HDFSnode:8020.t"),
        ({"datasource": "FILES", "file-path": "/x", "name": "mine"}, "mine"),
    ],
)
def test_input_name(spec, name):
    assert input_name(spec) == name


@pytest.mark.parametrize("spec", [{}, {"datasource": "DB"}, {"datasource": "LAKE", "file-path": "/data/t"}])
def test_an_input_needs_a_name(spec):
    with pytest.raises(ValueError):
        input_name(spec)


def test_view_names_are_plain_and_differ():
    first, second = view_name("HDFSnode:8020.a-b"), view_name("HDFSnode:8020.a-b")
    assert first != second
    assert first.startswith("v_HDFSnode_8020_a_b_")


def test_names_with_odd_characters_run(spark):
    frames = {"HDFSnode:8020.a-b.t": spark.range(3)}
    assert run_query(spark, frames, "SELECT id FROM HDFSnode:8020.a-b.t").count() == 3


def test_two_inputs_may_not_share_a_name(spark, sf_dir):
    spec = {"name": "t", "datasource": "FILES", "file-type": "parquet", "file-path": f"{sf_dir}/nation.parquet"}
    with pytest.raises(ValueError, match="input 2: two inputs"):
        load_inputs(spark, [spec, spec])


def test_conditions_are_inserted_as_they_are():
    sql = "SELECT * FROM t WHERE $COND{1} AND $COND{2} OR $COND{1} -- $COND{9}"
    filled = fill_conditions(sql, ["a = '$1'", r"b RLIKE '\\d'"])
    assert filled == r"SELECT * FROM t WHERE a = '$1' AND b RLIKE '\\d' OR a = '$1' -- $COND{9}"


def test_conditions_inside_literals_are_filled():
    sql = "SELECT '-- $COND{1}', 'it''s' /* '$COND{2}' */ FROM t WHERE a = '$COND{1}'"
    assert fill_conditions(sql, ["x"]) == "SELECT '-- x', 'it''s' /* '$COND{2}' */ FROM t WHERE a = 'x'"


@pytest.mark.parametrize("sql, conditions", [("$COND{1}", []), ("$COND{0}", ["x"]), ("$COND{1}", ["x", "y"]), ("1", ["x"])])
def test_conditions_and_placeholders_must_match(sql, conditions):
    with pytest.raises(ValueError):
        fill_conditions(sql, conditions)


def test_names_inside_conditions_are_bound(spark):
    frames = {"A.b.t": spark.range(10), "A.b.u": spark.range(3)}
    found = run_query(spark, frames, "SELECT id FROM A.b.t WHERE $COND{1}", conditions=["id IN (SELECT id FROM A.b.u)"])
    assert sorted(row.id for row in found.collect()) == [0, 1, 2]


def test_parameters_are_values(spark):
    sql = "SELECT id FROM t WHERE id > :low"
    assert run_query(spark, {"t": spark.range(10)}, sql, params={"low": 6}).count() == 3


WRITES = [
    "DROP TABLE t", "CREATE TABLE z (i INT)", "CREATE OR REPLACE TEMP VIEW z AS SELECT 1", "DELETE FROM t",
    "UPDATE t SET id = 1", "MERGE INTO t USING u ON t.id = u.id WHEN MATCHED THEN DELETE", "TRUNCATE TABLE t",
    "ALTER TABLE t RENAME TO z", "INSERT INTO t SELECT 1", "WITH a AS (SELECT 1) INSERT INTO t SELECT * FROM a",
    "FROM t INSERT INTO z SELECT id", "FROM t INSERT INTO y SELECT id INSERT INTO z SELECT id", "SET x = 1",
    "CACHE TABLE t", "REFRESH TABLE t", "SELECT 1; DROP TABLE t", "SELECT 1) UNION ALL (SELECT 2); DROP TABLE (t",
    "SELECT 1) INSERT INTO t (SELECT 2", "/* SELECT */ DROP TABLE t", "BEGIN DROP TABLE t; END", "SHOW TABLES",
]


@pytest.mark.parametrize("sql", WRITES)
def test_writes_and_commands_are_refused(spark, sql):
    with pytest.raises(ValueError, match="read-only"):
        run_query(spark, {"t": spark.range(1), "u": spark.range(1)}, sql)


READS = [
    "SELECT id AS created_at, 'dropped' AS deleted FROM t", "FROM t SELECT id", "TABLE t", "VALUES (1), (2)",
    "WITH a AS (SELECT id FROM t) SELECT * FROM a ORDER BY id DESC LIMIT 1", "SELECT id FROM t;",
    "SELECT id FROM t -- drop table t", "/* delete */ SELECT id FROM t;  -- end;\n", "(SELECT id FROM t) UNION (SELECT 1)",
]


@pytest.mark.parametrize("sql", READS)
def test_reads_pass(spark, sql):
    assert run_query(spark, {"t": spark.range(3)}, sql).count() > 0


def test_order_and_repeated_columns_survive(spark):
    found = run_query(spark, {"t": spark.range(100)}, "SELECT id, id FROM t ORDER BY id DESC")
    assert found.columns == ["id", "id"]
    assert [row[0] for row in found.collect()] == list(range(99, -1, -1))


def test_an_empty_query_is_an_error(spark):
    with pytest.raises(ValueError):
        run_query(spark, {}, "  ")


def test_views_do_not_stay_in_the_session(spark):
    before = {table.name for table in spark.catalog.listTables()}
    result = run_query(spark, {"A.b.t": spark.range(3)}, "SELECT * FROM A.b.t")
    assert {table.name for table in spark.catalog.listTables()} == before
    assert result.count() == 3


def test_cross_and_theta_joins_go_to_spark(spark):
    frames = {"A.b.t": spark.range(3), "A.b.u": spark.range(4)}
    assert run_query(spark, frames, "SELECT * FROM A.b.t CROSS JOIN A.b.u").count() == 12
    assert run_query(spark, frames, "SELECT * FROM A.b.t x JOIN A.b.u y ON x.id < y.id").count() == 6


# Pieces of SQL text with what becomes of them when A.b.t is bound to v1.
LEFT_ALONE = ["'A.b.t'", "'A.b.t '' -- x'", "'\\' A.b.t'", '"A.b.t /*"', "`A.b.t`", "-- A.b.t '\n", "/* A.b.t \" */", "r'\\'"]
PIECES = [(piece, piece) for piece in LEFT_ALONE] + [("A.b.t", "v1"), ("A.b.t.c", "v1.c"), ("x.A.b.t", "x.A.b.t"), ("1", "1")]


@given(st.lists(st.sampled_from(PIECES), max_size=12))
def test_any_mix_of_pieces(pieces):
    before, after = (" ".join(piece[side] for piece in pieces) for side in (0, 1))
    assert bind_names(before, V) == after


def test_files_whose_names_share_a_beginning(spark, sf_dir, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    spark.range(4).write.parquet(str(tmp_path / "t.more"))
    inputs = [{"datasource": "FILES", "file-type": "parquet", "file-path": f"file://{tmp_path}/{n}"} for n in ("t", "t.more")]
    frames = load_inputs(spark, inputs)
    first, second = frames
    sql = f"SELECT (SELECT COUNT(*) FROM {first}) AS a, (SELECT COUNT(*) FROM {second}) AS b"
    assert tuple(run_query(spark, frames, sql).first()) == (3, 4)


def test_a_query_sees_no_other_runs_inputs(spark):
    run_query(spark, {"A.b.t": spark.range(1)}, "SELECT * FROM A.b.t")
    with pytest.raises(AnalysisException):
        run_query(spark, {}, "SELECT * FROM A.b.t")


def test_plain_names_are_names_of_the_query_and_nothing_else(spark):
    t = {"t": spark.range(3), "id": spark.range(4)}
    assert run_query(spark, t, "SELECT id AS t FROM t").columns == ["t"]
    assert run_query(spark, t, "SELECT id FROM id").count() == 4
    assert run_query(spark, t, "SELECT id FROM id WHERE id > :id", params={"id": 1}).count() == 2
    assert run_query(spark, t, "WITH t AS (SELECT 9 AS id) SELECT id FROM t").collect()[0].id == 9
    assert run_query(spark, t, "SELECT /*+ BROADCAST(t) */ t.id FROM t JOIN id ON t.id = id.id;").count() == 3
    assert run_query(spark, {**t, "A.b.t": spark.range(7)}, "SELECT COUNT(*) AS n FROM A.b.t, t").collect()[0].n == 21


@pytest.mark.parametrize(
    "sql",
    ["INSERT INTO t SELECT 1", "DROP TABLE t", "SELECT 1) INSERT INTO t (SELECT 2", "SELECT 1; DROP TABLE t", "CREATE TABLE x AS SELECT 1 FROM t"],
)
def test_writes_are_refused_with_plain_names(spark, sql):
    with pytest.raises(ValueError, match="read-only"):
        run_query(spark, {"t": spark.range(3)}, sql)


COMMANDS = [
    "SELECT TRANSFORM(id) USING 'cat' AS (y) FROM t", "SELECT reflect('java.lang.System', 'currentTimeMillis') AS x FROM t",
    "SELECT java_method('java.lang.System', 'setProperty', 'a', 'b') AS x", "SELECT try_reflect('java.lang.System', 'nanoTime') AS x FROM t",
]


@pytest.mark.parametrize("command", COMMANDS)
@pytest.mark.parametrize(
    "around",
    ["{}", "WITH c AS ({}) SELECT * FROM c", "SELECT * FROM ({}) x WHERE 1 = 1", "SELECT id FROM t WHERE EXISTS ({})", "SELECT 1 AS a UNION ALL SELECT 2 FROM ({}) y"],
)
def test_scripts_and_java_methods_are_refused(spark, command, around):
    with pytest.raises(ValueError, match="read-only"):
        run_query(spark, {"t": spark.range(3)}, around.format(command))


def test_java_methods_in_a_condition_are_refused(spark):
    with pytest.raises(ValueError, match="read-only"):
        run_query(spark, {"t": spark.range(3)}, "SELECT id FROM t WHERE $COND{1}", conditions=["java_method('java.lang.System', 'nanoTime') <> '0'"])


def test_text_that_looks_like_a_method_call_is_no_call(spark):
    sql = "SELECT 'reflect(x)' AS a, `java_method(b)` FROM (SELECT id AS `java_method(b)` FROM t)"
    assert run_query(spark, {"t": spark.range(3)}, sql).count() == 3
