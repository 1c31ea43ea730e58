"""Outputs: modes, options, several targets at once."""

import json
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import functions as F

from braid import read_source, run_job, run_query, write_output, write_outputs
from braid.operators.sinks import column_types, database_options, lowercase_columns
from braid.shared import discard


def out(path, kind="parquet", **more):
    return {"datasink": "OUT", "config": {"type": "local"}, "file-type": kind, "file-path": str(path), **more}


@pytest.mark.parametrize("kind", ["parquet", "csv", "json"])
def test_modes(spark, tmp_path, kind):
    target, df = out(tmp_path / "t", kind), spark.range(5)
    read = lambda: spark.read.schema("id long").format(kind).load(target["file-path"]).count()
    write_output(df, target)
    with pytest.raises(PySparkException):
        write_output(df, target)
    write_output(df, {**target, "append": True})
    assert read() == 10
    write_output(df, {**target, "append": "false"})
    assert read() == 5
    write_output(df, {**target, "mode": "append"})
    assert read() == 10


def test_csv_options(spark, tmp_path):
    df = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, DATE'2020-01-02' AS c, 'x|y' AS d")
    target = out(
        tmp_path / "t", "csv", header="true", delimiter="|", quote="'", nullValue="NA", dateFormat="dd.MM.yyyy", codec="gzip"
    )
    write_output(df.coalesce(1), target)
    [part] = (tmp_path / "t").glob("*.csv.gz")
    assert spark.read.text(str(part)).collect()[1].value == "1|NA|02.01.2020|'x|y'"


def test_csv_keeps_whole_texts(spark, sf_dir, tmp_path):
    """Line breaks, quotes, blanks around the text, empty text and null."""
    odd = [(-1, "  a "), (-2, 'say "hi"'), (-3, ""), (-4, None), (-5, "a\nb,c"), (-6, "\t"), (-7, "#x"), (-8, "\\")]
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    df = documents.union(spark.createDataFrame(odd, documents.schema))
    target = out(tmp_path / "t", "csv", header="true", quote='"', escape='"', nullValue="(none)")
    write_output(df, target)
    fields = [{"name": n, "datatype": k, "nullable": True} for n, k in (("doc_id", "long"), ("text", "string"))]
    found = read_source(spark, {**target, "schema": fields, "options": {"multiLine": True}})
    assert found.count() == df.count()
    assert df.exceptAll(found).collect() == []


def test_nested_columns(spark, sf_dir, tmp_path):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    with pytest.raises(AnalysisException):
        write_output(df, out(tmp_path / "csv", "csv"))
    write_output(df, out(tmp_path / "json", "json"))
    fields = [
        {"name": name, "datatype": kind, "nullable": True}
        for name, kind in (("vec_id", "long"), ("embedding", "array<float>"), ("label", "int"))
    ]
    frames = {"A.b.e": read_source(spark, {**out(tmp_path / "json", "json"), "schema": fields})}
    found = run_query(spark, frames, "SELECT vec_id, embedding, label FROM A.b.e WHERE embedding[0] IS NOT NULL")
    assert df.exceptAll(found).isEmpty() and found.count() == df.count()


def lines(path):
    return [json.loads(line) for part in sorted(Path(path).glob("*.json")) for line in part.read_text().splitlines()]


def test_json_nulls(spark, tmp_path):
    df = spark.sql("SELECT CAST(NULL AS STRING) AS s, CAST(NULL AS INT) AS n, 1 AS k")
    write_output(df, out(tmp_path / "left_out", "json"))
    write_output(df, out(tmp_path / "filled", "json", **{"null-fill": "true"}))
    assert lines(tmp_path / "left_out") == [{"k": 1}]
    assert lines(tmp_path / "filled") == [{"s": "null", "k": 1}]


def test_number_of_files_is_balanced(spark, tmp_path):
    skewed = spark.range(3000).repartition(4).withColumn("k", F.lit(1)).repartition("k")
    write_output(skewed, out(tmp_path / "t", **{"output-partitions-count": "3"}))
    sizes = [row["count"] for row in spark.read.parquet(str(tmp_path / "t")).groupBy(F.input_file_name()).count().collect()]
    assert len(sizes) == 3 and sum(sizes) == 3000 and max(sizes) - min(sizes) < 10


def test_one_run_for_several_outputs(spark, tmp_path):
    """A random column shows whether the outputs come from the same run."""
    df = spark.range(1000).withColumn("x", F.rand())
    result = write_outputs(df, [out(tmp_path / "a"), out(tmp_path / "b"), out(tmp_path / "c", "json")])
    first = spark.read.parquet(str(tmp_path / "a"))
    assert first.exceptAll(spark.read.parquet(str(tmp_path / "b"))).isEmpty()
    assert first.exceptAll(result.select("id", "x")).isEmpty()
    assert first.exceptAll(spark.read.schema("id long, x double").json(str(tmp_path / "c"))).isEmpty()


def test_the_order_of_a_result_survives_several_outputs(spark, tmp_path):
    df = spark.range(10_000).withColumn("x", F.xxhash64("id")).orderBy("x")
    write_outputs(df, [out(tmp_path / "a", "json"), out(tmp_path / "b", "json")])
    for name in "ab":
        values = [line["x"] for line in lines(tmp_path / name)]
        assert len(values) == 10_000 and values == sorted(values)


def test_a_wrong_output_stops_the_job_before_any_write(spark, tmp_path):
    with pytest.raises(ValueError, match="output 2: .*mongo"):
        write_outputs(spark.range(1), [out(tmp_path / "a"), {"datasink": "M", "config": {"type": "mongo"}}])
    with pytest.raises(ValueError, match="mode"):
        write_outputs(spark.range(1), [out(tmp_path / "a"), out(tmp_path / "b", mode="ignore")])
    with pytest.raises(ValueError, match="at least one"):
        write_outputs(spark.range(1), [])
    assert not (tmp_path / "a").exists()


def test_lower_case_columns(spark, tmp_path):
    df = spark.sql("SELECT 1 AS A, 2 AS `b C`")
    assert lowercase_columns(df).columns == ["a", "b c"]
    write_output(df, out(tmp_path / "t", **{"lowercase-columns": True}))
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["a", "b c"]


CONFIG = {"type": "mysql", "jdbc-url": "jdbc:mysql://h", "driver": "com.example.Driver", "password": "pw"}
TABLE = {"datasink": "DB", "config": CONFIG, "user": "u", "database": "d", "table": "t", "append": True}


def test_database_output_options():
    options = database_options(TABLE, "mysql")
    assert (options["url"], options["dbtable"], options["batchsize"]) == ("jdbc:mysql://h/d", "d.t", "10000")
    postgres = {**TABLE, "schema": "s", "config": {**CONFIG, "jdbc-url": "jdbc:postgresql://h/"}}
    options = database_options({**postgres, "column-types": "`a` VARCHAR(9)", "options": {"batchsize": 5}}, "postgres")
    assert (options["url"], options["dbtable"]) == ("jdbc:postgresql://h/d", '"s".t')
    assert (options["createTableColumnTypes"], options["batchsize"]) == ("`a` VARCHAR(9)", "5")
    plain = {"url": "jdbc:x:y", "driver": "D", "user": "u", "password": "p", "table": "a.b"}
    assert database_options(plain, "jdbc") == {
        "url": "jdbc:x:y", "driver": "D", "user": "u", "password": "p", "dbtable": "a.b", "batchsize": "10000",
    }


def test_a_database_output_reaches_the_jdbc_sink(spark):
    with pytest.raises(Exception, match="com.example.Driver"):
        write_output(spark.range(1), TABLE)


def test_options_of_one_output_reach_its_file_system(spark):
    with pytest.raises(Exception, match="com.example.Store"):
        write_output(spark.range(1), out("s3a://lake/t", options={"fs.s3a.impl": "com.example.Store"}))


def test_column_types(spark):
    schema = spark.sql("SELECT 'a' AS s, 1.5D AS d, 1L AS l, 1 AS i").schema
    assert column_types(schema, 64) == "`s` VARCHAR(64)"


def test_kept_rows_are_as_small_as_the_output(spark, sf_dir, tmp_path):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    kept = write_outputs(df, [out(tmp_path / "a"), out(tmp_path / "b")])
    size = lambda files: sum(Path(file.removeprefix("file:").replace("///", "/")).stat().st_size for file in files)
    assert size(kept.inputFiles()) < 1.2 * size(spark.read.parquet(str(tmp_path / "a")).inputFiles())
    discard(kept)


def test_job_keys(spark, tmp_path):
    job = {"sql": "SELECT 1 AS a", "inputs": [], "outputs": [out(tmp_path / "t")]}
    assert run_job(spark, job).count() == 1
    for key in job:
        with pytest.raises(ValueError, match=key):
            run_job(spark, {name: value for name, value in job.items() if name != key})
    with pytest.raises(ValueError, match="at least one"):
        run_job(spark, {**job, "outputs": []})


def test_errors_and_plans_hold_no_password(spark, capfd):
    with pytest.raises(Exception) as error:
        write_output(spark.range(1), TABLE)
    assert "pw" not in str(error.value).split()
    assert "pw" not in capfd.readouterr().out.split()
