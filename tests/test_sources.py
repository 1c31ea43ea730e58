"""Schemas, readers and the options they hand to Spark."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import types as T

from braid import read_source
from braid.operators.bind import input_name
from braid.sources import jdbc, mongo_options
from braid.sources.files import file_path, s3_options
from braid.sources.schema import to_struct, to_type


@pytest.mark.parametrize(
    "name, kind",
    [
        ("byte", T.ByteType()), ("short", T.ShortType()), ("int", T.IntegerType()), ("Integer", T.IntegerType()),
        ("long", T.LongType()), ("float", T.FloatType()), ("DOUBLE", T.DoubleType()), ("string", T.StringType()),
        ("varchar", T.StringType()), ("char", T.StringType()), ("varchar(20)", T.StringType()),
        ("char( 3 )", T.StringType()), ("byte[]", T.BinaryType()), ("boolean", T.BooleanType()),
        ("timestamp", T.TimestampType()), ("timestamp_ntz", T.TimestampNTZType()), ("date", T.DateType()),
        ("decimal(12,2)", T.DecimalType(12, 2)), ("Decimal(10, 3)", T.DecimalType(10, 3)),
        ("decimal(10)", T.DecimalType(10, 0)), ("array<int>", T.ArrayType(T.IntegerType())),
    ],
)
def test_declared_types(spark, name, kind):
    assert to_type(name) == kind


def test_unknown_type(spark):
    with pytest.raises(ValueError, match="number"):
        to_type("number(20)")


def test_fields_need_all_three_keys(spark):
    with pytest.raises(ValueError, match="nullable"):
        to_struct([{"name": "a", "datatype": "int"}])
    assert to_struct([{"name": "a", "datatype": "int", "nullable": False}]) == T.StructType().add("a", T.IntegerType(), False)


def file(path, kind, **more):
    return {"datasource": "FILES", "file-type": kind, "file-path": str(path), **more}


def rows(df):
    return [tuple(row) for row in df.collect()]


FIELDS = [
    {"name": name, "datatype": kind, "nullable": True}
    for name, kind in (("id", "int"), ("price", "decimal(12,2)"), ("day", "date"), ("note", "string"))
]


@pytest.fixture
def csv(tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('id;price;day;note\n1;2.50;03/01/2020;\'a;b\'\n2;bad;xx;NA\n3;;;\n4;1;04/01/2020;\'\'\n')
    return file(path, "CSV", header="true", delimiter=";", quote="'", nullValue="NA", dateFormat="dd/MM/yyyy")


def test_declared_csv(spark, csv):
    found = rows(read_source(spark, {**csv, "inferSchema": "false", "schema": FIELDS}))
    assert [row[0] for row in found] == [1, 2, 3, 4]
    assert str(found[0][1:3]) == "(Decimal('2.50'), datetime.date(2020, 1, 3))" and found[0][3] == "a;b"
    assert found[1][1:] == (None, None, None)
    assert found[2][1:3] == (None, None)


def test_bad_cells_can_be_an_error(spark, csv):
    with pytest.raises(Exception, match="FAILFAST"):
        read_source(spark, {**csv, "schema": FIELDS, "options": {"mode": "FAILFAST"}}).collect()


def test_inferred_and_plain_csv(spark, csv):
    assert read_source(spark, {**csv, "inferSchema": "true"}).schema["id"].dataType == T.IntegerType()
    assert {field.dataType for field in read_source(spark, {**csv, "inferSchema": "false"}).schema} == {T.StringType()}


def test_json_declared_and_inferred(spark, tmp_path):
    path = tmp_path / "t.json"
    path.write_text('{"b": 1, "a": {"x": [1, 2]}}\n{"b": null}\n')
    assert read_source(spark, file(path, "json", inferSchema=True)).columns == ["a", "b"]
    fields = [{"name": "b", "datatype": "short", "nullable": True}]
    assert rows(read_source(spark, file(path, "json", schema=fields))) == [(1,), (None,)]
    with pytest.raises(ValueError, match="schema"):
        read_source(spark, file(path, "json"))


def test_binary_column_from_csv(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("abc\n")
    fields = [{"name": "raw", "datatype": "byte[]", "nullable": True}]
    assert bytes(read_source(spark, file(path, "csv", schema=fields)).first().raw) == b"abc"


@pytest.mark.parametrize("kind", ["local", "LOCAL", "hdfs", "files", "FILES"])
def test_all_file_stores_read_alike(spark, sf_dir, kind):
    spec = {"datasource": "LAKE", "config": {"type": kind}, "file-type": "parquet", "file-path": f"{sf_dir}/nation.parquet"}
    assert read_source(spark, spec).count() == 25


def test_a_file_store_may_be_named_by_the_datasource_alone(spark, sf_dir):
    file = {"file-type": "parquet", "file-path": f"{sf_dir}/nation.parquet"}
    assert read_source(spark, {"datasource": "HDFS", **file}).count() == 25
    with pytest.raises(ValueError, match="type"):
        read_source(spark, {"datasource": "LAKE", **file})


def test_unsupported(spark):
    with pytest.raises(ValueError, match="type"):
        read_source(spark, {"datasource": "X"})
    with pytest.raises(ValueError, match="cobol"):
        read_source(spark, {"datasource": "X", "config": {"type": "cobol"}})
    with pytest.raises(ValueError, match="orc"):
        read_source(spark, file("/x", "orc"))
    with pytest.raises(ValueError, match="file-path"):
        read_source(spark, {"datasource": "FILES", "file-type": "parquet"})


def test_s3_keys_belong_to_one_bucket():
    spec = {"file-path": "s3://lake/a/t", "config": {"fs.s3.awsAccessKeyId": "id", "password": "key"}}
    assert file_path(spec) == "s3a://lake/a/t"
    assert s3_options(spec) == {"fs.s3a.bucket.lake.access.key": "id", "fs.s3a.bucket.lake.secret.key": "key"}
    assert s3_options({"file-path": "s3a://lake/t"}) == {}
    assert s3_options({"file-path": "/lake/t", "config": {"fs.s3.awsAccessKeyId": "id"}}) == {}


def test_options_of_one_input_reach_its_file_system(spark):
    """As the keys of a bucket do: the named class is looked for, and the session knows nothing of it."""
    spec = file("s3a://lake/t", "parquet", options={"fs.s3a.impl": "com.example.Store"}, name="t")
    with pytest.raises(Exception, match="com.example.Store"):
        read_source(spark, spec)
    with pytest.raises(Exception) as error:
        read_source(spark, {key: value for key, value in spec.items() if key != "options"})
    assert "com.example.Store" not in str(error.value)


def test_mongo(spark):
    spec = {"datasource": "M", "config": {"type": "mongo", "uri": "mongodb://h"}, "database": "d", "collection": "c"}
    assert mongo_options(spec) == {"connection.uri": "mongodb://h", "database": "d", "collection": "c"}
    assert mongo_options({"uri": "mongodb://h/d.c"}) == {"connection.uri": "mongodb://h/d.c"}
    assert input_name(spec) == "M.d.c"
    with pytest.raises(Exception, match="mongodb"):
        read_source(spark, spec)


def db(url, **more):
    config = {"jdbc-url": url, "driver": "com.example.Driver", "password": "pw"}
    return {"datasource": "DB", "database": "d", "table": "t", "user": "u", "config": config, **more}


@pytest.mark.parametrize(
    "kind, url, more, full, table",
    [
        ("mysql", "jdbc:mysql://h:3306", {}, "jdbc:mysql://h:3306/d", "d.t"),
        ("mysql", "jdbc:mysql://h:3306/", {}, "jdbc:mysql://h:3306/d", "d.t"),
        ("mysql", "jdbc:mysql://h:3306/d", {}, "jdbc:mysql://h:3306/d", "d.t"),
        ("mysql", "jdbc:mysql://h?ssl=1", {}, "jdbc:mysql://h/d?ssl=1", "d.t"),
        ("postgres", "jdbc:postgresql://h", {"schema": "s"}, "jdbc:postgresql://h/d", '"s".t'),
        ("postgres", "jdbc:postgresql://h/", {}, "jdbc:postgresql://h/d", "t"),
        ("mssql", "jdbc:sqlserver://h:1433", {"schema": "dbo"}, "jdbc:sqlserver://h:1433;databaseName=d", '"dbo".t'),
        ("mssql", "jdbc:jtds:sqlserver://h/", {"schema": "dbo"}, "jdbc:jtds:sqlserver://h/d", '"dbo".t'),
        ("mssql", "jdbc:sqlserver://h;databaseName=x", {"schema": "s"}, "jdbc:sqlserver://h;databaseName=x", '"s".t'),
        ("oracle", "jdbc:oracle:thin:@h:1521:sid", {"schema": "s"}, "jdbc:oracle:thin:@h:1521:sid", '"s".t'),
        ("ibmdb2", "jdbc:db2://h:50000/d", {"schema": "s"}, "jdbc:db2://h:50000/d", '"s".t'),
    ],
)
def test_database_options(kind, url, more, full, table):
    options = jdbc.connection_options(db(url, **more), kind)
    assert (options["url"], options["dbtable"]) == (full, table)
    assert (options["driver"], options["user"], options["password"]) == ("com.example.Driver", "u", "pw")


class Reads:
    """Stands in for ``spark.read``; keeps what it was asked and gives one prepared answer."""

    def __init__(self, answer=None):
        self.answer, self.asked, self.calls = answer, [], []

    @property
    def read(self):
        return self

    def format(self, name):
        assert name == "jdbc"
        return self

    def options(self, **options):
        self.calls.append(options)
        return self

    def load(self):
        return self

    def first(self):
        return self.answer

    def collect(self):
        return self.answer

    def jdbc(self, url, table, predicates, properties):
        self.calls.append({"url": url, "table": table, "predicates": predicates, **properties})


def test_ranges_are_looked_up():
    spark = Reads((1, 900))
    jdbc.read_table(spark, db("jdbc:mysql://h", **{"partition-column": "k", "num-partitions": 8}), "mysql")
    asked, read = spark.calls
    assert asked["query"] == "SELECT MIN(k) AS low, MAX(k) AS high FROM d.t" and "dbtable" not in asked
    assert {key: read[key] for key in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "k", "lowerBound": "1", "upperBound": "900", "numPartitions": "8",
    }
    assert read["fetchsize"] == "10000" and read["useCursorFetch"] == "true"


@pytest.mark.parametrize(
    "found, bounds",
    [
        ((Decimal("1.50"), Decimal("9.0000")), ("1", "9")),
        ((-0.5, 8.5), ("-1", "9")),
        ((date(2020, 1, 1), date(2021, 1, 1)), ("2020-01-01", "2021-01-01")),
    ],
)
def test_bounds_are_spelled_as_spark_reads_them(found, bounds):
    spark = Reads(found)
    jdbc.read_table(spark, db("jdbc:oracle:x", **{"partition-column": "k", "num-partitions": 4}), "oracle")
    assert (spark.calls[1]["lowerBound"], spark.calls[1]["upperBound"]) == bounds


def test_given_ranges_need_no_lookup_and_empty_tables_no_ranges():
    spark = Reads()
    split = {"partition-column": "k", "num-partitions": 4, "lower-bound": 0, "upper-bound": 10}
    jdbc.read_table(spark, db("jdbc:mysql://h", **split), "mysql")
    assert len(spark.calls) == 1 and spark.calls[0]["upperBound"] == "10"
    spark = Reads((None, None))
    jdbc.read_table(spark, db("jdbc:mysql://h", **{"partition-column": "k", "num-partitions": 4}), "mysql")
    assert "partitionColumn" not in spark.calls[1]


@pytest.mark.parametrize("low, spelled", [(0, "0"), (0.5, "0"), (Decimal("-0.5"), "-1"), (date(2020, 1, 1), "2020-01-01"), ("2020-01-01 00:00:00", "2020-01-01 00:00:00")])
@pytest.mark.parametrize("found, high", [(900, "900"), (Decimal("900.0000000000"), "900"), (899.5, "900"), (date(2021, 1, 1), "2021-01-01"), (datetime(2021, 1, 1, 5), "2021-01-01 05:00:00")])
def test_each_bound_is_spelled_alone(low, spelled, found, high):
    """One bound given, the other looked up, in any mix."""
    spark = Reads((found, found))
    split = {"partition-column": "k", "num-partitions": 4}
    jdbc.read_table(spark, db("jdbc:oracle:x", **split, **{"lower-bound": low}), "oracle")
    assert (spark.calls[-1]["lowerBound"], spark.calls[-1]["upperBound"]) == (spelled, high)


def test_predicates_split_a_read():
    spark = Reads()
    jdbc.read_table(spark, db("jdbc:mysql://h", predicates=["k = 1", "k <> 1 OR k IS NULL"]), "mysql")
    assert spark.calls[0]["predicates"] == ["k = 1", "k <> 1 OR k IS NULL"] and spark.calls[0]["user"] == "u"


def test_a_split_by_depth_asks_for_its_cuts():
    spark = Reads([(3, 70), (1, 5), (2, 50), (4, 70)])
    jdbc.read_table(spark, db("jdbc:mysql://h", split="depth", **{"partition-column": "k", "num-partitions": 4}), "mysql")
    asked, read = spark.calls
    assert "NTILE(4) OVER (ORDER BY k)" in asked["query"] and "FROM d.t WHERE k IS NOT NULL" in asked["query"] and "dbtable" not in asked
    assert read["predicates"] == ["k < 50 OR k IS NULL", "k >= 50 AND k < 70", "k >= 70"] and read["table"] == "d.t"
    for more in ({"split": "depth"}, {"split": "even", "num-partitions": 1}):
        with pytest.raises(ValueError, match="split"):
            jdbc.read_table(Reads(), db("jdbc:mysql://h", **more), "mysql")


def test_an_input_says_how_it_is_split():
    """The rule does not look at the table: an answer of one row or of 10^9 is never asked for."""
    own = {"options": {"partitionColumn": "k", "lowerBound": 0, "upperBound": 9, "numPartitions": 3}}
    for rows in (1, 10**9):
        for more in ({}, {"partition-column": "k"}, {"num-partitions": 8}):
            spark = Reads((rows,))
            with pytest.raises(ValueError, match="partition-column"):
                jdbc.read_table(spark, db("jdbc:mysql://h", **more), "mysql")
            assert spark.calls == []
        for more in ({"num-partitions": 1}, {"num-partitions": "1"}, own):
            spark = Reads((rows,))
            jdbc.read_table(spark, db("jdbc:mysql://h", **more), "mysql")
            assert [call["dbtable"] for call in spark.calls] == ["d.t"]


@pytest.mark.parametrize("kind", jdbc.DATABASE_TYPES)
def test_a_database_input_reaches_the_jdbc_source(spark, kind):
    spec = db("jdbc:none://h", schema="s", **{"num-partitions": 1})
    spec["config"]["type"] = kind
    with pytest.raises(Exception, match="com.example.Driver"):
        read_source(spark, spec)
