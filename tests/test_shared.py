"""Where data that outlives a task is kept."""

from types import SimpleNamespace

import pytest

from braid import write_outputs
from braid.operators import sinks
from braid.shared import discard, fresh_path, shared_folder, written


def session(setting=None, current=None):
    """Stands in for a session: its setting, the folder its context has."""
    context = SimpleNamespace(getCheckpointDir=lambda: current)
    return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default: setting or default), sparkContext=context)


def test_the_setting_of_the_cluster_is_used():
    spark = session(setting="hdfs:///shared/")
    assert shared_folder(spark) == "hdfs:///shared"
    assert fresh_path(spark, "t").startswith("hdfs:///shared/t_")
    assert fresh_path(spark, "t") != fresh_path(spark, "t")


def test_a_folder_set_on_the_context_is_used():
    assert shared_folder(session(current="hdfs:///own")) == "hdfs:///own"


def test_without_a_folder_there_is_an_error():
    for use in (lambda spark: shared_folder(spark), lambda spark: fresh_path(spark, "t")):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            use(session())


def test_written_rows_are_read_back_without_lineage(spark):
    df = written(spark.range(10), "t")
    assert sorted(row.id for row in df.collect()) == list(range(10))
    assert len(df.inputFiles()) > 0


def test_written_rows_can_be_empty_and_removed(spark, tmp_path):
    df = written(spark.range(0).repartition(3), "t")
    assert df.count() == 0 and df.columns == ["id"]
    df = written(spark.range(10), "t")
    discard(df)
    with pytest.raises(Exception, match="exist"):
        df.collect()


def test_only_what_was_written_here_is_removed(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "own"))
    discard(spark.read.parquet(str(tmp_path / "own")))
    assert spark.read.parquet(str(tmp_path / "own")).count() == 3


def test_several_outputs_need_a_shared_folder(spark, tmp_path, monkeypatch):
    def missing(df, label):
        raise ValueError("set spark.checkpoint.dir")

    monkeypatch.setattr(sinks, "written", missing)
    outputs = [
        {"datasink": "OUT", "config": {"type": "local"}, "file-type": "parquet", "file-path": str(tmp_path / name)}
        for name in "ab"
    ]
    write_outputs(spark.range(10), outputs[:1])
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        write_outputs(spark.range(10), outputs)
