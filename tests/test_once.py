"""A run that is stopped anywhere and called again writes every output once."""

import pytest

from braid import forget_run, read_source, run_job, write_once
from braid.operators import once


def out(path, mode=None, kind="parquet"):
    spec = {"datasink": "OUT", "datasource": "OUT", "config": {"type": "local"}, "file-type": kind, "file-path": str(path)}
    return {**spec, "mode": mode} if mode else spec


class Stopped(Exception):
    pass


@pytest.mark.parametrize("mode", [None, "overwrite", "append"])
def test_stopped_at_every_step(spark, tmp_path, monkeypatch, mode):
    """Stop before the first, second, ... step that changes a file, then call again to the end."""
    rows, stops = spark.range(0, 20, 1, 3), 0
    for steps in range(40):
        targets = [out(tmp_path / f"{steps}_{i}", mode) for i in range(2)]
        if mode:
            spark.range(100, 103).write.parquet(targets[1]["file-path"])
        left = [steps]

        def counted(step):
            def run(*args, **more):
                if left[0] == 0:
                    raise Stopped
                left[0] -= 1
                return step(*args, **more)

            return run

        with monkeypatch.context() as patch:
            for name in ("put", "move", "delete"):
                patch.setattr(once._Files, name, counted(getattr(once._Files, name)))
            patch.setattr(once, "write_output", counted(once.write_output))
            try:
                write_once(rows, targets, f"{mode}_{steps}")
                finished = True
            except Stopped:
                finished = False
                stops += 1
        write_once(rows, targets, f"{mode}_{steps}")
        found = [sorted(r.id for r in read_source(spark, t).collect()) for t in targets]
        assert found == [list(range(20)), [*range(20), *([100, 101, 102] if mode == "append" else [])]]
        assert not [p.name for p in tmp_path.iterdir() if p.name.startswith("_")]
        if finished:
            break
    assert finished and stops >= 6


def test_what_a_run_is_about(spark, tmp_path):
    target = out(tmp_path / "t", "append")
    assert write_once(spark.range(5), [target], "about").count() == 5
    # The rows are those of the first call.
    assert write_once(spark.range(7), [target], "about").count() == 5 and read_source(spark, target).count() == 5
    for df, targets in ((spark.range(5).toDF("k"), [target]), (spark.range(5), [out(tmp_path / "u")])):
        with pytest.raises(ValueError, match="other outputs"):
            write_once(df, targets, "about")
    forget_run(spark, "about")
    assert write_once(spark.range(7), [target], "about").count() == 7 and read_source(spark, target).count() == 12
    with pytest.raises(ValueError, match="exists already"):
        write_once(spark.range(5), [out(tmp_path / "t")], "new")
    with pytest.raises(ValueError, match="only files"):
        write_once(spark.range(5), [{"datasink": "D", "config": {"type": "jdbc", "url": "u", "driver": "d", "user": "u", "password": "p"}, "table": "t"}], "db")
    for wrong, outputs in (("a/b", [target]), ("a", [])):
        with pytest.raises(ValueError):
            write_once(spark.range(5), outputs, wrong)


def test_order_and_empty_results(spark, tmp_path):
    df = spark.range(50).orderBy("id", ascending=False)
    assert [r.id for r in write_once(df, [out(tmp_path / "t", kind="json")], "sorted").collect()] == list(range(49, -1, -1))
    assert write_once(spark.range(0), [out(tmp_path / "e")], "empty").isEmpty() and spark.read.parquet(str(tmp_path / "e")).isEmpty()


def test_a_job_with_rejects_is_run_again(spark, tmp_path):
    (tmp_path / "t.csv").write_text("1\nx\n2\n")
    schema = [{"name": "k", "datatype": "long", "nullable": True}]
    given = {"datasource": "IN", "name": "T", "config": {"type": "local"}, "file-type": "csv", "file-path": str(tmp_path / "t.csv"), "schema": schema}
    job = {"sql": "SELECT k FROM T", "inputs": [{**given, "rejects": out(tmp_path / "bad", "append")}], "outputs": [out(tmp_path / "good", "append")]}
    for _ in range(2):
        run_job(spark, {**job, "run-id": "daily"})
    assert spark.read.parquet(str(tmp_path / "good")).count() == 2 and spark.read.parquet(str(tmp_path / "bad")).count() == 1
