"""Outputs that a repeated job writes once."""

from __future__ import annotations

import hashlib
import json
import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from braid.operators.sinks import FILE_SINKS, check_output, mode_of, write_output
from braid.shared import shared_folder
from braid.sources.files import file_path, s3_options
from braid.spec import numbered


def write_once(df: DataFrame, outputs: list[dict], run_id: str) -> DataFrame:
    """Write one result to every output, in order, and return it; when called again under the same ``run_id``, go on where the
    call before stopped. Nothing is written twice, and finished outputs are left alone.

    ``<spark.checkpoint.dir>/runs/<run_id>`` keeps what the run is about, its result and how far each output is; a call for
    other outputs or other columns is an error. The result is worked out once, so that all outputs get the same rows even if
    inputs change between calls. Each output is written to a folder beside its target and moved there when it is complete. To
    append, files are moved one by one under names of the run; readers may see a part of them while that goes on. To overwrite,
    the old target goes when the new one is complete. ``forget_run`` removes what is kept.

    One call at a time may use a ``run_id``. Outputs have to be files: a database would need its own transaction.
    """
    if not re.fullmatch(r"[A-Za-z0-9_-]+", run_id):
        raise ValueError("a run id has letters, digits, '_' and '-' only")
    if not outputs:
        raise ValueError("at least one output is needed")
    for number, output in enumerate(outputs, start=1):
        with numbered("output", number):
            if check_output(output) not in FILE_SINKS:
                raise ValueError("only files are written once")
    spark = df.sparkSession
    folder, files = _run_folder(spark, run_id), _Files(spark)
    _claim(files, folder, df, outputs)
    kept = _result(files, folder, df)
    for number, output in enumerate(outputs, start=1):
        done = f"{folder}/output_{number}.done"
        if not files.exists(done):
            _write(spark, kept, output, folder, run_id, number)
            files.put(done)
    return kept


def forget_run(spark: SparkSession, run_id: str) -> None:
    """Remove what is kept of a run; its outputs stay. The same id then stands for a new run."""
    _Files(spark).delete(_run_folder(spark, run_id))


def _run_folder(spark: SparkSession, run_id: str) -> str:
    return f"{shared_folder(spark)}/runs/{run_id}"


def _claim(files: _Files, folder: str, df: DataFrame, outputs: list[dict]) -> None:
    about = json.dumps([df.schema.jsonValue(), [[file_path(o), mode_of(o), o.get("file-type")] for o in outputs]], sort_keys=True)
    mark = f"{folder}/about_{hashlib.sha256(about.encode()).hexdigest()}"
    if not files.exists(mark):
        if any(name.startswith("about_") for name in files.names(folder)):
            raise ValueError("this run id stands for other outputs or other columns; use a new one, or forget_run")
        files.put(mark)


def _result(files: _Files, folder: str, df: DataFrame) -> DataFrame:
    """The rows, written once; a sorted result with its order."""
    path, place = f"{folder}/result", "_place"
    while place in df.columns:
        place += "_"
    ordered = not df._jdf.queryExecution().optimizedPlan().outputOrdering().isEmpty()
    rows = df.withColumn(place, F.monotonically_increasing_id()) if ordered else df
    if not files.exists(f"{path}.done"):
        rows.write.mode("overwrite").parquet(path)
        files.put(f"{path}.done")
    kept = df.sparkSession.read.schema(rows.schema).parquet(path)
    return kept.orderBy(place).drop(place) if ordered else kept


def _write(spark: SparkSession, kept: DataFrame, output: dict, folder: str, run_id: str, number: int) -> None:
    target, mode = file_path(output).rstrip("/"), mode_of(output)
    # Hidden from readers of the folder that the target stands in.
    parent, _, name = target.rpartition("/")
    stage, staged = f"{parent}/_{name}_{run_id}_{number}", f"{folder}/output_{number}.staged"
    files, own = _Files(spark, s3_options(output)), _Files(spark)
    if not own.exists(staged):
        if mode == "error" and files.exists(target):
            raise ValueError(f"output {number}: '{target}' exists already")
        write_output(kept, {**output, "file-path": stage, "mode": "overwrite"})
        own.put(staged)
    # From here on the stage is whole: what is missing from it has been moved.
    if mode == "append":
        for name in files.names(stage):
            if not name.startswith(("_", ".")):
                files.move(f"{stage}/{name}", f"{target}/{run_id}_{number}_{name}")
        files.delete(stage)
    elif files.exists(stage):
        files.delete(target)
        files.move(stage, target)


class _Files:
    """Hadoop's file system of each path, under the session's settings and those of one output."""

    def __init__(self, spark: SparkSession, options: dict[str, str] | None = None):
        self._hadoop = spark._jvm.org.apache.hadoop
        self._settings = self._hadoop.conf.Configuration(spark._jsc.hadoopConfiguration())
        for key, value in (options or {}).items():
            self._settings.set(key, value)

    def _open(self, name: str):
        path = self._hadoop.fs.Path(name)
        return path.getFileSystem(self._settings), path

    def exists(self, name: str) -> bool:
        system, path = self._open(name)
        return system.exists(path)

    def names(self, folder: str) -> list[str]:
        system, path = self._open(folder)
        return sorted(status.getPath().getName() for status in system.listStatus(path)) if system.exists(path) else []

    def put(self, name: str) -> None:
        system, path = self._open(name)
        system.create(path, True).close()

    def delete(self, name: str) -> None:
        system, path = self._open(name)
        system.delete(path, True)

    def move(self, source: str, target: str) -> None:
        """Where a store moves by copying, a copy that was cut off is made anew and one that is whole stands for the move."""
        system, old = self._open(source)
        new = self._hadoop.fs.Path(target)
        system.mkdirs(new.getParent())
        if system.exists(new):
            if system.getFileStatus(new).getLen() == system.getFileStatus(old).getLen():
                system.delete(old, True)
                return
            system.delete(new, True)
        if not system.rename(old, new):
            raise OSError(f"'{source}' could not be moved to '{target}'")
