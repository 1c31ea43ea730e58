"""Folder that every executor can read and write, for data that must outlive a task."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that the session names: ``spark.checkpoint.dir``, or the one set on its context."""
    chosen = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if chosen is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return chosen.rstrip("/")


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that nothing has used yet."""
    return f"{shared_folder(spark)}/{label}_{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write the rows once to the shared folder and read them back: fixed content, exact size, no lineage."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    # The schema as it is: nothing has to be looked up in the files, and there may be none.
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Remove the rows that ``written`` or ``write_outputs`` kept for this frame. It cannot be read any more."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    for name in {file.rpartition("/")[0] for file in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if system.makeQualified(path.getParent()).equals(system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(folder))):
            system.delete(path, True)
