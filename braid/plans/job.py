"""A whole job: load the inputs, run the query over them, write its result to the outputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from braid.operators.once import write_once
from braid.operators.query import run_query
from braid.operators.sinks import write_output, write_outputs
from braid.sources import load_inputs
from braid.sources.checked import read_checked
from braid.spec import numbered


def run_job(spark: SparkSession, job: dict) -> DataFrame:
    """Run a job dict with ``sql``, ``inputs``, ``outputs`` and, where used, ``dynamic-conditions``, ``params`` and
    ``key-filters``.

    An input with ``rejects``, an output, is checked against its declared schema: the query sees the rows that keep to it, and
    the others go to that output with their reason before the query runs.

    With ``run-id``, a job that was stopped can be run again under the same id: it goes on where it stopped and writes nothing
    twice (``write_once``)."""
    missing = [key for key in ("sql", "inputs", "outputs") if key not in job]
    if missing:
        raise ValueError(f"the job lacks {', '.join(missing)}")
    if not job["outputs"]:
        raise ValueError("at least one output is needed")
    run_id = job.get("run-id")
    frames = load_inputs(spark, job["inputs"])
    for number, (name, spec) in enumerate(zip(list(frames), job["inputs"], strict=True), start=1):
        if "rejects" in spec:
            with numbered("input", number):
                frames[name], rejects = read_checked(spark, spec)
                if run_id is None:
                    write_output(rejects, spec["rejects"])
                else:
                    write_once(rejects, [spec["rejects"]], f"{run_id}_rejects_{number}")
    result = run_query(spark, frames, job["sql"], job.get("params"), job.get("dynamic-conditions"), job.get("key-filters"))
    return write_outputs(result, job["outputs"]) if run_id is None else write_once(result, job["outputs"], run_id)
