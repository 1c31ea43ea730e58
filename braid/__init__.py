"""One SQL query over tables kept in different stores, answered with Spark."""

from braid.operators.distinct import cube_sets, distinct_counts, rollup_sets
from braid.operators.key_filter import filtered_join, key_filtered
from braid.operators.once import forget_run, write_once
from braid.operators.query import run_query
from braid.operators.range_join import range_join
from braid.operators.sinks import write_output, write_outputs
from braid.operators.skew import skew_join
from braid.operators.windows import over_groups
from braid.plans.job import run_job
from braid.sources import load_inputs, read_source
from braid.sources.checked import read_checked

__all__ = [
    "cube_sets", "distinct_counts", "filtered_join", "forget_run", "key_filtered", "load_inputs", "over_groups", "range_join", "read_checked", "read_source",
    "rollup_sets", "run_job", "run_query", "skew_join", "write_once", "write_output", "write_outputs",
]
