"""Run one read-only SQL query over named DataFrames."""

from __future__ import annotations

import re
from typing import Any

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession

from braid.operators.bind import bind_names, fill_conditions, view_name
from braid.operators.key_filter import key_filtered
from braid.spec import numbered


def run_query(
    spark: SparkSession,
    frames: dict[str, DataFrame],
    sql: str,
    params: dict[str, Any] | None = None,
    conditions: list[str] | None = None,
    key_filters: list[dict] | None = None,
) -> DataFrame:
    """The query's result, lazy, with ``frames`` known under their names.

    ``params`` fill ``:name`` markers with values; ``conditions`` fill ``$COND{n}`` with SQL text. Each of ``key_filters`` has
    ``input``, ``columns`` and ``keys``, a query over the other inputs: rows of the input whose columns are none of these keys may
    be left out before they are joined or fetched, which the query must not notice.
    """
    for number, wanted in enumerate(key_filters or [], start=1):
        with numbered("key filter", number):
            frames = _with_key_filter(spark, frames, wanted, params, conditions)
    if not sql or not sql.strip():
        raise ValueError("the query is empty")
    views = {name: view_name(name) for name in frames}
    text = bind_names(fill_conditions(sql, conditions or []), views)
    for name, view in views.items():
        frames[name].createOrReplaceTempView(view)
    try:
        # Only a query may stand in parentheses, and a statement that opens with one is a query: Spark's
        # own grammar turns away every write and command, and the plan is that of the bare query.
        result = spark.sql(f"({text}\n)", args=params)
        _refuse_commands(result)
        return result
    except ParseException as error:
        raise ValueError(f"not a single read-only query: {error}") from error
    finally:
        # The result is analyzed by now and no longer needs the names.
        for view in views.values():
            spark.catalog.dropTempView(view)


def _with_key_filter(spark: SparkSession, frames: dict[str, DataFrame], wanted: dict, params: dict | None, conditions: list[str] | None) -> dict[str, DataFrame]:
    missing = [key for key in ("input", "columns", "keys") if key not in wanted]
    if missing:
        raise ValueError(f"it lacks {', '.join(missing)}")
    if wanted["input"] not in frames:
        raise ValueError(f"there is no input '{wanted['input']}'")
    columns = [wanted["columns"]] if isinstance(wanted["columns"], str) else wanted["columns"]
    # Placeholders of the main query may be absent here.
    used = {name: value for name, value in (params or {}).items() if re.search(rf":{name}\b", wanted["keys"])}
    keys = run_query(spark, frames, wanted["keys"], used or None, conditions if "$COND" in wanted["keys"] else None)
    return {**frames, wanted["input"]: key_filtered(frames[wanted["input"]], keys, columns)}


# What runs programs or methods from within a query, by the names of Spark's plan nodes and expressions.
_RUNS_SCRIPTS = "ScriptTransformation"
_CALLS_METHODS = {"CallMethodViaReflection", "TryReflect"}
_CALLS_LOOK_LIKE = re.compile(r"\b(?:reflect|java_method|try_reflect)\(")


def _refuse_commands(result: DataFrame) -> None:
    """``ValueError`` if the analysed plan starts scripts or calls Java methods, anywhere in it."""
    todo = [result._jdf.queryExecution().analyzed()]
    while todo:
        plan = todo.pop()
        kind = plan.getClass().getSimpleName()
        if kind == _RUNS_SCRIPTS:
            raise ValueError("not a read-only query: it runs a script")
        expressions = plan.expressions()
        # A literal may look like a call; only the kinds of expressions tell.
        if _CALLS_LOOK_LIKE.search(expressions.mkString(" ")) and _calls_methods(_items(expressions)):
            raise ValueError("not a read-only query: it calls a Java method")
        todo += [*_items(plan.children()), *_items(plan.innerChildren()), *_items(plan.subqueries())]


def _calls_methods(expressions: list) -> bool:
    todo = list(expressions)
    while todo:
        expression = todo.pop()
        if expression.getClass().getSimpleName() in _CALLS_METHODS:
            return True
        todo += _items(expression.children())
    return False


def _items(seq) -> list:
    """A Scala sequence's items, those that are nodes of a tree."""
    return [item for item in (seq.apply(i) for i in range(seq.size())) if hasattr(item, "children")]
