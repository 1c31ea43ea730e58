"""Hard negatives against plain loops, and Strassen products against numpy's."""

import math
import random

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PythonException, SparkRuntimeException
from pyspark.sql import functions as F

import __spark_entry__ as contract
from braid.llm import hard_negatives as hn
from braid.llm.strassen import product

SCHEMA = "vec_id bigint, label int, embedding array<float>, id string, at int, v string, k string, score int, tile_row int"


@settings(max_examples=60, deadline=None)
@given(rows=st.integers(1, 70), inner=st.integers(1, 70), columns=st.integers(1, 70), leaf=st.sampled_from([1, 4, 32]), seed=st.integers(0, 99))
def test_strassen_is_exact(rows, inner, columns, leaf, seed):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**27), 2**27, (rows, inner)), rng.integers(-(2**27), 2**27, (inner, columns))
    assert (product(a, b, leaf) == a @ b).all()


def plain(rows, is_anchor, positives=5, negatives=3):
    fine = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    rows = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if i is not None and label is not None and fine(v)]
    for i, label, v in rows:
        if not is_anchor(i):
            continue
        score = lambda w: sum(x * y for x, y in zip(v, w))
        others = sorted((-score(w), j, other == label) for j, other, w in rows if j != i)
        for ps, p, _ in [x for x in others if x[2]][:positives]:
            inside = [(j, s) for s, j, same in others if not same and 50 * -ps <= 100 * -s <= 95 * -ps][:negatives]
            for rank, (j, s) in enumerate(inside, 1):
                yield i, p, rank, j, -ps, -s


def table(spark, rows):
    return spark.createDataFrame([(*row, "x", 1, "y", "z", 2, 3) for row in rows], SCHEMA).repartition(3)


def vectors(seed=1, n=400):
    """Few values, so that scores tie; nulls, odd components, unequal lengths, one label in most rows."""
    rng = random.Random(seed)
    rows = [(i, rng.choice([0, 0, 0, 1, 2, None]), [rng.choice([0.1, 0.25, 0.5, -0.25]) for _ in range(6)]) for i in range(n)]
    rows += [(None, 1, [0.5] * 6), (n, 1, None), (n + 1, 1, []), (n + 2, 1, [0.5, None]), (n + 3, 2, [float("nan")] * 6), (n + 4, 2, [float("inf")])]
    rows += [(n + 5, 1, [0.5] * 3), (n + 6, 2, [0.25] * 9), (n + 7, 1, [0.0] * 6)]
    return rows


@pytest.mark.parametrize("blocks", [(1024, 8192), (7, 50)])
def test_same_as_plain_loops(spark, monkeypatch, blocks):
    monkeypatch.setattr(hn, "ANCHORS", blocks[0])
    monkeypatch.setattr(hn, "CANDIDATES", blocks[1])
    found = hn.hard_negatives(table(spark, vectors()), F.col("vec_id") % 10 == 0)
    assert sorted(map(tuple, found.collect())) == sorted(plain(vectors(), lambda i: i % 10 == 0))


def test_repeated_rows_count_each(spark):
    rows = vectors(2, 30) + [(77, 0, [0.5] * 6)] * 4 + [(78, 1, [0.3] * 6)] * 4
    found = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 7 == 1)
    assert sorted(map(tuple, found.collect())) == sorted(plain(rows, lambda i: i % 7 == 1))


@pytest.mark.parametrize("rows", [[], [(None, None, None)] * 3, [(50, 1, [0.5])], [(50, 1, [0.5]), (51, 2, [0.5])], [(1, 1, [0.5]), (2, 1, [0.5])]])
def test_too_few_rows(spark, rows):
    found = hn.hard_negatives(table(spark, rows), F.col("vec_id") % 50 == 0)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"] and found.collect() == []


def test_scores_beyond_64_bits_are_an_error(spark):
    with pytest.raises((SparkRuntimeException, PythonException), match="too large"):
        hn.hard_negatives(table(spark, [(50, 1, [1e30]), (51, 1, [1e30])]), F.col("vec_id") % 50 == 0).collect()


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_same_as_sql(spark, sf):
    duckdb.sql(f"CREATE OR REPLACE VIEW embeddings AS SELECT * FROM '/root/testdata/{sf}/embeddings.parquet'")
    wanted = duckdb.sql(contract.oracle_sql()["op11_hard_negatives"])
    found = contract.queries()["op11_hard_negatives"](spark, f"/root/testdata/{sf}")
    assert found.columns == wanted.columns and found.schema["rank"].dataType.simpleString() == "int"
    assert sorted(map(tuple, found.collect())) == sorted(wanted.fetchall())
