"""Spelling variants against all ways to leave out or replace one letter."""

import random

import numpy as np
import pytest
from brute import frame
from brute_words import near, variants, vocabulary
from hypothesis import given, settings
from hypothesis import strategies as st

from braid.llm import spelling

WORDS = st.lists(st.text("abé", min_size=5, max_size=9), min_size=2, max_size=40, unique=True)


def found_pairs(spark, words):
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n bigint")
    rows = [(r.a, r.b) for r in spelling.near_words(df).collect()]
    assert len(rows) == len(set(rows))
    return {frozenset(r) for r in rows}


def wanted_pairs(words):
    return {frozenset((w, x)) for w, others in near(set(words)).items() for x in others}


@settings(max_examples=8, deadline=None)
@given(words=WORDS)
def test_no_pair_is_missed_among_short_words_of_few_letters(spark, words):
    assert found_pairs(spark, words) == wanted_pairs(words)


def test_long_words_of_one_letter_and_one_large_key(spark):
    """Words beyond the width of the matrices, and a thousand words that agree up to their last letters."""
    words = ["a" * n for n in (5, 6, 7, 39, 40, 41, 42, 99, 100)] + ["a" * 50 + "b" + "a" * 49, "b" + "a" * 98]
    rng = random.Random(2)
    words += [f"quality{''.join(rng.choice('abcdefghij') for _ in range(4))}" for _ in range(1000)]
    words = sorted(set(words))
    assert found_pairs(spark, words) == wanted_pairs(words)


@given(words=WORDS)
def test_pivots_do_not_overlap_and_are_the_cheapest_of_the_prefix(words):
    data, at = spelling._letters(words)
    counts = np.zeros(1 << 16, np.int64)
    for w in words:
        for a, b in zip(w.encode("latin-1"), w.encode("latin-1")[1:]):
            counts[a << 8 | b] += 1
    word, place, pivots, last = spelling.prefixes(data, at, counts)
    gram = lambda w, i: w.encode("latin-1")[i] << 8 | w.encode("latin-1")[i + 1]
    for number, w in enumerate(words):
        order = sorted(range(len(w) - 1), key=lambda i: (counts[gram(w, i)], gram(w, i), i))
        first = order[:3]
        cheapest = min(counts[gram(w, i)] + counts[gram(w, j)] for i in first for j in first if j >= i + 2)
        a, b = pivots[number]
        assert b - a >= 2 and {a, b} <= set(first) and counts[gram(w, a)] + counts[gram(w, b)] == cheapest
        assert set(order[:3]) <= set(place[word == number]) and len(set(gram(w, i) for i in place[word == number])) <= 3


@given(a=st.text("ab", max_size=6), b=st.text("ab", max_size=6))
def test_one_edit(a, b):
    edits = {a[:i] + a[i + 1 :] for i in range(len(a))} | {a[:i] + c + a[i + d :] for i in range(len(a) + 1) for c in "ab" for d in (0, 1)}
    edits = {x for x in edits if abs(len(x) - len(a)) <= 1} - {a}
    assert spelling.one_edit(a, b) == (b in edits)


def documents():
    """Words with forms, chains of forms, ties, and enough occurrences for some to be corrupted."""
    rng = random.Random(4)
    stems = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 9))) for _ in range(60)]
    rows = [(None, None), (1, ""), (2, "ABCDE abcde Abcde abcdé abcdé abcdé"), (None, "abcde×x ÀÉÀÉÀ " * 4)]
    # A chain of two forms.
    rows += [(i + 500, "kettle kettle kettles " + "kettless " * (i % 4 == 0) + "kettle " * 3) for i in range(40)]
    for i in range(3, 120):
        words = []
        for _ in range(80):
            w = rng.choice(stems[: rng.randrange(1, 60)])
            if rng.random() < 0.2:
                at = rng.randrange(len(w))
                w = w[:at] + rng.choice(["", "z", w[at] + "y"]) + w[at + 1 :]
            words.append(w.title() if rng.random() < 0.1 else w)
        rows.append((i, " 1,".join(words)))
    return rows


def test_same_as_brute_force(spark):
    rows = documents()
    rows += rows[5:9]
    found = spelling.spelling_variants(frame(spark, [(i, t, None, None) for i, t in rows]))
    wanted = sorted(variants(rows))
    assert found.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, found.collect())) == wanted
    assert any(w[2] not in (w[0], w[1]) for w in wanted) and any(w[1] is None and w[4] for w in wanted)


def test_some_words_are_corrupted():
    plain = {w for _, t in documents() for w in (t or "").lower().replace("1", " ").replace(",", " ").split()}
    assert set(vocabulary(documents() * 3)) - plain


def test_bare_tables(spark, bare):
    assert spelling.spelling_variants(bare).collect() == []


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_whole_tables(spark, sf):
    docs = spark.read.parquet(f"/root/testdata/{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(map(tuple, spelling.spelling_variants(docs).collect())) == sorted(variants(rows))
