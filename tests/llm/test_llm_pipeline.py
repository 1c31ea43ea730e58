"""The pipeline, stage by stage, against plain versions of what each stage has to do."""

from collections import Counter

import brute
import pytest
from brute import frame
from test_llm_contracts import WORDS, check_packing
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from braid.llm import quality, secret_scan

COLUMNS = ["doc_id", "text", "lang", "source"]


def rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def test_stages_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "exact_dedup", "near_dedup", "secrets", "packing"]
    assert contract.queries()["pipeline"].__wrapped__ is corpus_pipeline.run and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("source", ["given", "odd"])
def test_each_stage(spark, odd, source):
    docs = odd if source == "odd" else spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    stages, columns = dict(corpus_pipeline.STAGES), docs.columns
    step = lambda name, df: stages[name](spark, df, "unused")

    kept = step("quality_rules", docs).checkpoint()
    verdict = Counter((r.doc_id, r.kept) for r in quality.quality(docs).collect())
    assert Counter(r.doc_id for r in kept.collect()) == Counter({i: n for (i, ok), n in verdict.items() if ok})
    assert not any(failed for *_, failed in brute.quality([(r.doc_id, r.text) for r in kept.collect()]))

    single = step("exact_dedup", kept).checkpoint()
    best = {}
    for r in kept.collect():
        best[brute.fold(r.text)] = max(best.get(brute.fold(r.text), r.doc_id), r.doc_id)
    assert sorted((brute.fold(r.text), r.doc_id) for r in single.collect()) == sorted(best.items())

    apart = step("near_dedup", single).checkpoint()
    texts = [(r.doc_id, r.text) for r in single.collect()]
    assert sorted(r.doc_id for r in apart.collect()) == sorted(i for i, n, c in brute.jaccard(texts) if i == c or n == 0)

    masked = step("secrets", apart).checkpoint()
    spans = {r.doc_id: [s for s in r.spans if s.live] for r in secret_scan.secrets(apart).collect()}
    before = {r.doc_id: r.text for r in apart.collect()}
    for r in masked.collect():
        assert (r.text == before[r.doc_id]) == (not spans[r.doc_id])
        assert not any(before[r.doc_id][s.start : s.end] in r.text for s in spans[r.doc_id])
    assert kept.columns == single.columns == apart.columns == masked.columns == columns

    packed = step("packing", masked).collect()
    library = Tokenizer.from_file(WORDS)
    check_packing(packed, [(r.doc_id, [*library.encode(r.text or "", add_special_tokens=False).ids, 1]) for r in masked.collect()], 2048)


def test_the_whole_run(spark):
    pieces = corpus_pipeline.run(spark, "/root/testdata/sf0.001").collect()
    ids = {p.doc_id for p in pieces}
    assert 0 < len(ids) < 200 and {"start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"} <= set(pieces[0].asDict())


def test_nothing_to_do(spark):
    docs = frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "unused").checkpoint()
        assert docs.count() == 0, name
