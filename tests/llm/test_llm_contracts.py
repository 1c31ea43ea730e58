"""Each operator against plain versions of its contract, over odd rows, bare tables and whole given tables."""

import base64
import zlib

import brute
import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as contract
from braid.llm import bpe, dedup, jaccard, langid, packing, pii, quality, queries, secret_scan, substring, token_counts

RANKS, BYTES, WORDS = map(public_tokenizers.path, ("byte_bpe_50k.tiktoken", "byte_bpe_50k.json", "word_bpe_49k.json"))
SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def given_rows():
    return duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SMALL}/documents.parquet'").fetchall()


def texts(rows):
    return [(r[0], r[1]) for r in rows]


def tuples(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def same(found, wanted):
    assert found == sorted(map(tuple, wanted), key=repr)


def op1(df):
    return tuples(substring.substring_dedup(df).withColumn("sha", F.sha2("kept_text", 256)), "doc_id", "n_words", "n_removed", "sha")


def test_substring_dedup(odd, odd_rows, spark, given_rows):
    same(op1(odd), brute.substring_dedup(texts(odd_rows)))
    same(tuples(queries.op1_substring_dedup(spark, SMALL), "doc_id", "n_words", "n_removed", "kept_sha256"), brute.substring_dedup(texts(given_rows)))


def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe(odd, odd_rows, spark, given_rows):
    library = encoding()
    found = bpe.decode_ids(bpe.encode_texts(odd, RANKS), RANKS)
    wanted = [(i, library.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in odd_rows]
    assert sorted((r.doc_id, list(r.ids), bytes(r.decoded)) for r in found.collect()) == sorted(wanted)
    wanted = [(i, len(ids := library.encode_ordinary(t)), brute.sha(" ".join(map(str, ids))), brute.sha(t)) for i, t, *_ in given_rows]
    same(tuples(queries.op2_bpe(spark, SMALL), "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), wanted)


def test_token_counts(odd, odd_rows, spark, given_rows):
    library = Tokenizer.from_file(BYTES)
    count = lambda t: len(library.encode(t, add_special_tokens=False).ids)
    same(tuples(token_counts.token_counts(odd, BYTES), "doc_id", "n_bytes", "n_tokens"), [(i, len((t or "").encode()), count(t or "")) for i, t, *_ in odd_rows])
    same(tuples(queries.op3_token_counts(spark, SMALL), "doc_id", "n_tokens", "over_limit"), [(i, count(t), count(t) > 1024) for i, t, *_ in given_rows])


@pytest.mark.parametrize("part_rows", [3, 2000])
def test_jaccard_join(odd, odd_rows, part_rows):
    same(tuples(jaccard.near_duplicates(odd, part_rows=part_rows), "doc_id", "n_shingles", "component_id"), brute.jaccard(texts(odd_rows)))


def test_jaccard_join_on_given_rows(spark, given_rows):
    same(tuples(queries.op4_jaccard_join(spark, SMALL), "doc_id", "n_shingles", "component_id"), brute.jaccard(texts(given_rows)))


@pytest.mark.parametrize("slice_rows", [1, 2, 1000])
def test_exact_dedup(odd, odd_rows, slice_rows):
    found = dedup.exact_dedup(odd, slice_rows=slice_rows)
    groups = {}
    for i, t, *_ in odd_rows:
        groups.setdefault(brute.fold(t), []).append(i)
    wanted = [(i, max(groups[brute.fold(t)]), len(groups[brute.fold(t)]), brute.sha(brute.fold(t))) for i, t, *_ in odd_rows]
    same(tuples(found, "doc_id", "keep_id", "group_size", "text_sha256"), wanted)
    kept = found.filter("kept").collect()
    assert sorted(r.text_sha256 for r in kept) == sorted(map(brute.sha, groups)) and all(r.doc_id == r.keep_id for r in kept)
    left = dedup.without_copies(odd, slice_rows=slice_rows)
    assert left.columns == odd.columns and left.count() == len(groups)


def test_exact_dedup_sql(spark, given_rows):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    wanted = con.sql(contract.oracle_sql()["op5_exact_dedup"])
    same(tuples(queries.op5_exact_dedup(spark, SMALL), *wanted.columns), wanted.fetchall())


def joined(r, names):
    return ",".join(f"{names(s)}:{s.start}:{s.end}" for s in r.spans)


def test_personal_data(odd, odd_rows, spark, given_rows):
    found = pii.personal_data(odd).collect()
    named = [",".join(f"{pii.KINDS[s.kind]}:{s.start}:{s.end}" for s in r.spans if s.kind < 4) for r in found]
    wanted = [(i, ",".join(f"{k}:{a}:{b}" for a, _, b, k in brute.spans(t, brute.PII))) for i, t, *_ in odd_rows]
    assert sorted(zip([r.doc_id for r in found], named, strict=True)) == sorted(wanted)
    counted = tuples(queries.op6_personal_data(spark, SMALL), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")
    same(counted, brute.found(texts(given_rows), brute.PII))


def check_packing(pieces, wanted, length):
    """``wanted``: (doc_id, ids) of every row. Pieces of rows with one id and equal ids are told apart by order only."""
    by_sequence, by_row = {}, {}
    for p in pieces:
        by_sequence.setdefault(p.sequence_id, []).append(p)
        by_row.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    short = 0
    for found in by_sequence.values():
        found.sort(key=lambda p: p.offset)
        assert [p.offset for p in found] == np.cumsum([0, *[p.length for p in found]])[:-1].tolist()
        total = sum(p.length for p in found)
        assert total <= length and total & (total - 1) == 0
        short += total < length
    rows = {}
    for doc_id, ids in wanted:
        rows.setdefault((doc_id, len(ids)), []).append(np.array(ids, "<u4"))
    assert rows.keys() == by_row.keys()
    for key, found in by_row.items():
        assert sum(p.length for p in found) == sum(map(len, rows[key]))
        for p in found:
            assert p.ids_crc32 in {zlib.crc32(ids[p.start : p.start + p.length].tobytes()) for ids in rows[key]}
    return short


def test_packing(odd, odd_rows, spark, given_rows):
    library = Tokenizer.from_file(WORDS)
    ids = lambda t: [*library.encode(t or "", add_special_tokens=False).ids, 1]
    wanted = [(i, ids(t)) for i, t, *_ in odd_rows]
    check_packing(packing.pack(odd, WORDS, 1, length=64, quantum=8).collect(), wanted, 64)
    found = packing.pack(odd, WORDS, 1, length=64, quantum=8, shard_bytes=20_000)
    rows = found.collect()
    assert len({r.sequence_id >> 32 for r in rows}) > 2
    check_packing(rows, wanted, 64)
    assert sum(len(r.ids) for r in rows) == 4 * sum(len(x) for _, x in wanted)
    check_packing(queries.op7_packing(spark, SMALL).collect(), [(i, ids(t)) for i, t, *_ in given_rows], 2048)


def test_quality_rules(odd, odd_rows, spark, given_rows):
    columns = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    same(tuples(quality.quality(odd), *columns), brute.quality(texts(odd_rows)))
    found = queries.op8_quality_rules(spark, SMALL)
    same(tuples(found, *columns), brute.quality(texts(given_rows)))
    assert found.filter("kept AND base_failed").count() == 0
    left = quality.with_quality(odd)
    assert left.columns == odd.columns and left.count() == quality.quality(odd).filter("kept").count()


def test_language_id(spark, sf_dir):
    langs = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{sf_dir}/documents.parquet'").fetchall())
    rows = queries.op9_language_id(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(langs) and np.mean([r.lang_pred == langs[r.doc_id] for r in held]) > 0.98


def test_secrets(odd, odd_rows, spark, given_rows):
    found = queries.op10_secrets(spark, SMALL)
    same(tuples(found, "doc_id", "n_assign", "n_access", "n_hex", "base_sha256"), brute.found(texts(given_rows), brute.SECRETS))
    found = [(r.doc_id, ",".join(f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind != "opaque")) for r in secret_scan.secrets(odd).collect()]
    assert sorted(found) == sorted((i, ",".join(f"{k}:{a}:{b}" for a, _, b, k in brute.spans(t, brute.SECRETS))) for i, t, *_ in odd_rows)


OPERATORS = {
    "substring": lambda df: substring.substring_dedup(df),
    "bpe": lambda df: bpe.decode_ids(bpe.encode_texts(df, RANKS), RANKS),
    "counts": lambda df: token_counts.token_counts(df, BYTES),
    "jaccard": lambda df: jaccard.near_duplicates(df),
    "dedup": lambda df: dedup.exact_dedup(df),
    "pii": lambda df: pii.personal_data(df),
    "sanitised": lambda df: pii.sanitised(df),
    "packing": lambda df: packing.pack(df, WORDS, 1),
    "quality": lambda df: quality.quality(df),
    "language": lambda df: langid.identified(df, langid.fit(df.selectExpr("doc_id AS key", "lang", "text").filter("lang IS NOT NULL AND text IS NOT NULL"))),
    "secrets": lambda df: secret_scan.secrets(df),
    "without secrets": lambda df: secret_scan.without_secrets(df),
    "without near duplicates": lambda df: jaccard.without_near_duplicates(df),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_bare_tables(bare, name):
    rows = OPERATORS[name](bare).collect()
    if name != "packing":
        assert len(rows) == bare.count()
    else:
        assert sum(r.length for r in rows) == sum(1 if r.text is None else 3 for r in bare.collect())
    if name == "language":
        assert all(r.lang_pred == "und" and r.score == 0 for r in rows)
    if name == "jaccard":
        assert all(r.component_id == r.doc_id for r in rows)
