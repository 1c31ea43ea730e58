"""Personal data, and the terms that give it away.

Four fixed patterns find e-mail and IP addresses, payment cards and phone numbers. Co-occurrence in the whole corpus then says
how strongly a term near such a value reveals it: of the documents that hold the term, the share in which it stands near that
one value, and the bits of information that this is above the value's own frequency. Each occurrence of a term beyond both
thresholds is a span of the kind ``term``, in every text, near a value or not, unless it lies within a fixed pattern's span. Documents of equal text count once, and so do contexts that are copies of one another, on both sides of the
share: a copied document is no evidence, neither for a term nor against it.

Spans are in code points, the end exclusive. A term is a run of letters and digits (every byte beyond ASCII counts as one),
A-Z taken for a-z. Null text is empty. Repeated rows are reported each. Without rows, or without personal data, there are no
terms.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from braid.llm.rolling import blocks, buffers
from braid.shared import written

KINDS = ("email", "ip", "card", "phone", "term")
# The patterns of the contract.
# Characters before an e-mail address's "@", and what follows them.
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# No match starts within a run of digits, for one that starts where the run does comes first.
_IP = re.compile(r"(?<![0-9])[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

NEAR_TERMS = 8
# A term has to stand near a value in so many different contexts, and nearly nowhere else.
LEAST_CONTEXTS = 3
LEAST_SHARE = 0.5
LEAST_BITS = 4.0
# The filter that spares counting most terms has this many bits whatever the size of the data.
FILTER_BITS = 20

_BETWEEN = np.array([x < 128 and not chr(x).isalnum() for x in range(256)])
_TERM = re.compile(r"[0-9A-Za-z\u0080-\U0010ffff]{3,}")
_NEAR = "digest binary, near array<struct<entity:bigint,term:bigint,context:bigint>>"
_FOUND = "row bigint, id {id}, digest binary, base array<struct<start:int,kind:int,end:int>>, terms array<struct<term:bigint,start:int,end:int>>"


def _luhn(digits: str) -> bool:
    doubled = "0246813579"
    return sum(int(d if i % 2 == 0 else doubled[int(d)]) for i, d in enumerate(reversed(digits))) % 10 == 0


def find(text: str) -> list[tuple[int, int, int]]:
    """Start, kind number and end of each span that the fixed patterns find."""
    out, last, sign = [], 0, text.find("@")
    while sign >= 0:
        start = last + len(text[last:sign].rstrip(_LOCAL))
        last = sign + 1
        if start < sign and (m := _DOMAIN.match(text, sign)):
            out.append((start, 0, m.end()))
            last = m.end()
        sign = text.find("@", last)
    for m in _IP.finditer(text):
        if all(len(part) <= 3 and int(part) <= 255 for part in (x.lstrip("0") or "0" for x in m[0].split("."))):
            out.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = re.sub("[ -]", "", m[0]) if len(m[0]) <= 64 else ""
        if 12 <= len(digits) <= 19 and _luhn(digits):
            out.append((m.start(), 2, m.end()))
    if "+" in text:
        out += [(m.start(), 3, m.end()) for m in _PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def _hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) - (1 << 63)


def _term_hashes(terms: list[str]) -> list[int]:
    if not terms:
        return []
    return [int(x) for block in blocks(pa.array(terms), _BETWEEN) for x in block.word_hashes(fold=True).view(np.int64)]


def near_terms(text: str, spans: list[tuple[int, int, int]]) -> list[dict]:
    """The terms beside each span: which value, which term, and a hash of the whole context."""
    terms = [m for m in _TERM.finditer(text) if not m[0].isdecimal()]
    starts = np.array([m.start() for m in terms], np.int64)
    ends = np.array([m.end() for m in terms], np.int64)
    free = np.ones(len(terms), bool)
    for start, _, end in spans:
        free[np.searchsorted(ends, start, "right") : np.searchsorted(starts, end)] = False
    hashes, out = _term_hashes([m[0] for m in terms]), []
    for start, kind, end in spans:
        left, right = int(np.searchsorted(ends, start, "right")), int(np.searchsorted(starts, end))
        beside = [i for i in [*range(max(0, left - NEAR_TERMS), left), *range(right, min(len(terms), right + NEAR_TERMS))] if free[i]]
        value = text[start:end].lower() if kind < 2 else re.sub("[^0-9]", "", text[start:end])
        entity, context = _hash(f"{kind}:{value}"), _hash(" ".join(str(hashes[i]) for i in beside))
        out += [{"entity": entity, "term": hashes[i], "context": context} for i in beside]
    return out


def _texts(column: pa.Array) -> Iterator[tuple[bytes, list[tuple[int, int, int]]]]:
    """Each text's bytes and the spans that the fixed patterns find in it."""
    data, at = buffers(column)
    # Every pattern needs a digit or an at sign; most texts have neither and need no further look.
    hints = np.flatnonzero(((data >= 48) & (data <= 57)) | (data == 64))
    some = np.searchsorted(hints, at[1:]) > np.searchsorted(hints, at[:-1])
    for has, low, high in zip(some, at[:-1], at[1:], strict=True):
        raw = data[low:high].tobytes()
        yield raw, find(raw.decode()) if has else []


def contexts(docs: DataFrame, text_col: str) -> DataFrame:
    """Per row: a digest of the text, and the terms near the fixed patterns' spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near_type = pa.list_(pa.struct([("entity", pa.int64()), ("term", pa.int64()), ("context", pa.int64())]))
        for batch in batches:
            near, digests = [], []
            for raw, spans in _texts(batch.column(0)):
                near.append(near_terms(raw.decode(), spans) if spans else [])
                digests.append(xxhash.xxh3_128_digest(raw))
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(near, near_type)], names=["digest", "near"])

    return docs.select(text_col).mapInArrow(run, _NEAR)


def scanned(docs: DataFrame, id_col: str, text_col: str, wanted: np.ndarray) -> DataFrame:
    """Per row: a row number, the id, a digest of the text, the fixed patterns' spans, and where terms stand outside of these
    whose hash is in the filter ``wanted``."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spans_type = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
        terms_type = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            base, digests, terms = [], [], [[] for _ in range(len(batch))]
            for raw, spans in _texts(batch.column("text")):
                base.append([{"start": a, "kind": k, "end": b} for a, k, b in spans])
                digests.append(xxhash.xxh3_128_digest(raw))
            for row, term, start, end in _occurrences(batch.column("text"), wanted):
                if not any(x["start"] <= start and end <= x["end"] for x in base[row]):
                    terms[row].append({"term": term, "start": start, "end": end})
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("id"), pa.array(digests, pa.binary()), pa.array(base, spans_type), pa.array(terms, terms_type)],
                names=["row", "id", "digest", "base", "terms"],
            )

    return rows.mapInArrow(run, _FOUND.format(id=rows.schema["id"].dataType.simpleString()))


def _occurrences(column: pa.Array, wanted: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Row, hash, start and end in code points of each term whose hash is in the filter."""
    if not wanted.any():
        return
    for block in blocks(column, _BETWEEN):
        hashes = block.word_hashes(fold=True)
        hits = np.flatnonzero(wanted[_buckets(hashes)])
        row = np.searchsorted(block.word_at, hits, "right") - 1
        # Code points are the bytes that do not continue one.
        points = np.concatenate([[0], np.cumsum(block.data >> 6 != 2)])
        first = points[block.text_at[row]]
        found = (block.first_row + row, hashes[hits].view(np.int64), points[block.starts[hits]] - first, points[block.ends[hits]] - first)
        yield from zip(*[x.tolist() for x in found], strict=True)


def _bucket() -> Column:
    return F.shiftrightunsigned("term", 64 - FILTER_BITS).cast("int").alias("bucket")


def _buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _capped(pairs: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a term and a text, each once, of the terms that no more texts hold than ``most`` allows; and the other terms."""
    pairs = np.unique(pairs)
    terms, which, n = np.unique(pairs["term"], return_inverse=True, return_counts=True)
    over = n > most[_buckets(terms)]
    return pairs[~over[which]], terms[over]


def _documents_with(docs: DataFrame, text_col: str, most: np.ndarray) -> DataFrame:
    """Over all distinct texts, the number that hold each term. ``most`` has a number for each bucket of hashes; terms that
    more texts hold are left out, so that a frequent term is one row a block and not one for each text."""
    kind = np.dtype([("term", np.uint64), ("text", np.uint64)])
    shared = docs.sparkSession.sparkContext.broadcast(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = shared.value
        for batch in batches:
            kept, frequent = [np.zeros(0, kind)], [np.zeros(0, np.uint64)]
            for block in blocks(batch.column(0), _BETWEEN):
                hashes = block.word_hashes(fold=True)
                hits = np.flatnonzero(most[_buckets(hashes)])
                row = np.searchsorted(block.word_at, hits, "right") - 1
                texts = np.zeros(len(block.text_at) - 1, np.uint64)
                for i in np.unique(row):
                    texts[i] = xxhash.xxh3_64_intdigest(block.data[block.text_at[i] : block.text_at[i + 1]].tobytes())
                pairs = np.zeros(len(hits), kind)
                pairs["term"], pairs["text"] = hashes[hits], texts[row]
                few, many = _capped(pairs, most)
                kept.append(few)
                frequent.append(many)
            few, many = _capped(np.concatenate(kept), most)
            many = np.unique(np.concatenate([*frequent, many]))
            few = few[~np.isin(few["term"], many)]
            terms = np.concatenate([few["term"], many]).view(np.int64)
            # Frequent terms have no text.
            texts = pa.array(np.concatenate([few["text"], np.zeros(len(many), np.uint64)]).view(np.int64), mask=np.arange(len(terms)) >= len(few))
            yield pa.RecordBatch.from_arrays([pa.array(terms), texts], names=["term", "text"])

    pairs = docs.select(text_col).mapInArrow(run, "term bigint, text bigint").distinct()
    return pairs.groupBy("term").agg(F.count("text").alias("df"), F.count("*").alias("n")).filter("df = n").drop("n")


def disclosing(found: DataFrame, docs: DataFrame, text_col: str, least_contexts: int, least_share: float, least_bits: float) -> DataFrame:
    """Pairs of a value and a term that reveals it, with the number of contexts, the share and the bits.

    Everything is counted over distinct texts. Of these, the ones with the term near the value count by their distinct contexts.
    """
    near = found.select("digest", F.explode("near").alias("x")).select("digest", "x.entity", "x.term", "x.context")
    apart = near.select("entity", "term", "context").distinct().groupBy("entity", "term").agg(F.count("*").alias("contexts"))
    beside = near.select("entity", "term", "digest").distinct().groupBy("entity", "term").agg(F.count("*").alias("beside"))
    pairs = written(apart.filter(F.col("contexts") >= least_contexts).join(beside, ["entity", "term"]), "near_terms")
    holders = near.select("digest", "entity").distinct().groupBy("entity").agg(F.count("*").alias("holders"))
    # In more texts than these, a term's share falls short with every value.
    most = np.zeros(1 << FILTER_BITS, np.int32)
    limit = F.col("beside") + F.col("contexts") * (1 / least_share - 1) + 1 if least_share > 0 else F.lit(2.0**31)
    # At most 2^FILTER_BITS numbers come to the driver, and that many go out, however many terms there are.
    limits = pairs.groupBy(_bucket()).agg(F.max(F.least(limit, F.lit(2.0**31 - 1))).cast("int").alias("most")).toArrow()
    most[limits["bucket"].to_numpy()] = limits["most"].to_numpy()
    total = found.select("digest").distinct().count()
    out = pairs.join(_documents_with(docs, text_col, most), "term").join(holders, "entity")
    share = F.col("contexts") / (F.col("contexts") + F.col("df") - F.col("beside"))
    bits = F.log2(share / (F.col("holders") / F.lit(max(total, 1))))
    return out.select("entity", "term", "contexts", share.alias("share"), bits.alias("bits")).filter((F.col("share") >= least_share) & (F.col("bits") >= least_bits))


def _with_terms(docs: DataFrame, id_col: str, text_col: str, least_contexts: int, least_share: float, least_bits: float) -> DataFrame:
    near = written(contexts(docs, text_col), "contexts")
    terms = written(disclosing(near, docs, text_col, least_contexts, least_share, least_bits).select("term").distinct(), "terms")
    wanted = np.zeros(1 << FILTER_BITS, bool)
    wanted[terms.select(_bucket()).distinct().toArrow()["bucket"].to_numpy()] = True
    found = written(scanned(docs, id_col, text_col, wanted), "personal")
    # The filter lets some other terms through; the join does not.
    each = found.select("row", F.explode("terms").alias("x")).select("row", "x.term", "x.start", "x.end").join(terms, "term")
    span = F.struct("start", F.lit(4).alias("kind"), "end")
    each = each.groupBy("row").agg(F.collect_list(span).alias("more"))
    spans = F.when(F.col("more").isNull(), F.col("base")).otherwise(F.array_sort(F.concat("base", "more")))
    return found.drop("terms").join(each, "row", "left").select("id", "digest", spans.alias("spans"))


def personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_contexts: int = LEAST_CONTEXTS, least_share: float = LEAST_SHARE, least_bits: float = LEAST_BITS,
) -> DataFrame:
    """One row per row of ``docs``: its id and ``spans``, an array of start, kind (a number into ``KINDS``) and end."""
    return _with_terms(docs, id_col, text_col, least_contexts, least_share, least_bits).select(F.col("id").alias(id_col), "spans")


def sanitised(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    least_contexts: int = LEAST_CONTEXTS, least_share: float = LEAST_SHARE, least_bits: float = LEAST_BITS,
) -> DataFrame:
    """``docs`` with personal values generalised to their kind, as ``<EMAIL>``, and disclosing terms removed.

    Equal texts have equal spans, so that texts meet their spans by a digest; texts without any span stay as they are.
    """
    found = _with_terms(docs, id_col, text_col, least_contexts, least_share, least_bits)
    spans = found.filter(F.size("spans") > 0).groupBy(F.col("digest").alias("_digest")).agg(F.first("spans").alias("_spans"))
    place, schema = docs.columns.index(text_col), docs.schema

    digests = F.pandas_udf(_series_digest, "binary")
    rows = docs.join(spans, digests(F.col(f"`{text_col}`")) == F.col("_digest"), "left").drop("_digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [
                _replaced(text, [(s["start"], s["kind"], s["end"]) for s in spans]) if spans else text
                for text, spans in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True)
            ]
            columns = batch.columns[:-1]
            columns[place] = pa.array(texts, batch.column(place).type)
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names[:-1])

    return rows.mapInArrow(run, schema)


def _series_digest(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: xxhash.xxh3_128_digest((text or "").encode()))


def _replaced(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, at = [], 0
    for start, kind, end in spans:
        if start >= at:
            out += [text[at:start], "" if kind == 4 else f"<{KINDS[kind].upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])
