"""Token counts of byte-level BPE by finite-state transducers.

Two deterministic transducers are compiled from a ``tokenizers`` file. The first, over characters, finds where pieces start;
text is cut into chunks, whose state maps are composed by a parallel prefix scan (``pieces``). The second reads a piece byte by
byte, and its transitions carry the number of tokens that the bytes read so far would have, less the number before. A piece's
count is the sum along its path.

The second rests on two facts about merging by rank: a row of tokens is what a text encodes to just when each two neighbours
encode to themselves, and so every prefix of a text has one last token. A state holds the starts from which a token may still
grow: the bytes since as a place in the tree of all tokens, the last token before, and the count up to there. Tokens have a
greatest length, so there are finitely many states; those that the data reach are compiled when they are first met.

Strings of special tokens count as one token each, as in the library's default. Null text is empty.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from braid.llm.pieces import split_texts
from braid.llm.rolling import slices

# Bounds of a worker's memory: compiled transitions, and pieces whose counts are kept. Beyond its bound each starts anew.
MOST_TRANSITIONS = 250_000
MOST_PIECES = 400_000


class Transducer:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, before = spec["model"], spec["pre_tokenizer"]
        plain = not (spec.get("normalizer") or model.get("ignore_merges") or model.get("end_of_word_suffix") or model.get("continuing_subword_prefix") or model.get("dropout"))
        if model["type"] != "BPE" or before["type"] != "ByteLevel" or before["add_prefix_space"] or not before["use_regex"] or not plain:
            raise ValueError("only plain byte-level BPE files can be compiled")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("special tokens have to be plain strings")
        self.specials = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        shown = shown_bytes()
        self.tokens = {bytes(shown[c] for c in token): i for token, i in model["vocab"].items() if all(c in shown for c in token)}
        spelled = {i: token for token, i in self.tokens.items()}
        pairs = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        # rank, left, right and result of each merge, by ids.
        self.merges = {(model["vocab"][a], model["vocab"][b]): (rank, model["vocab"][a + b]) for rank, (a, b) in enumerate(pairs)}
        self.parts = {result: pair for pair, (_, result) in reversed(self.merges.items())}
        self.rank_of = {result: rank for rank, result in self.merges.values()}
        # The tree of all tokens: children by byte, and the token that ends at a node.
        self.children: list[dict[int, int]] = [{}]
        self.token_at: list[int] = [-1]
        for token in sorted(spelled.values()):
            node = 0
            for byte in token:
                if byte not in self.children[node]:
                    self.children[node][byte] = len(self.children)
                    self.children.append({})
                    self.token_at.append(-1)
                node = self.children[node][byte]
            self.token_at[node] = self.tokens[token]
        self.counts: dict[bytes, int] = {}
        self.forget()

    def forget(self) -> None:
        start = ((0, -1, 0),)
        self.state_of: dict[tuple, int] = {start: 0}
        self.states: list[tuple] = [start]
        # State and byte in one number, to next state and tokens added.
        self.next: dict[int, tuple[int, int]] = {}
        self._fits: dict[tuple[int, int], bool] = {}

    def fits(self, left: int, right: int) -> bool:
        """Whether the two tokens side by side encode to themselves: no merge across the border comes before those that make
        them, going back through the parts on both sides of it."""
        known = self._fits.get((left, right))
        if known is None:
            known = self._fits[left, right] = self._fit(left, right)
        return known

    def _fit(self, a: int, b: int) -> bool:
        limit = 1 << 62
        while True:
            crossing = self.merges.get((a, b))
            if crossing is not None and crossing[0] < limit:
                return False
            made_a, made_b = self.rank_of.get(a, -1), self.rank_of.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            # The later of the two was made last: before that, its near part stood at the border. Of merges of one rank the
            # leftmost comes first, and one across the border lies to the right of the left token and to the left of the right.
            if made_a > made_b:
                limit, a = made_a, self.parts[a][1]
            else:
                limit, b = made_b + 1, self.parts[b][0]

    def _step(self, state: int, byte: int) -> tuple[int, int]:
        grown, last, count = [], -1, 0
        for node, token, n in self.states[state]:
            child = self.children[node].get(byte)
            if child is None:
                continue
            grown.append((child, token, n))
            ends = self.token_at[child]
            if ends >= 0 and last < 0 and (token < 0 or self.fits(token, ends)):
                last, count = ends, n + 1
        alive = tuple((node, token, n - count) for node, token, n in grown if self.children[node]) + ((0, last, 0),)
        number = self.state_of.get(alive)
        if number is None:
            number = self.state_of[alive] = len(self.states)
            self.states.append(alive)
        found = self.next[state << 8 | byte] = (number, count)
        return found

    def count_piece(self, piece: bytes) -> int:
        state, total, known = 0, 0, self.next
        for byte in piece:
            state, added = known.get(state << 8 | byte) or self._step(state, byte)
            total += added
        return total

    def count(self, texts: list[str]) -> np.ndarray:
        """The number of tokens of each text."""
        parts, owner, special = [], [], np.zeros(len(texts), np.int64)
        for i, text in enumerate(texts):
            found = [text]
            for token in self.specials:
                if token in text:
                    found = [piece for x in found for piece in x.split(token)]
            special[i] = len(found) - 1
            parts += found
            owner += [i] * len(found)
        data, starts, per_part = split_texts(parts)
        pieces = [data[a:b] for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
        if len(self.next) > MOST_TRANSITIONS:
            self.forget()
        if len(self.counts) > MOST_PIECES:
            self.counts = {}
        known = self.counts
        for piece in set(pieces).difference(known):
            known[piece] = self.count_piece(piece)
        counts = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
        # The zero byte after each part is a piece that does not count.
        ends = np.cumsum(per_part + 1)
        counts[ends - 1] = 0
        sums = np.concatenate([[0], np.cumsum(counts)])
        return special + np.bincount(np.array(owner, np.int64), sums[ends] - sums[ends - per_part - 1], len(texts)).astype(np.int64)


def shown_bytes() -> dict[str, int]:
    """How byte-level vocabularies spell bytes: printable ones as themselves, the others by the characters from 256 on."""
    kept = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    moved = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(moved)}


@cache
def transducer(path: str) -> Transducer:
    return Transducer(path)


def token_counts(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes`` and ``n_tokens`` of its text by the file at ``path``."""
    rows = docs.select(F.col(id_col).alias("id"), F.octet_length(F.coalesce(F.col(text_col), F.lit(""))).cast("long").alias("n_bytes"), F.col(text_col).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                n = transducer(path).count(part.column("text").fill_null("").to_pylist())
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("n_bytes"), pa.array(n)], names=["id", "n_bytes", "n_tokens"])

    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"id {kind}, n_bytes bigint, n_tokens bigint").withColumnRenamed("id", id_col)
