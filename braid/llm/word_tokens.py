"""Token ids of texts by a ``tokenizers`` file, with every distinct word encoded once per worker.

Words are found, compared and counted as bytes: a word is known by 128 bits of hash, and the ids of all known words lie in one array.
Words of letters alone are merged in padded matrices (``bpe``), which is several times as fast as the library; the library
encodes all others.

Splitting at the blank, tab and line feed first is the same as encoding the whole text where the tokenizer drops white space
and nothing joins across it. ``TextEncoder`` is for such files only and says so for others. Null texts are empty and have no
ids; texts alike have the same ids.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa

from braid.llm.bpe import WIDTHS, PairTable, gathered, merged
from braid.llm.rolling import Block, blocks
from braid.llm.token_counts import shown_bytes

# Words kept per worker, and ids for each of them on average; beyond, the store starts anew. A word takes some 50 bytes.
MOST_WORDS = 400_000
MOST_IDS = 8

_BETWEEN = np.zeros(256, bool)
_BETWEEN[[0x20, 0x09, 0x0A]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
# Marks that neither begin a token that letters end, nor belong to special tokens.
_MARK = np.zeros(256, bool)
_MARK[list(b"!\"#$%&()*+,-./:;=?@[\\]^_`{}~")] = True


class TextEncoder:
    def __init__(self, path: str, end_id: int = 0):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        _check(spec)
        self.library = Tokenizer.from_file(path)
        vocabulary, shown = spec["model"]["vocab"], {byte: char for char, byte in shown_bytes().items()}
        # The tokens of single bytes, within a word and at its end; merges as left, right and rank, and what each makes.
        self.inner, self.last = (np.array([vocabulary[shown[b] + end] for b in range(256)], np.int32) for end in ("", "</w>"))
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in spec["model"]["merges"]]
        self.pairs = PairTable([(vocabulary[a], vocabulary[b], rank) for rank, (a, b) in enumerate(merges)])
        self.made = np.array([vocabulary[a + b] for a, b in merges], np.int32)
        self.end_id = end_id
        self.type = np.dtype("<u2" if max(self.library.get_vocab_size(), end_id + 1) <= 1 << 16 else "<u4")
        self.clear()

    def clear(self) -> None:
        # Hashes of known words, sorted by the first; the number of each; where the ids of each number start; all ids. Number 0
        # is the end token.
        self.hashes, self.checks, self.numbers = np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.edges, self.flat = np.array([0, 1]), np.array([self.end_id], self.type)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, without special tokens added."""
        return [ids[a:b] for _, ids, at in self.encode_blocks(pa.array(texts, pa.string())) for a, b in zip(at, at[1:])]

    def encode_blocks(self, column: pa.Array, ended: bool = False) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Block by block: the first row, the ids of its texts one after another, and where each text starts and the last one
        ends. ``ended`` puts the end token after each text."""
        for block in blocks(column, _BETWEEN):
            starts, ends, unit_at = _units(block)
            which = self._known(block.data, starts, ends)
            if ended:
                which = np.insert(which, unit_at[1:], 0)
                unit_at = unit_at + np.arange(len(unit_at))
            first, size = self.edges[which], self.edges[which + 1] - self.edges[which]
            yield block.first_row, gathered(self.flat, first, size), np.concatenate([[0], np.cumsum(size)])[unit_at]

    def _known(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """The number of every word, after learning those that are new."""
        low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
        hashed = lambda source, a, b: [Block(0, source, a, a, b, a).word_hashes(seed) for seed in (0, 1)]
        key, check = hashed(low, starts, ends)
        # A-Z means a-z where a word has nothing else than ASCII and no special token's start.
        odd, upper = (_count(flags, starts, ends) for flags in ((data >= 0x80) | (data == 0x3C), low != data))
        cased = np.flatnonzero((odd > 0) & (upper > 0))
        if len(cased):
            key[cased], check[cased] = hashed(data, starts[cased], ends[cased])
        distinct, first, word = np.unique(key, return_index=True, return_inverse=True)
        new = first[~self._has(distinct)]
        if len(self.hashes) and (len(self.hashes) + len(new) > MOST_WORDS or len(self.flat) > MOST_WORDS * MOST_IDS):
            self.clear()
            new = first
        if len(new):
            numbers = self._add(*self._encoded(data, low, starts[new], ends[new]))
            keys = np.concatenate([self.hashes, key[new]])
            order = np.argsort(keys, kind="stable")
            self.hashes, self.checks, self.numbers = keys[order], np.concatenate([self.checks, check[new]])[order], np.concatenate([self.numbers, numbers])[order]
        at = np.searchsorted(self.hashes, distinct)[word]
        which = self.numbers[at]
        # Two words of one hash, but not of two: the second is encoded, and not kept under it.
        other = np.flatnonzero(self.checks[at] != check)
        if len(other):
            which[other] = self._add(*self._encoded(data, low, starts[other], ends[other]))
        return which

    def _has(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.hashes, keys)
        return (at < len(self.hashes)) & (self.hashes[np.minimum(at, len(self.hashes) - 1)] == keys) if len(self.hashes) else np.zeros(len(keys), bool)

    def _add(self, sizes: np.ndarray, ids: np.ndarray) -> np.ndarray:
        numbers = np.arange(len(sizes)) + len(self.edges) - 1
        self.edges = np.concatenate([self.edges, len(self.flat) + np.cumsum(sizes)])
        self.flat = np.concatenate([self.flat, ids.astype(self.type)])
        return numbers

    def _encoded(self, data: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each word has, and all ids in order."""
        folded, plain = _plain(low, starts, ends)
        lengths, number, sizes, flat = ends - starts, [], [], []
        for least, width in zip((0, *WIDTHS), WIDTHS, strict=False):
            rows = np.flatnonzero(plain & (lengths > least) & (lengths <= width))
            if len(rows):
                letters = folded[np.minimum(starts[rows, None] + np.arange(width), len(folded) - 1)]
                every, end = np.arange(len(rows)), lengths[rows] - 1
                tokens = np.where(np.arange(width) <= end[:, None], self.inner[letters], np.int32(-1))
                tokens[every, end] = self.last[letters[every, end]]
                for done, n, ids in merged(tokens, self.pairs, self.made):
                    number.append(rows[done])
                    sizes.append(n)
                    flat.append(ids)
        rest = np.flatnonzero(~plain | (lengths > WIDTHS[-1]))
        texts = [data[a:b].tobytes().decode() for a, b in zip(starts[rest].tolist(), ends[rest].tolist(), strict=True)]
        found = [x.ids for x in self.library.encode_batch_fast(texts, add_special_tokens=False)]
        number.append(rest)
        sizes.append(np.fromiter(map(len, found), np.int64, len(found)))
        flat.append(np.fromiter(chain.from_iterable(found), np.int64, int(sizes[-1].sum())))
        number, sizes, flat = np.concatenate(number), np.concatenate(sizes), np.concatenate(flat)
        order = np.argsort(number)
        begin = np.cumsum(sizes) - sizes
        return sizes[order], gathered(flat, begin[order], sizes[order])


def _units(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of words, and the number of the first one of each text. Marks at the end of a word, after a letter, are a
    word of their own, as no token joins both."""
    data, starts, ends = block.data, block.starts, block.ends
    if not len(starts):
        return starts, ends, block.word_at
    # The byte after the last one that is no such mark, and whether a letter, up to U+00FF, stands before it.
    cut = np.maximum.accumulate(np.where(_MARK[data], 0, np.arange(len(data))))[ends - 1] + 1
    before, lead = data[cut - 1], data[np.maximum(cut - 2, 0)]
    letter = _LETTER[before] | (lead == 0xC3) & (before >= 0x80) & (before <= 0xBF) & (before != 0x97) & (before != 0xB7)
    marked = (cut < ends) & (cut > starts) & letter
    parts = 1 + marked
    word = np.repeat(np.arange(len(starts)), parts)
    first = np.concatenate([[0], np.cumsum(parts)])
    mark = np.arange(len(word)) > first[word]
    return np.where(mark, cut[word], starts[word]), np.where(marked[word] & ~mark, cut[word], ends[word]), first[block.word_at]


def _count(flags: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int32 if len(flags) < 1 << 31 else np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[ends] - sums[starts]


def _plain(low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in lower case, as far as U+00FF, and which words have nothing but letters up to there; for these the tokenizer's
    normal form and lower case cannot differ from this."""
    after_lead, lead = np.zeros(len(low), bool), np.zeros(len(low), bool)
    after_lead[1:] = low[:-1] == 0xC3
    second = after_lead & (low >= 0x80) & (low <= 0xBF) & (low != 0x97) & (low != 0xB7)
    lead[:-1] = second[1:]
    folded = np.where(second & (low <= 0x9E), low + 32, low).astype(np.uint8)
    return folded, _count(~((low >= 97) & (low <= 122) | second | lead), starts, ends) == 0


def _check(file: dict) -> None:
    """Refuse files for which words are not encoded alone."""
    steps = (file.get("pre_tokenizer") or {}).get("pretokenizers") or [file.get("pre_tokenizer") or {}]
    first = steps[0]
    if first.get("type") != "Split" or not first.get("invert") or any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in file["added_tokens"]):
        raise ValueError("this tokenizer does not encode words one by one")
    if file["model"].get("end_of_word_suffix") != "</w>" or steps[-1].get("type") != "ByteLevel" or file["model"].get("ignore_merges"):
        raise ValueError("only byte-level merges with word ends are known")
    if {"type": "Lowercase"} not in ((file.get("normalizer") or {}).get("normalizers") or []):
        raise ValueError("this tokenizer does not lower the case")
