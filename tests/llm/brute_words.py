"""Plain versions of what the spelling operator returns."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict


def vocabulary(docs):
    found = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 5 and n >= 3}


def near(words):
    """Pairs one edit apart, by all ways to leave out one letter."""
    gaps, out = defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            gaps[w[:i], w[i + 1 :]].add(w)
            if w[:i] + w[i + 1 :] in words:
                out[w].add(w[:i] + w[i + 1 :])
                out[w[:i] + w[i + 1 :]].add(w)
    for group in gaps.values():
        for w in group:
            out[w] |= group - {w}
    return out


def variants(docs):
    n = vocabulary(docs)
    links = near(n.keys())
    form = {}
    for w in n:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        yield w, form[w], root, n[w], len(links[w]), n[form[w]] if form[w] else None
