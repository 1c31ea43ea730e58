"""Plain, slow versions of what the operators return, straight from their contracts: one text, or all texts, at a time."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = "\x20\x09-\x0d"


SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, id string, row int, chunk string, kept string, n string"


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with more columns whose names the operators use themselves."""
    full = [(i, t, lang, src, None if t is None else len(t), "x", 7, "y", "z", None) for i, t, lang, src in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def sha(text) -> str:
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


def words(text: str | None) -> list[str]:
    return re.findall(rf"[^{SPACE}]+", text or "")


def fold(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def substring_dedup(docs, size=35):
    seen = Counter(tuple(w[i : i + size]) for w in (words(t) for _, t in docs) for i in range(len(w) - size + 1))
    for doc_id, text in docs:
        w = words(text)
        gone = {j for i in range(len(w) - size + 1) if seen[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        yield doc_id, len(w), len(gone), sha(" ".join(x for j, x in enumerate(w) if j not in gone))


def jaccard(docs, size=5):
    sets = []
    for _, text in docs:
        w = words(fold(text))
        sets.append({tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            holders[x].append(i)
    shared = Counter()
    for held in holders.values():
        for a in range(len(held)):
            for b in range(a):
                shared[held[b], held[a]] += 1
    for (a, b), n in shared.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            root[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return [(doc_id, len(sets[i]), least[find(i)]) for i, (doc_id, _) in enumerate(docs)]


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits)))
    return total % 10 == 0


def digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


PII = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda x: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda x: all(int(p) <= 255 for p in x.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda x: 12 <= len(digits(x)) <= 19 and luhn(digits(x))),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda x: 9 <= len(digits(x)) <= 15),
}
SECRETS = {
    "assign": (r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", None),
    "access": (r"AKIA[A-Z0-9]+", lambda x: len(x) >= 20),
    "hex": (r"[0-9a-f]+", lambda x: len(x) >= 24),
}


def spans(text, patterns):
    out = []
    for number, (kind, (pattern, good)) in enumerate(patterns.items()):
        for m in re.finditer(pattern, text or ""):
            if good(m[0]) if good else len(m[2]) >= 6:
                out.append((m.start(), number, m.end(), kind))
    return sorted(out)


def found(docs, patterns):
    for doc_id, text in docs:
        s = spans(text, patterns)
        counts = Counter(x[3] for x in s)
        yield doc_id, *[counts[k] for k in patterns], sha(",".join(f"{k}:{a}:{b}" for a, _, b, k in s))


def quality(docs):
    for doc_id, text in docs:
        w, seen, dup = words(text), set(), 0
        for line in (text or "").split("\n"):
            if words(line):
                dup += line in seen
                seen.add(line)
        at = defaultdict(list)
        for i in range(len(w) - 4):
            at[tuple(w[i : i + 5])].append(i)
        repeat = len({j for found in at.values() if len(found) > 1 for i in found for j in range(i, i + 5)})
        symbols = len(re.findall(r"[#*$%&|<>]", text or ""))
        yield doc_id, len(w), sum(map(len, w)), symbols, dup, repeat, len(w) < 10 or 100 * repeat > 20 * len(w)
