"""Where the pieces start into which byte-level BPE cuts a text before it merges, found by a compiled transducer.

The pattern of the rank files (contractions, then letters, numbers or other characters with a blank before them, then white
space) is compiled into a deterministic transducer over character classes. Each transition says whether a piece starts at the
character read, and whether one started at the character before, which shows only now. A long stream is cut into chunks; each
chunk's map from states to states is worked out for all chunks at once, the maps are composed by a parallel prefix scan, and
with every chunk's first state known all chunks run side by side.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import regex

# Character classes. The letters of contractions are classes of their own.
SPACE, BLANK, LETTER, NUMBER, OTHER, QUOTE, STMD, R, V, L, E, END = range(12)
# What a state has read: nothing open; letters; numbers; others; one blank space; one other white space; several of them, the
# last a blank or another; a quote that opens a piece; the same and r, v or l.
FRESH, LETTERS, NUMBERS, OTHERS, ONE_SPACE, ONE_BLANK, SPACES, BLANKS, QUOTED, QUOTED_R, QUOTED_V, QUOTED_L = range(12)
HERE, BEFORE = 1, 2
CHUNK = 256


def _compiled() -> tuple[np.ndarray, np.ndarray]:
    """Next state and piece starts for every state and class."""
    opens = {SPACE: ONE_SPACE, BLANK: ONE_BLANK, LETTER: LETTERS, NUMBER: NUMBERS, OTHER: OTHERS, QUOTE: QUOTED, END: FRESH}
    opens |= dict.fromkeys((STMD, R, V, L, E), LETTERS)
    state, starts = np.zeros((12, 12), np.uint8), np.full((12, 12), HERE, np.uint8)
    for now in range(12):
        for c in range(12):
            state[now, c] = opens[c]

    def goes_on(now: int, classes: tuple[int, ...], to: int, emits: int = 0) -> None:
        for c in classes:
            state[now, c], starts[now, c] = to, emits

    letters, others = (LETTER, STMD, R, V, L, E), (OTHER, QUOTE)
    goes_on(LETTERS, letters, LETTERS)
    goes_on(NUMBERS, (NUMBER,), NUMBERS)
    goes_on(OTHERS, others, OTHERS)
    for now, emits in ((ONE_SPACE, 0), (SPACES, BEFORE)):
        goes_on(now, letters, LETTERS, emits)
        goes_on(now, (NUMBER,), NUMBERS, emits)
        goes_on(now, others, OTHERS, emits)
    for now in (ONE_SPACE, ONE_BLANK, SPACES, BLANKS):
        goes_on(now, (SPACE,), SPACES)
        goes_on(now, (BLANK,), BLANKS)
    for c in (*letters, *others, NUMBER):
        starts[BLANKS, c] |= BEFORE
    goes_on(QUOTED, others, OTHERS)
    goes_on(QUOTED, (STMD,), FRESH)
    for c, to, last in ((R, QUOTED_R, E), (V, QUOTED_V, E), (L, QUOTED_L, L)):
        goes_on(QUOTED, (c,), to)
        starts[to] |= BEFORE
        goes_on(to, letters, LETTERS, BEFORE)
        goes_on(to, (last,), FRESH)
    return state, starts


STATE, STARTS = _compiled()
_classes: list[np.ndarray] = []


def classes(points: np.ndarray) -> np.ndarray:
    """The class of each code point."""
    if not _classes:
        _classes.append(_class_table())
    return _classes[0][points]


def _class_table() -> np.ndarray:
    table = np.full(0x110000, OTHER, np.uint8)
    unknown = []
    letter_or_number = regex.compile(r"[\p{L}\p{N}]")
    for point in range(0x110000):
        kind = unicodedata.category(chr(point))
        if kind[0] in "LN":
            table[point] = LETTER if kind[0] == "L" else NUMBER
        elif kind == "Cn" and letter_or_number.match(chr(point)):
            unknown.append(point)
    # Python's tables are older than the tokenizers', which decide about characters that came in between.
    from tokenizers.pre_tokenizers import ByteLevel

    library = ByteLevel(add_prefix_space=False)
    for point in unknown:
        for before, kind in (("a", LETTER), ("1", NUMBER)):
            if len(library.pre_tokenize_str(before + chr(point))) == 1:
                table[point] = kind
    table[[*range(9, 14), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]] = BLANK
    for chars, kind in ((" ", SPACE), ("'", QUOTE), ("stmd", STMD), ("r", R), ("v", V), ("l", L), ("e", E)):
        table[[ord(c) for c in chars]] = kind
    return table


def piece_starts(stream: np.ndarray) -> np.ndarray:
    """Whether a piece starts at each character of a stream of classes. ``END`` stands between texts and after the last."""
    n = len(stream)
    chunks = -(-n // CHUNK)
    padded = np.full(chunks * CHUNK, END, np.uint8)
    padded[:n] = stream
    steps = np.ascontiguousarray(padded.reshape(chunks, CHUNK).T)
    flat = STATE.ravel().astype(np.intp)
    # Every chunk's map, from each state it may begin in.
    maps = np.repeat(np.arange(12, dtype=np.intp)[:, None], chunks, axis=1)
    for step in steps:
        maps = flat[maps * 12 + step]
    maps = maps.T
    reach = 1
    while reach < chunks:
        joined = maps.copy()
        joined[reach:] = np.take_along_axis(maps[reach:], maps[:-reach], axis=1)
        maps, reach = joined, 2 * reach
    state = np.full(chunks, FRESH, np.intp)
    state[1:] = maps[:-1, FRESH]
    emits, flat_emits = np.empty((CHUNK, chunks), np.uint8), STARTS.ravel()
    for k, step in enumerate(steps):
        at = state * 12 + step
        emits[k] = flat_emits[at]
        state = flat[at]
    emits = emits.T.ravel()[:n]
    starts = (emits & HERE).astype(bool)
    starts[:-1] |= (emits[1:] & BEFORE).astype(bool)
    return starts


def split_texts(texts: list[str]) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes with a zero byte after each, where in them each piece starts (the zero bytes count as pieces,
    and one more entry gives the end), and the number of pieces, zero bytes left out, of each text."""
    joined = "".join(f"{text}\0" for text in texts)
    points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    last = np.cumsum(sizes + 1) - 1
    stream = classes(points)
    stream[last] = END
    starts = piece_starts(stream)
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    at = np.concatenate([[0], np.cumsum(width)])
    places = np.flatnonzero(starts)
    per_text = np.diff(np.searchsorted(places, np.append(0, last + 1))) - 1
    return joined.encode("utf-8", "surrogatepass"), np.append(at[places], at[-1]), per_text
