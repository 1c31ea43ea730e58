"""An R-tree over count vectors, for finding sets that may overlap enough.

A set's elements are hashed into groups and counted; the counts are a point. What two sets share is at most the sum of the
smaller counts, group by group. The tree is packed by sorting and tiling; a node keeps the least and the greatest count of
each group below it, so that the same sum over the greatest counts bounds what any two sets below two nodes share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

# Two sets that differ in d elements each may seem to share d * d / GROUPS more than they do.
GROUPS = 256
LEAF = 16
FAN = 8
# Pairs of nodes or points that are bounded at once.
STEP = 1 << 14


def count_vector(hashes: np.ndarray) -> bytes:
    """The counts, in one, two or four bytes each, as the largest needs."""
    counts = _counts(hashes)
    return counts.astype(np.min_scalar_type(counts.max(initial=0))).tobytes()


def counts_of(vector: bytes) -> np.ndarray:
    return np.frombuffer(vector, f"<u{len(vector) // GROUPS}").astype(np.int32)


def _counts(hashes: np.ndarray) -> np.ndarray:
    return np.bincount((hashes & np.uint64(GROUPS - 1)).astype(np.int64), minlength=GROUPS)


def needed(size_a: np.ndarray, size_b: np.ndarray) -> np.ndarray:
    """The least overlap for which 100 * overlap >= 80 * union: 180 * overlap >= 80 * (a + b)."""
    return -(-80 * (size_a + size_b) // 180)


class Tree:
    """Levels from the leaves up: for each node, bounds of its points' counts and sizes, the range of its children, and its
    label, or -1 if there are several below it."""

    def __init__(self, points: np.ndarray, labels: np.ndarray):
        self.order = _tiled(points, np.arange(len(points)))
        self.points, self.labels = points[self.order], labels[self.order]
        self.sizes = self.points.sum(axis=1, dtype=np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]] = []
        high, small, large, label, fan = self.points, self.sizes, self.sizes, self.labels, LEAF
        while True:
            at = np.arange(0, len(high), fan)
            one = np.minimum.reduceat(label, at) == np.maximum.reduceat(label, at)
            high, small, large = np.maximum.reduceat(high, at), np.minimum.reduceat(small, at), np.maximum.reduceat(large, at)
            label = np.where(one & (label[at] >= 0), label[at], -1)
            self.levels.append((high, small, large, label, np.append(at, len(self.points) if not self.levels else len(self.levels[-1][0]))))
            if len(high) == 1:
                break
            fan = FAN

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Positions, in the order given, of all pairs of points with different labels whose bound suffices."""
        todo = [(len(self.levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
        while todo:
            level, a, b = todo.pop()
            if level < 0:
                keep = self._close(self.points, self.sizes, self.sizes, self.labels, a, b) & (a < b)
                if keep.any():
                    yield self.order[a[keep]], self.order[b[keep]]
                continue
            high, small, large, label, edges = self.levels[level]
            keep = self._close(high, small, large, label, a, b)
            a, b = a[keep], b[keep]
            fan = LEAF if level == 0 else FAN
            for low in range(0, len(a), max(1, STEP // fan**2)):
                x, y = a[low : low + max(1, STEP // fan**2)], b[low : low + max(1, STEP // fan**2)]
                left = edges[x][:, None, None] + np.arange(fan)[None, :, None] + np.zeros((1, 1, fan), np.int64)
                right = edges[y][:, None, None] + np.zeros((1, fan, 1), np.int64) + np.arange(fan)[None, None, :]
                there = (left < edges[x + 1][:, None, None]) & (right < edges[y + 1][:, None, None]) & (left <= right)
                todo.append((level - 1, left[there], right[there]))

    @staticmethod
    def _close(high: np.ndarray, small: np.ndarray, large: np.ndarray, label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        keep = (label[a] != label[b]) | (label[a] < 0)
        keep &= (100 * large[a] >= 80 * small[b]) & (100 * large[b] >= 80 * small[a])
        some = np.flatnonzero(keep)
        for low in range(0, len(some), STEP):
            part = some[low : low + STEP]
            x, y = a[part], b[part]
            keep[part] = np.minimum(high[x], high[y]).sum(axis=1) >= needed(small[x], small[y])
        return keep


def _tiled(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Rows so ordered that near points are near: cut at the median of the group that varies most, again and again."""
    out, todo = [], [rows]
    while todo:
        part = todo.pop()
        if len(part) <= LEAF:
            out.append(part)
            continue
        spread = points[part].var(axis=0)
        widest = int(spread.argmax())
        if spread[widest] == 0:
            out.append(part)
            continue
        part = part[np.argsort(points[part, widest], kind="stable")]
        # Leaves are filled in order, so that cuts fall between them.
        middle = max(LEAF, len(part) // 2 // LEAF * LEAF)
        todo += [part[middle:], part[:middle]]
    return np.concatenate(out) if out else rows
