"""Counting of short sequences of word numbers in bounded memory.

A HAT-trie: inner nodes lead on by word number; below them stand hash
containers.  A container first covers a range of next words.  When it holds
more than ``BURST`` sequences its range is cut in two, and when the range is a
single word it bursts into a node for the words after that.  When the whole
holds more than ``limit`` sequences, the largest subtrees of the root are handed
out as sorted runs and forgotten, so one sequence may stand in several runs.

Sequences are rows of a matrix, shorter ones filled up with -1.  Everything
works on sorted batches; no step goes over single sequences in Python.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

BURST = 32_768
LAST = np.iinfo(np.int32).max - 1  # largest word number


def packed(rows: np.ndarray) -> list[np.ndarray]:
    """Columns of 64-bit numbers, two words in each, that order like the rows."""
    shifted = rows.astype(np.int64) + 1
    return [
        (shifted[:, c] << 32) | shifted[:, c + 1] if c + 1 < rows.shape[1] else shifted[:, c] << 32
        for c in range(0, rows.shape[1], 2)
    ]


def summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows in order, and the sums of their counts."""
    if not len(rows):
        return rows, counts
    keys = packed(rows)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(rows), bool)
    new[0] = True
    for k in keys:
        new[1:] |= np.diff(k[order]) != 0
    at = np.flatnonzero(new)
    return rows[order[at]], np.add.reduceat(counts[order], at)


class Container:
    """Open addressing over packed rows; ``low`` to ``high`` are the words it covers at its level."""

    def __init__(self, low: int, high: int, columns: int, slots: int = 64):
        self.low, self.high, self.n = low, high, 0
        self.keys = [np.zeros(slots, np.int64) for _ in range(columns)]
        self.count = np.zeros(slots, np.int64)  # 0: free

    def add(self, keys: list[np.ndarray], counts: np.ndarray) -> None:
        """Distinct keys only."""
        if 2 * (self.n + len(counts)) > len(self.count):
            slots = 1 << int(2 * (self.n + len(counts))).bit_length()
            old, full = self, np.flatnonzero(self.count)
            self.keys, self.count, held = (
                [np.zeros(slots, np.int64) for _ in keys], np.zeros(slots, np.int64),
                ([k[full] for k in old.keys], old.count[full]),
            )
            self.n = 0
            self._put(*held)
        self._put(keys, counts)

    def _put(self, keys: list[np.ndarray], counts: np.ndarray) -> None:
        mask = np.uint64(len(self.count) - 1)
        h = np.zeros(len(counts), np.uint64)
        for k in keys:
            h = (h ^ k.view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(32)
        slot = (h & mask).astype(np.int64)
        left = np.arange(len(counts))
        while len(left):
            s = slot[left]
            free = self.count[s] == 0
            claim = left[free]
            for own, k in zip(self.keys, keys):
                own[s[free]] = k[claim]  # of several the last one stays
            same = np.ones(len(left), bool)
            for own, k in zip(self.keys, keys):
                same &= own[s] == k[left]
            self.n += int(np.count_nonzero(same & free))
            self.count[s[same]] += counts[left[same]]  # keys are distinct, so are these slots
            left = left[~same]
            slot[left] = (slot[left] + 1) & int(mask)

    def items(self) -> tuple[np.ndarray, list[np.ndarray]]:
        full = np.flatnonzero(self.count)
        return self.count[full], [k[full] for k in self.keys]


class Node:
    """Children over ascending ranges of the word at ``level``; together they cover all words."""

    def __init__(self, level: int, depth: int):
        self.level, self.depth = level, depth
        self.child: list = [Container(-1, LAST, (depth + 1) // 2)]
        self.edge = [-1]  # first word of each child

    def word(self, keys: list[np.ndarray]) -> np.ndarray:
        column, second = divmod(self.level, 2)
        return ((keys[column] if second else keys[column] >> 32) & 0xFFFFFFFF) - 1

    def add(self, keys: list[np.ndarray], counts: np.ndarray) -> None:
        """Sorted, distinct keys that agree in all words before this level."""
        cuts = np.searchsorted(self.word(keys), [*self.edge[1:], LAST + 1])
        start = 0
        for k in range(len(self.child) - 1, -1, -1):  # from behind: children that split add to the list
            start, end = (int(cuts[k - 1]) if k else 0), int(cuts[k])
            if start == end:
                continue
            child = self.child[k]
            child.add([x[start:end] for x in keys], counts[start:end])
            if isinstance(child, Container) and child.n > BURST:
                self._grow(k)

    def _grow(self, k: int) -> None:
        """Cut the range of a container in two, or put a node in the place of a single word's."""
        child = self.child[k]
        counts, keys = child.items()
        words = self.word(keys)
        low, high = int(words.min()), int(words.max())
        if low == high and self.level + 1 == self.depth:
            return
        order = np.lexsort(keys[::-1])
        counts, keys, words = counts[order], [x[order] for x in keys], words[order]
        if low == high:
            node = Node(self.level + 1, self.depth)
            node.add(keys, counts)
            parts = [(low, node)]
            if child.low < low:
                parts.insert(0, (child.low, Container(child.low, low - 1, len(keys))))
            if high < child.high:
                parts.append((high + 1, Container(high + 1, child.high, len(keys))))
        else:
            middle = int(words[len(words) // 2])
            middle = middle if middle > low else middle + 1  # both parts get some
            cut = int(np.searchsorted(words, middle))
            parts = []
            for a, b, rows in ((child.low, middle - 1, slice(0, cut)), (middle, child.high, slice(cut, None))):
                part = Container(a, b, len(keys))
                part.add([x[rows] for x in keys], counts[rows])
                parts.append((a, part))
        self.child[k : k + 1] = [p for _, p in parts]
        self.edge[k : k + 1] = [a for a, _ in parts]
        for i in range(k + len(parts) - 1, k - 1, -1):
            if isinstance(self.child[i], Container) and self.child[i].n > BURST:
                self._grow(i)

    @property
    def n(self) -> int:
        return sum(c.n for c in self.child)

    def items(self) -> tuple[np.ndarray, list[np.ndarray]]:
        parts = [c.items() for c in self.child]
        return np.concatenate([c for c, _ in parts]), [np.concatenate(x) for x in zip(*(k for _, k in parts))]


class HatTrie:
    def __init__(self, depth: int, limit: int):
        self.depth, self.limit = depth, limit
        self.root = Node(0, depth)

    def add(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Count rows; runs (rows, counts) of subtrees that had to go."""
        rows, counts = summed(rows, np.ones(len(rows), np.int64))
        self.root.add(packed(rows), counts)
        held = self.root.n
        while held > self.limit:
            largest = max(range(len(self.root.child)), key=lambda k: self.root.child[k].n)
            held -= self.root.child[largest].n
            yield self._cut(largest)

    def rest(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for k in range(len(self.root.child)):
            if self.root.child[k].n:
                yield self._cut(k)

    def _cut(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        counts, keys = self.root.child[k].items()
        low = self.root.edge[k]
        high = self.root.edge[k + 1] - 1 if k + 1 < len(self.root.edge) else LAST
        self.root.child[k] = Container(low, high, (self.depth + 1) // 2)
        order = np.lexsort(keys[::-1])
        rows = np.empty((len(counts), self.depth), np.int32)
        for c in range(self.depth):
            column, second = divmod(c, 2)
            rows[:, c] = ((keys[column] if second else keys[column] >> 32)[order] & 0xFFFFFFFF) - 1
        return rows, counts[order]
