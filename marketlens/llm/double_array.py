"""Double-array tries over dense ids.

A node is a place in two arrays. The child of node s by id c lies at
``BASE[s] + c``, and ``CHECK`` there holds s, so a step is one addition and
one comparison. Children are packed into free places: an only child goes to
the first free place there is; for several, the base is the first that puts
all of them on free places, searched from the first free place on, and past
the last used place if a bounded search finds none.
"""

from __future__ import annotations

import numpy as np

TRIES = 64


class DoubleArray:
    def __init__(self, size: int = 64):
        self.base = np.zeros(size, dtype=np.int64)
        self.check = np.full(size, -1, dtype=np.int64)
        self.check[0] = 0  # the root, its own parent
        self.free = 1
        self.top = 1  # past the last used place

    def _room(self, upto: int) -> None:
        if upto > len(self.check):
            more = max(upto, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, dtype=np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, dtype=np.int64)])

    def _next_free(self, at: int) -> int:
        while at < self.top and self.check[at] >= 0:
            at += 1
        return at

    def pack(self, node: int, ids: np.ndarray) -> None:
        """Gives ``node`` its children, one for each id (ascending)."""
        self.free = self._next_free(self.free)
        first, at = int(ids[0]), self.free
        for _ in range(TRIES):
            places = at - first + ids
            inside = places[places < self.top]
            if (self.check[inside] < 0).all():
                break
            at = self._next_free(at + 1)
        else:
            places = self.top - first + ids
        self._room(int(places[-1]) + 1)
        self.base[node] = int(places[0]) - first
        self.check[places] = node
        self.top = max(self.top, int(places[-1]) + 1)

    def child(self, node: int, c: int) -> int:
        """The node's child by id ``c``, or -1."""
        at = int(self.base[node]) + c
        return at if 0 < at < self.top and self.check[at] == node else -1


def build(sequences: list[np.ndarray]) -> DoubleArray:
    """The trie of sequences of dense ids, packed from the root down."""
    trie = DoubleArray(2 + 2 * sum(map(len, sequences)))
    level = [(0, sequences)]
    depth = 0
    while level:
        below = []
        for node, group in level:
            group = [s for s in group if len(s) > depth]
            if not group:
                continue
            heads = np.fromiter((s[depth] for s in group), dtype=np.int64, count=len(group))
            order = np.argsort(heads, kind="stable")
            ids, begin = np.unique(heads[order], return_index=True)
            trie.pack(node, ids)
            for c, part in zip(ids.tolist(), np.split(order, begin[1:])):
                below.append((int(trie.base[node]) + c, [group[i] for i in part]))
        level, depth = below, depth + 1
    return trie
