"""A Gray-order hierarchical index over 64-bit fingerprints, and the linking of near ones with it.

Fingerprints are sorted by Gray rank, which puts close ones side by side. Runs of FAN make a node; a node keeps the bits
on which all below it agree (mask and pattern), and only those that its parent does not already hold. A search adds up
the differences on the masked bits on its way down and drops a node, and with it the whole group below, as soon as the
sum exceeds the limit. Nodes whose members are already in the searcher's component are dropped too, so that a group of n
near copies costs far fewer than n squared comparisons and yields a tree of links, not all pairs.
"""

from __future__ import annotations

import numpy as np

FAN = 16
BLOCK = 512


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code word in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


def _root(label: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    while True:
        up = label[nodes]
        if (up == nodes).all():
            return nodes
        nodes = up


def unite(label: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Join the components of i and j; a label points to a smaller member, and roots to themselves."""
    while len(i):
        a, b = _root(label, i), _root(label, j)
        apart = a != b
        i, j, a, b = i[apart], j[apart], a[apart], b[apart]
        if len(i):
            np.minimum.at(label, np.maximum(a, b), np.minimum(a, b))


class GrayIndex:
    """`codes` must be distinct and in Gray order."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.compared = 0  # nodes and codes that searches have been compared with
        self.levels = []  # from the root down: [pattern, mask] of the level's nodes
        every, any_ = codes, codes
        while len(every) > 1:
            starts = np.arange(0, len(every), FAN)
            every, any_ = np.bitwise_and.reduceat(every, starts), np.bitwise_or.reduceat(any_, starts)
            self.levels.append([every, ~(every ^ any_)])
        self.levels.reverse()
        # Bits that the parent holds are compared there.
        for above, below in zip(self.levels[-2::-1], self.levels[:0:-1]):
            below[1] = below[1] & ~np.repeat(above[1], FAN)[:len(below[1])]
        self.held = np.zeros(1, np.uint64)  # bits compared from the top down to each leaf node
        for _, mask in self.levels:
            self.held = np.repeat(self.held, FAN)[:len(mask)] | mask

    def link(self, limit: int, label: np.ndarray | None = None) -> np.ndarray:
        """The component of each code, as the place of a member, under links of at most `limit` differing bits."""
        n = len(self.codes)
        label = np.arange(n) if label is None else label
        for begin in range(0, n, BLOCK):
            self._search(np.arange(begin, min(n, begin + BLOCK)), limit, label)
        return _root(label, np.arange(n))

    def _search(self, who: np.ndarray, limit: int, label: np.ndarray) -> None:
        if not self.levels:
            return
        label[:] = _root(label, np.arange(len(label)))
        uniform = []  # for each level the component that a node's members share, or -1
        low, high = label, label
        for _ in self.levels:
            starts = np.arange(0, len(low), FAN)
            low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
            uniform.append(np.where(low == high, low, -1))
        uniform.reverse()
        queries = who
        nodes = np.zeros(len(who), np.int64)
        spent = np.zeros(len(who), np.uint8)
        for depth, (pattern, mask) in enumerate(self.levels):
            if depth:
                queries, nodes, spent = _children(queries, nodes, spent, len(pattern))
            self.compared += len(queries)
            spent = spent + np.bitwise_count((self.codes[queries] ^ pattern[nodes]) & mask[nodes])
            # A search only looks at what comes behind it in the order: each pair is met once.
            reach = FAN ** (len(self.levels) - depth)
            keep = (spent <= limit) & (uniform[depth][nodes] != label[queries]) & ((nodes + 1) * reach > queries)
            queries, nodes, spent = queries[keep], nodes[keep], spent[keep]
        found, members, spent = _children(queries, nodes, spent, len(self.codes))
        self.compared += len(found)
        rest = ~self.held[members // FAN]  # what the nodes above have not compared
        spent = spent + np.bitwise_count((self.codes[found] ^ self.codes[members]) & rest)
        near = (spent <= limit) & (members > found)
        unite(label, found[near], members[near])


def _children(queries, nodes, spent, size):
    children = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
    inside = children < size
    return np.repeat(queries, FAN)[inside], children[inside], np.repeat(spent, FAN)[inside]
