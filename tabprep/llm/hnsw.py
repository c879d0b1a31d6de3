"""A hierarchical navigable small-world graph over unit vectors, built and searched for many points at a time.

Every point lives in layer 0 and, with a share falling by the factor M per layer, in higher ones. Points are inserted in
blocks: a block descends from the top, each layer's beam search gives candidates, the diversity rule chooses links
(a candidate must be closer to the new point than to any link chosen before), and links are added backwards, again
pruned by the rule. Similarities are inner products in single precision; callers verify what they use.
"""

from __future__ import annotations

import numpy as np

M = 16
BUILD_BEAM = 64
BLOCK = 256
STEP = 4  # beam entries expanded at once


class Graph:
    def __init__(self, vectors: np.ndarray, seed: int = 7):
        self.x = np.ascontiguousarray(vectors, np.float32)
        n = len(self.x)
        draws = np.random.default_rng(seed).random(n)
        self.height = np.minimum((-np.log(np.maximum(draws, 1e-12)) / np.log(M)).astype(int), 6)
        # The highest points come first, so that every layer is entered through its own first point.
        self.order = np.lexsort((np.arange(n), -self.height))
        self.layers = [np.full((n, M if level else 2 * M), -1, np.int32) for level in range(int(self.height.max(initial=0)) + 1)]
        done = 0
        while done < n:
            block = self.order[done:done + min(BLOCK, max(1, done // 2, 32 if not done else 1))]
            self._insert(block, done)
            done += len(block)

    @classmethod
    def restored(cls, vectors: np.ndarray, height: np.ndarray, links: np.ndarray) -> "Graph":
        """The graph that `rows` was asked for, without building it again."""
        graph = cls.__new__(cls)
        graph.x, graph.height = np.ascontiguousarray(vectors, np.float32), height
        graph.order = np.lexsort((np.arange(len(height)), -height))
        begin = np.cumsum(2 * M + M * height) - 2 * M - M * height
        graph.layers = [links[begin[:, None] + np.arange(2 * M)]]
        for level in range(1, int(height.max(initial=0)) + 1):
            layer, here = np.full((len(height), M), -1, np.int32), height >= level
            layer[here] = links[begin[here, None] + M * (level + 1) + np.arange(M)]
            graph.layers.append(layer)
        return graph

    def rows(self) -> tuple[np.ndarray, np.ndarray]:
        """(number of links, links) of the points in order: 2 M of layer 0, then M of every layer up to the point's height."""
        size = 2 * M + M * self.height
        begin, links = np.cumsum(size) - size, np.empty(size.sum(), np.int32)
        links[begin[:, None] + np.arange(2 * M)] = self.layers[0]
        for level in range(1, len(self.layers)):
            here = self.height >= level
            links[begin[here, None] + M * (level + 1) + np.arange(M)] = self.layers[level][here]
        return size, links

    def _insert(self, block: np.ndarray, done: int) -> None:
        entry = np.full((len(block), 1), self.order[0]) if done else np.full((len(block), 0), 0)
        inner = self.x[block] @ self.x[block].T
        np.fill_diagonal(inner, -2)
        for level in range(len(self.layers) - 1, -1, -1):
            here = self.height[block] >= level
            if not done or self.height[self.order[0]] < level:
                found, sims = np.full((len(block), 0), -1), np.full((len(block), 0), -2.0, np.float32)
            else:
                beam = BUILD_BEAM if here.any() else 8
                found, sims = self.search(self.x[block], beam, entry, level)
                entry = found[:, :8]
            if here.any():
                own = np.where(here[:, None] & here[None, :], inner, -2)[here]
                near = np.argsort(-own, axis=1)[:, :BUILD_BEAM]
                ids = np.concatenate([found[here], np.where(np.take_along_axis(own, near, 1) > -2, block[near], -1)], axis=1)
                values = np.concatenate([sims[here], np.take_along_axis(own, near, 1).astype(np.float32)], axis=1)
                self._connect(block[here], ids, values, level)

    def _choose(self, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """For each row the links that the diversity rule keeps, filled up with the closest others."""
        order = np.argsort(-np.where(ids >= 0, sims, -3), axis=1, kind="stable")[:, :BUILD_BEAM]
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        vectors = self.x[np.maximum(ids, 0)]
        between = np.matmul(vectors, vectors.transpose(0, 2, 1))
        kept = np.zeros(ids.shape, bool)
        closest = np.full(ids.shape, -2, np.float32)  # to any link kept so far
        for c in range(ids.shape[1]):
            good = (ids[:, c] >= 0) & (sims[:, c] > closest[:, c]) & (kept.sum(axis=1) < most)
            kept[:, c] = good
            closest[good] = np.maximum(closest[good], between[good, c])
        rank = np.argsort(np.where(ids < 0, 2, np.where(kept, 0, 1)), axis=1, kind="stable")[:, :most]
        out = np.full((len(ids), most), -1, np.int32)
        out[:, :rank.shape[1]] = np.take_along_axis(ids, rank, 1)
        return out

    def _connect(self, points: np.ndarray, ids: np.ndarray, sims: np.ndarray, level: int) -> None:
        links = self.layers[level]
        most = links.shape[1]
        links[points] = _width(self._choose(ids, sims, M), most)
        to, source = links[points].ravel(), np.repeat(points, most)
        to, source = to[to >= 0], source[to >= 0]
        order = np.argsort(to, kind="stable")
        to, source = to[order], source[order]
        target, start, count = np.unique(to, return_index=True, return_counts=True)
        if not len(target):
            return
        # Per target the links it has and the new ones, repeats removed; what exceeds the room is chosen anew.
        width = int(count.max())
        new = np.full((len(target), width), -1, np.int32)
        new[np.repeat(np.arange(len(target)), count), np.arange(len(to)) - np.repeat(start, count)] = source
        every = np.sort(np.concatenate([links[target], new], axis=1), axis=1)
        every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
        full = (every >= 0).sum(axis=1) > most
        packed = -np.sort(-every, axis=1)
        links[target[~full]] = _width(packed[~full], most)
        if full.any():
            rows, at = every[full], target[full]
            sims = np.matmul(self.x[np.maximum(rows, 0)], self.x[at][:, :, None])[:, :, 0]
            links[at] = self._choose(rows, np.where(rows >= 0, sims, -3), most)

    def search(self, queries: np.ndarray, beam: int, entry: np.ndarray, level: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """The best `beam` points met per query, best first; -1 and -2 fill up."""
        n, rows = len(self.x), len(queries)
        links = self.layers[level]
        seen = np.zeros((rows, n + 1), bool)  # the last place takes what is no point
        seen[:, n] = True
        ids = _width(np.sort(entry, axis=1)[:, ::-1], beam)
        ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
        seen[np.arange(rows)[:, None], ids] = True
        sims = np.where(ids >= 0, np.matmul(self.x[np.maximum(ids, 0)], queries[:, :, None])[:, :, 0], -2).astype(np.float32)
        ids, sims = _best(ids, sims, beam)
        open_ = ids >= 0
        active = np.flatnonzero(open_.any(axis=1))
        while len(active):
            next_ = np.argsort(~open_[active], axis=1, kind="stable")[:, :STEP]
            chosen = np.take_along_axis(open_[active], next_, 1)
            from_ = np.where(chosen, np.take_along_axis(ids[active], next_, 1), -1)
            open_[active[:, None], next_] = False
            new = np.where(from_[:, :, None] >= 0, links[np.maximum(from_, 0)], -1).reshape(len(active), -1)
            new = np.sort(new, axis=1)
            new[:, 1:][new[:, 1:] == new[:, :-1]] = -1
            new[seen[active[:, None], new]] = -1
            seen[active[:, None], new] = True
            r, c = np.nonzero(new >= 0)
            values = np.full(new.shape, -2, np.float32)
            values[r, c] = np.einsum("ij,ij->i", self.x[new[r, c]], queries[active[r]])
            all_ids = np.concatenate([ids[active], new], axis=1)
            all_sims = np.concatenate([sims[active], values], axis=1)
            all_open = np.concatenate([open_[active], new >= 0], axis=1)
            order = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[active], sims[active] = np.take_along_axis(all_ids, order, 1), np.take_along_axis(all_sims, order, 1)
            open_[active] = np.take_along_axis(all_open, order, 1)
            active = active[open_[active].any(axis=1)]
        return ids, sims

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Descend from the top and search layer 0 with the given beam."""
        entry = np.full((len(queries), 1), self.order[0])
        for level in range(len(self.layers) - 1, 0, -1):
            entry = self.search(queries, 8, entry, level)[0]
        return self.search(queries, beam, entry)


def _width(ids: np.ndarray, width: int) -> np.ndarray:
    """The first `width` columns, filled up with -1."""
    out = np.full((len(ids), width), -1, np.int32)
    part = ids[:, :width]
    out[:, :part.shape[1]] = part
    return out


def _best(ids: np.ndarray, sims: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :beam]
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
