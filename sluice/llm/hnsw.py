"""Hierarchical navigable small-world graphs over unit vectors, in numpy batches.

Nodes have levels drawn by chance (each level holds about a sixteenth of the one
below). Layers are built from the top down; a batch of nodes searches the layer
above and then its own, takes diverse neighbours among what it found, and is
linked back. A search goes through the layers with narrow beams and through the
bottom layer with a beam of ``ef``. The first beam, ``FIRST`` wide, is run at every
size above it. A beam sees only what links lead to; a wider one that would cost more
than comparing with every row is not run: every row is compared.
"""

from __future__ import annotations

import numpy as np

BRANCH = 16
FIRST = 64  # the width of the first beam
TOP = 64  # the top layer is scanned as a whole
BATCH = 256
CELLS = 1 << 23  # similarities worked out at a time


def select(vectors: np.ndarray, queries: np.ndarray, found: np.ndarray, m: int) -> np.ndarray:
    """Up to ``m`` of the candidates ``found`` (best first, -1 for none) per row.

    A candidate nearer to one already taken than to the query is put off, and
    taken only if places are left over.
    """
    rows, width = found.shape
    there = vectors[found]
    to_query = np.einsum("rcd,rd->rc", there, queries)
    among = np.einsum("rcd,red->rce", there, there)
    usable = found >= 0
    taken = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -2.0, np.float32)  # of each candidate to those taken
    for j in range(width):
        new = usable[:, j] & (closest[:, j] <= to_query[:, j]) & (taken.sum(1) < m)
        taken[:, j] = new
        closest = np.where(new[:, None], np.maximum(closest, among[:, j]), closest)
    rank = np.where(taken, 0, np.where(usable, 1, 2)) * width + np.arange(width)
    order = np.argsort(rank, axis=1)[:, :m]
    chosen = np.take_along_axis(found, order, 1)
    if chosen.shape[1] < m:
        chosen = np.pad(chosen, ((0, 0), (0, m - chosen.shape[1])), constant_values=-1)
    return chosen


def beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int):
    """The ``ef`` best nodes per query (ids and similarities, best first).

    ``entry`` holds start nodes per query, -1 for none.
    """
    rows, step = len(queries), 4
    seen = np.zeros((rows, len(vectors) + 1), bool)
    at = np.arange(rows)[:, None]
    seen[at, entry] = True
    seen[:, -1] = True
    ids = np.full((rows, ef), -1)
    ids[:, : entry.shape[1]] = entry[:, :ef]
    sims = np.where(ids >= 0, np.einsum("red,rd->re", vectors[ids], queries), -3.0).astype(np.float32)
    order = np.argsort(-sims, axis=1)
    ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
    open_ = np.concatenate([ids >= 0, np.zeros((rows, 1), bool)], 1)  # the last column is no place
    live = np.arange(rows)
    while len(live):
        rank = np.where(open_[live, :ef], np.arange(ef), ef)
        pick = np.partition(rank, min(step, ef) - 1, axis=1)[:, : min(step, ef)]
        going = (pick < ef).any(1)
        live, pick = live[going], pick[going]
        if not len(live):
            break
        here = live[:, None]
        nodes = np.where(pick < ef, ids[here, np.minimum(pick, ef - 1)], -1)
        open_[here, pick] = False
        near = np.where(nodes[:, :, None] >= 0, links[nodes], -1).reshape(len(live), -1)
        near = np.where(seen[here, near], -1, near)
        near.sort(1)  # a node that two of them link to counts once
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        seen[here, near] = True
        score = np.where(near >= 0, np.einsum("rcd,rd->rc", vectors[near], queries[live]), -3.0).astype(np.float32)
        near = np.where(score > np.maximum(sims[live, -1:], -2.5), near, -1)
        score = np.where(near >= 0, score, -3.0)
        ids2, sims2 = np.concatenate([ids[live], near], 1), np.concatenate([sims[live], score], 1)
        open2 = np.concatenate([open_[live, :ef], near >= 0], 1)
        order = np.argsort(-sims2, axis=1, kind="stable")[:, :ef]
        ids[live], sims[live] = np.take_along_axis(ids2, order, 1), np.take_along_axis(sims2, order, 1)
        open_[live, :ef] = np.take_along_axis(open2, order, 1) & (ids[live] >= 0)
    return ids, sims


class Graph:
    """``layers`` from the bottom up: (node ids in the layer, links between them)."""

    def __init__(self, vectors: np.ndarray, seed: int = 1, m: int = 12, ef: int = 48):
        self.vectors, self.m, self.ef = np.ascontiguousarray(vectors, np.float32), m, ef
        n = len(vectors)
        order = np.random.default_rng(seed).permutation(n)
        sizes = [n]
        while sizes[-1] > TOP:
            sizes.append(max(1, sizes[-1] // BRANCH))
        # A layer is a prefix of one random order, so layers share numbers.
        self.order, self.layers = order, []
        self.sorted = self.vectors[order]
        for size in reversed(sizes):
            self.layers.append(self._layer(size))

    def _layer(self, size: int) -> np.ndarray:
        width = 2 * self.m
        links = np.full((size, width), -1)
        if self.layers:  # the nodes of the layer above come with their links
            first = len(self.layers[-1])
            links[:first] = self.layers[-1]
        else:
            first = size
            sims = self.sorted[:first] @ self.sorted[:first].T
            np.fill_diagonal(sims, -3)
            near = np.argsort(-sims, axis=1)[:, : max(1, min(self.ef, first - 1))]
            near = np.where(np.take_along_axis(sims, near, 1) > -3, near, -1)
            links[:first] = select(self.sorted, self.sorted[:first], near, width)
        done = first
        while done < size:
            new = np.arange(done, min(size, done + BATCH, 2 * done))
            queries = self.sorted[new]
            found, score = beam(self.sorted[:done], links[:done], queries, self._entry(queries), self.ef)
            within = queries @ queries.T  # the batch is not in the graph yet
            np.fill_diagonal(within, -3)
            k = min(self.m, len(new) - 1)
            if k > 0:
                best = np.argsort(-within, axis=1)[:, :k]
                found = np.concatenate([found, new[best]], 1)
                score = np.concatenate([score, np.take_along_axis(within, best, 1)], 1)
                by = np.argsort(-score, axis=1, kind="stable")
                found = np.take_along_axis(found, by, 1)
            links[new, : self.m] = select(self.sorted, queries, found, self.m)
            self._link_back(links, new)
            done = int(new[-1]) + 1
        return links

    def _link_back(self, links: np.ndarray, new: np.ndarray) -> None:
        width = links.shape[1]
        source = np.repeat(new, self.m)
        target = links[new, : self.m].reshape(-1)
        source, target = source[target >= 0], target[target >= 0]
        near = np.einsum("rd,rd->r", self.sorted[source], self.sorted[target])
        by = np.lexsort((-near, target))
        source, target = source[by], target[by]
        nodes, at, n = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(at, n)
        keep = place < 4 * width  # bounds one step: the nearest of a hub
        added = np.full((len(nodes), int(min(n.max(initial=0), 4 * width))), -1)
        added[np.repeat(np.arange(len(nodes)), n)[keep], place[keep]] = source[keep]
        every = np.concatenate([links[nodes], added], 1)
        every.sort(1)
        every[:, 1:][every[:, 1:] == every[:, :-1]] = -1
        sims = np.where(every >= 0, np.einsum("rcd,rd->rc", self.sorted[every], self.sorted[nodes]), -3)
        every = np.take_along_axis(every, np.argsort(-sims, axis=1)[:, : 2 * width], 1)
        links[nodes] = select(self.sorted, self.sorted[nodes], every, width)

    def _entry(self, queries: np.ndarray, width: int = 4) -> np.ndarray:
        """Start nodes, found by going down the layers built so far."""
        top = len(self.layers[0]) if self.layers else len(self.sorted)
        entry = np.argsort(-(queries @ self.sorted[:top].T), axis=1)[:, :width]
        for links in self.layers[1:]:
            entry = beam(self.sorted[: len(links)], links, queries, entry, 8)[0][:, :width]
        return entry

    def search(self, queries: np.ndarray, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers and similarities of the ``ef`` best per query, -1 for none."""
        queries = np.ascontiguousarray(queries, np.float32)
        ef = min(ef, len(self.sorted))
        held = self.layers
        self.layers = held[:-1]
        entry = self._entry(queries)[:, :ef]
        self.layers = held
        ids, sims = beam(self.sorted, held[-1], queries, entry, ef)
        return np.where(ids >= 0, self.order[ids], -1), sims

    def whole(self, width: int) -> bool:
        """Whether a beam beyond the first costs more than comparing with every row."""
        return width >= len(self.sorted) or (width > FIRST and width * width >= 4 * len(self.sorted))

    def every(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) of at least that similarity, by comparing all."""
        left, right = [], []
        step = max(1, CELLS // max(1, len(self.sorted)))
        for at in range(0, len(queries), step):
            rows, found = np.nonzero(queries[at : at + step] @ self.sorted.T >= least)
            left.append(rows + at)
            right.append(self.order[found])
        return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])

    def within(self, queries: np.ndarray, least: float, ef: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, row) of at least that similarity; a beam that is full of them is widened."""
        queries = np.ascontiguousarray(queries, np.float32)
        if self.whole(ef):
            return self.every(queries, least)
        left, right = [], []
        for at in range(0, len(queries), BATCH):
            todo, width = np.arange(at, min(len(queries), at + BATCH)), ef
            while len(todo) and not self.whole(width):
                ids, sims = self.search(queries[todo], width)
                full = sims[:, -1] >= least
                hit = (sims >= least) & (ids >= 0) & ~full[:, None]
                left.append(np.repeat(todo, hit.sum(1)))
                right.append(ids[hit])
                todo, width = todo[full], width * 4
            rows, found = self.every(queries[todo], least)
            left.append(todo[rows])
            right.append(found)
        return np.concatenate(left or [np.zeros(0, int)]), np.concatenate(right or [np.zeros(0, int)])
