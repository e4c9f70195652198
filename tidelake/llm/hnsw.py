"""A navigable small-world graph in layers, over unit vectors, as flat neighbour arrays in numpy.

Nodes are inserted in batches, and many queries walk the graph side by side.
"""

from __future__ import annotations

import numpy as np

#: Neighbours of a node in the upper layers; twice as many in the lowest.
DEGREE = 16
#: Width of the beam while inserting and while searching.
EF_BUILD = 96
EF_SEARCH = 128
#: Nodes inserted at once, and candidates of a query that are expanded at once.
BATCH = 256
EXPAND = 4


def levels(n: int, seed: int = 1) -> np.ndarray:
    """Highest layer of each node, geometric."""
    u = np.random.default_rng(seed).random(n)
    return np.minimum((-np.log(np.maximum(u, 1e-12)) / np.log(DEGREE)).astype(np.int64), 8)


def _beam(vectors: np.ndarray, graph: np.ndarray, queries: np.ndarray, entry: np.ndarray, ef: int):
    """(ids, similarities) of the ``ef`` best nodes each query reaches from its entry; -1 where fewer."""
    m = len(queries)
    rows = np.arange(m)
    seen = np.zeros((m, len(vectors) + 1), bool)  # the last column stands for missing neighbours
    seen[:, -1] = True
    seen[rows, entry] = True
    ids = np.full((m, ef), -1, np.int64)
    sims = np.full((m, ef), -np.inf, np.float32)
    done = np.ones((m, ef), bool)
    ids[:, 0], sims[:, 0], done[:, 0] = entry, np.einsum("md,md->m", vectors[entry], queries), False
    active = rows
    while len(active):
        open_ = np.where(done[active], -np.inf, sims[active])
        width = min(EXPAND, ef)
        pick = np.argpartition(-open_, width - 1, axis=1)[:, :width]
        fresh = np.isfinite(np.take_along_axis(open_, pick, 1))
        going = fresh.any(1)
        active, pick, fresh = active[going], pick[going], fresh[going]
        if not len(active):
            break
        flags = done[active]
        np.put_along_axis(flags, pick, True, 1)
        done[active] = flags
        nodes = np.where(fresh, np.take_along_axis(ids[active], pick, 1), -1)
        near = np.where(nodes[:, :, None] >= 0, graph[nodes], -1).reshape(len(active), -1)
        near.sort(axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
        near[seen[active[:, None], near]] = -1
        seen[active[:, None], near] = True
        new = np.einsum("mnd,md->mn", vectors[near], queries[active])
        new[near < 0] = -np.inf
        all_sims = np.concatenate((sims[active], new), 1)
        keep = np.argpartition(-all_sims, ef - 1, axis=1)[:, :ef]
        sims[active] = np.take_along_axis(all_sims, keep, 1)
        ids[active] = np.take_along_axis(np.concatenate((ids[active], near), 1), keep, 1)
        done[active] = np.take_along_axis(np.concatenate((done[active], near < 0), 1), keep, 1)
    order = np.argsort(-sims, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)


def _diverse(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, degree: int) -> np.ndarray:
    """Of candidates sorted by similarity, up to ``degree``: first those nearer to the node than to any
    neighbour already taken, then the nearest of the rest; -1 where fewer."""
    m, c = ids.shape
    valid = ids >= 0
    among = np.matmul(vectors[ids], vectors[ids].transpose(0, 2, 1))
    closest = np.full((m, c), -np.inf, np.float32)
    taken = np.zeros((m, c), bool)
    count = np.zeros(m, np.int64)
    for i in range(c):
        take = valid[:, i] & (count < degree) & (sims[:, i] >= closest[:, i])
        taken[:, i] = take
        count += take
        closest = np.where(take[:, None], np.maximum(closest, among[:, i]), closest)
    rank = np.argsort(np.where(taken, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :degree]
    found = np.take_along_axis(np.where(valid, ids, -1), rank, 1)
    if c < degree:
        found = np.pad(found, ((0, 0), (0, degree - c)), constant_values=-1)
    return found


def _nearest(vectors: np.ndarray, members: np.ndarray, degree: int) -> np.ndarray:
    """Neighbours of the members among themselves, by comparing all of them; a bounded number."""
    own = vectors[members]
    sims = own @ own.T
    np.fill_diagonal(sims, -np.inf)
    width = min(max(len(members) - 1, 1), 4 * degree)
    order = np.argsort(-sims, axis=1, kind="stable")[:, :width]
    found = np.take_along_axis(sims, order, 1)
    ids = np.where(np.isfinite(found), members[order], -1)
    return _diverse(vectors, ids, found, degree)


class Graph:
    """``layers[l]`` has the neighbours of every node in layer ``l``; -1 where a node has fewer."""

    def __init__(self, layers: list[np.ndarray], entry: int):
        self.layers, self.entry = layers, entry

    def descend(self, vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
        """The node of layer 1 nearest to each query, found layer by layer."""
        at = np.full(len(queries), self.entry)
        for graph in self.layers[:0:-1]:
            at = _beam(vectors, graph, queries, at, 8)[0][:, 0]
        return at

    def search(self, vectors: np.ndarray, queries: np.ndarray, ef: int = EF_SEARCH):
        return _beam(vectors, self.layers[0], queries, self.descend(vectors, queries), min(ef, max(len(vectors), 1)))


def build(vectors: np.ndarray, seed: int = 1) -> Graph:
    """A graph over the rows of ``vectors``, which have unit length."""
    n = len(vectors)
    level = levels(n, seed)
    order = np.argsort(-level, kind="stable")
    layers = []
    for at in range(int(level.max()), 0, -1):
        members = np.flatnonzero(level >= at)
        graph = np.full((n + 1, DEGREE), -1, np.int32)
        if len(members) > 1:
            graph[members] = _nearest(vectors, members, DEGREE)
        layers.insert(0, graph)
    degree = 2 * DEGREE
    ground = np.full((n + 1, degree), -1, np.int32)
    found = Graph([ground, *layers], int(order[0]))
    begin = min(n, max(BATCH, int((level > 0).sum())))
    if begin > 1:
        ground[order[:begin]] = _nearest(vectors, order[:begin], degree)
    for start in range(begin, n, BATCH):
        batch = order[start : start + BATCH]
        ids, sims = _beam(vectors, ground, vectors[batch], found.descend(vectors, vectors[batch]), EF_BUILD)
        # nodes of one batch don't meet on the graph
        own = vectors[batch] @ vectors[batch].T
        np.fill_diagonal(own, -np.inf)
        width = min(DEGREE, max(len(batch) - 1, 1))
        side = np.argsort(-own, axis=1, kind="stable")[:, :width]
        side_sims = np.take_along_axis(own, side, 1)
        ids = np.concatenate((ids, np.where(np.isfinite(side_sims), batch[side], -1)), 1)
        sims = np.concatenate((sims, side_sims), 1)
        rank = np.argsort(-sims, axis=1, kind="stable")
        chosen = _diverse(vectors, np.take_along_axis(ids, rank, 1), np.take_along_axis(sims, rank, 1), DEGREE)
        ground[batch, :DEGREE] = chosen
        _link_back(vectors, ground, np.repeat(batch, DEGREE), chosen.ravel())
    return found


def _link_back(vectors: np.ndarray, graph: np.ndarray, sources: np.ndarray, targets: np.ndarray) -> None:
    """Give each target its source as a neighbour; full lists are chosen anew."""
    keep = targets >= 0
    sources, targets = sources[keep], targets[keep]
    order = np.argsort(targets, kind="stable")
    sources, targets = sources[order], targets[order]
    nodes, first, counts = np.unique(targets, return_index=True, return_counts=True)
    width = graph.shape[1] + int(counts.max(initial=0))
    wide = np.full((len(nodes), width), -1, np.int64)
    wide[:, : graph.shape[1]] = graph[nodes]
    wide[np.repeat(np.arange(len(nodes)), counts), graph.shape[1] + np.arange(len(targets)) - np.repeat(first, counts)] = sources
    wide.sort(axis=1)
    wide[:, 1:][wide[:, 1:] == wide[:, :-1]] = -1
    for start in range(0, len(nodes), BATCH):
        part, own = wide[start : start + BATCH], nodes[start : start + BATCH]
        sims = np.einsum("mnd,md->mn", vectors[part], vectors[own])
        sims[part < 0] = -np.inf
        rank = np.argsort(-sims, axis=1, kind="stable")
        graph[own] = _diverse(vectors, np.take_along_axis(part, rank, 1), np.take_along_axis(sims, rank, 1), graph.shape[1])
