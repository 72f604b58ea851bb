"""Hierarchical navigable small-world graphs over the vectors of one shard, searched many queries at once."""

from __future__ import annotations

import numpy as np

BATCH = 128
EXPANDED = 4


def _sims(vectors: np.ndarray, ids: np.ndarray, queries: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Inner products of each query with its row of ids, -inf where not wanted."""
    out = np.full(ids.shape, -np.inf, np.float32)
    row, column = np.nonzero(wanted)
    out[row, column] = np.einsum("id,id->i", vectors[ids[row, column]], queries[row])
    return out


def _top(ids: np.ndarray, sims: np.ndarray, most: int, *flags: np.ndarray) -> list[np.ndarray]:
    order = np.argsort(-sims, axis=1, kind="stable")[:, :most]
    return [np.take_along_axis(x, order, axis=1) for x in (ids, sims, *flags)]


def search_layer(
    vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, beam: int
) -> tuple[np.ndarray, np.ndarray]:
    """The best ``beam`` nodes found for each query (-1 where fewer), best first, and their similarity."""
    seen = np.zeros((len(queries), len(vectors)), bool)
    valid = entries >= 0
    np.put_along_axis(seen, np.where(valid, entries, entries[:, :1]), True, axis=1)
    ids, sims = _top(entries, _sims(vectors, entries, queries, valid), beam)
    if ids.shape[1] < beam:
        pad = ((0, 0), (0, beam - ids.shape[1]))
        ids, sims = np.pad(ids, pad, constant_values=-1), np.pad(sims, pad, constant_values=-np.inf)
    done = ids < 0
    active = np.arange(len(queries))
    while len(active):
        # The best nodes of each beam whose neighbours have not been looked at.
        open_sims = np.where(done[active], -np.inf, sims[active])
        pick = np.argsort(-open_sims, axis=1, kind="stable")[:, :EXPANDED]
        usable = np.take_along_axis(open_sims, pick, axis=1) > -np.inf
        going = usable[:, 0]
        active, pick, usable = active[going], pick[going], usable[going]
        if not len(active):
            break
        near = np.where(usable[:, :, None], links[np.where(usable, ids[active[:, None], pick], 0)], -1)
        part = done[active]
        np.put_along_axis(part, pick, True, axis=1)
        done[active] = part
        near = np.sort(near.reshape(len(active), -1), axis=1)
        fresh = near >= 0
        fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
        fresh &= ~seen[active[:, None], near]
        seen[np.broadcast_to(active[:, None], near.shape)[fresh], near[fresh]] = True
        found = _sims(vectors, near, queries[active], fresh)
        all_ids = np.hstack([ids[active], np.where(fresh, near, -1)])
        all_sims = np.hstack([sims[active], found])
        all_done = np.hstack([done[active], ~fresh])
        ids[active], sims[active], done[active] = _top(all_ids, all_sims, beam, all_done)
    return ids, sims


def _diverse(vectors: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the candidates of each row, given their similarity to its node.

    First those nearer to the node than to any candidate chosen before, then the nearest of the rest.
    """
    ids, sims = _top(ids, sims, ids.shape[1])
    there = np.isfinite(sims)
    chosen = np.zeros(ids.shape, bool)
    points = vectors[np.where(there, ids, 0)]
    between = np.einsum("kad,kbd->kab", points, points)
    for c in range(ids.shape[1]):
        blocked = (chosen & (between[:, c, :] > sims[:, c : c + 1])).any(axis=1)
        chosen[:, c] = there[:, c] & ~blocked & (chosen.sum(axis=1) < most)
    # Chosen ones first, then the rest by similarity.
    rank = np.where(chosen, 4.0, 0.0) + sims
    out, rank = _top(ids, rank, most)
    out = np.where(np.isfinite(rank), out, -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


class Layer:
    """One layer: the nodes in it (positions in the shard) and the links among them."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray, degree: int, beam: int):
        self.nodes, self.vectors, self.degree = nodes, vectors[nodes], degree
        self.links = np.full((len(nodes), degree), -1, np.int32)
        for first in range(0, len(nodes), BATCH):
            self._insert(first, min(first + BATCH, len(nodes)), beam)

    def _insert(self, first: int, last: int, beam: int) -> None:
        new = np.arange(first, last)
        queries = self.vectors[first:last]
        ids = np.broadcast_to(new, (len(new), len(new)))
        sims = np.where(np.tri(len(new), k=-1, dtype=bool), queries @ queries.T, -np.inf).astype(np.float32)
        if first:
            entries = np.zeros((len(new), 1), np.int64) + np.arange(0, first, max(1, first // 8))[:8]
            found, near = search_layer(self.vectors[:first], self.links[:first], queries, entries, beam)
            ids, sims = np.hstack([found, ids]), np.hstack([near, sims])
        ids, sims = _top(ids, sims, beam)
        self.links[first:last, : self.degree // 2] = _diverse(self.vectors, ids, sims, self.degree // 2)
        # Links back; full lists are chosen anew.
        source, place = np.nonzero(self.links[first:last, : self.degree // 2] >= 0)
        target = self.links[first + source, place]
        order = np.argsort(target, kind="stable")
        target, source = target[order], first + source[order]
        nodes, start, count = np.unique(target, return_index=True, return_counts=True)
        used = (self.links[nodes] >= 0).sum(axis=1)
        offset = np.arange(len(target)) - np.repeat(start, count)
        fits = np.repeat(used, count) + offset < self.degree
        self.links[target[fits], (np.repeat(used, count) + offset)[fits]] = source[fits]
        over = np.flatnonzero(used + count > self.degree)
        for at in range(0, len(over), BATCH):
            part = over[at : at + BATCH]
            width = int(count[part].max())
            back = np.full((len(part), width), -1, np.int64)
            for i, k in enumerate(part.tolist()):
                back[i, : count[k]] = source[start[k] : start[k] + count[k]]
            ids = np.hstack([self.links[nodes[part]], back])
            # Those that still fitted are in the list already.
            ids = np.sort(ids, axis=1)
            ids[:, 1:][ids[:, 1:] == ids[:, :-1]] = -1
            sims = _sims(self.vectors, ids, self.vectors[nodes[part]], ids >= 0)
            self.links[nodes[part]] = _diverse(self.vectors, ids, sims, self.degree)


class Graph:
    """Layers from the whole shard up to a few nodes, each a sixteenth of the one below."""

    def __init__(self, vectors: np.ndarray, degree: int = 32, beam: int = 48, seed: int = 1):
        self.vectors = vectors
        order = np.random.default_rng(seed).permutation(len(vectors))
        self.layers = []
        size = len(vectors)
        while True:
            self.layers.append(Layer(vectors, order[:size], degree, beam))
            if size <= degree:
                break
            size = max(1, size // 16)

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Positions in the shard and similarities, best first; -1 where fewer."""
        entries = np.zeros((len(queries), 1), np.int64)
        for depth in range(len(self.layers) - 1, -1, -1):
            layer = self.layers[depth]
            # A layer is the first part of the one below, so its numbers hold there too.
            found, sims = search_layer(layer.vectors, layer.links, queries, entries, beam if depth == 0 else 4)
            entries = found
        return np.where(found >= 0, self.layers[0].nodes[found], -1), sims

    def within(self, queries: np.ndarray, least: float, beam: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """(query, position) pairs of at least that similarity. A beam that is full of them is widened."""
        out, left = [], np.arange(len(queries))
        while len(left):
            found, sims = self.nearest(queries[left], min(beam, len(self.vectors)))
            hit = sims >= least
            full = hit.all(axis=1) if beam < len(self.vectors) else np.zeros(len(left), bool)
            row, column = np.nonzero(hit & ~full[:, None])
            out.append((left[row], found[row, column]))
            left, beam = left[full], beam * 4
        return out
