"""A hierarchical navigable small-world graph over the vectors of one shard, as flat neighbour arrays.

Nodes are numbered from the highest level down, so level l holds the first ``sizes[l]`` of them and its neighbours are one array
of ``sizes[l]`` rows (-1 where a node has fewer). Nodes are inserted in batches: a batch searches the graph of all earlier
nodes, and its members see each other. Searches run for many queries at a time, step by step.
"""

from __future__ import annotations

import numpy as np

#: Neighbours of a node above level 0 (twice as many there), and nodes kept while searching to insert one.
LINKS, EF_BUILD = 12, 48
#: Nodes carried from level to level as entries, so that a search starts in several clusters.
ENTRIES = 12
_BATCH = 256
_FAR = np.float32(np.inf)


def levels(n: int, links: int = LINKS) -> np.ndarray:
    """How many of ``n`` nodes reach each level: a ``links``-th of the level below, as drawn levels have on average."""
    sizes = [n]
    while sizes[-1] > 2 * links:
        sizes.append(max(1, sizes[-1] // links))
    return np.array(sizes, np.int64)


def _distances(vectors: np.ndarray, norms: np.ndarray, queries: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances, less the queries' own norms, of each query to its ids."""
    return norms[ids] - 2 * np.matmul(vectors[ids], queries[:, :, None])[:, :, 0]


def _search(vectors: np.ndarray, norms: np.ndarray, links: np.ndarray, queries: np.ndarray, entries: np.ndarray, ef: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``ef`` nearest nodes found for each query among the first ``n`` of a level, nearest first (-1: none), from its entries."""
    b, width = len(queries), links.shape[1]
    rows = np.arange(b)
    seen = np.zeros((b, n + 1), bool)
    seen[:, n] = True  # where -1 points
    ids = np.full((b, ef), -1, np.int64)
    near = np.full((b, ef), _FAR, np.float32)
    opened = np.ones((b, ef), bool)
    start = entries[:, :ef]
    d = _distances(vectors, norms, queries, start)
    d[start < 0] = _FAR
    for j in range(start.shape[1]):
        again = seen[rows, start[:, j]]
        d[again, j] = _FAR
        seen[rows, start[:, j]] = True
    k = start.shape[1]
    ids[:, :k], near[:, :k], opened[:, :k] = np.where(np.isinf(d), -1, start), d, np.isinf(d)
    active = rows
    while len(active):
        waiting = np.where(opened[active], _FAR, near[active])
        best = waiting.argmin(axis=1)
        go = ~np.isinf(waiting[np.arange(len(active)), best])
        active, best = active[go], best[go]
        if not len(active):
            break
        opened[active, best] = True
        around = links[ids[active, best]]
        around = np.where(around >= n, -1, around)
        fresh = ~seen[active[:, None], around]
        seen[active[:, None], around] = True
        seen[active, n] = True
        d = np.where(fresh, _distances(vectors, norms, queries[active], around), _FAR)
        all_d = np.concatenate((near[active], d), axis=1)
        all_i = np.concatenate((ids[active], np.where(fresh, around, -1)), axis=1)
        all_o = np.concatenate((opened[active], ~fresh), axis=1)
        order = np.argpartition(all_d, ef - 1, axis=1)[:, :ef] if width else np.arange(ef)[None, :].repeat(len(active), 0)
        ids[active], near[active], opened[active] = (np.take_along_axis(x, order, 1) for x in (all_i, all_d, all_o))
    order = np.argsort(near, axis=1, kind="stable")
    ids, near = np.take_along_axis(ids, order, 1), np.take_along_axis(near, order, 1)
    return np.where(np.isinf(near), -1, ids), near


def _spread(vectors: np.ndarray, ids: np.ndarray, d: np.ndarray, m: int) -> np.ndarray:
    """At most ``m`` of each row's candidates (sorted by distance ``d`` to the row's node): first those nearer to the node than
    to any chosen one, so that links lead in all directions, then the nearest of the rest."""
    t, c = ids.shape
    if c <= m:
        return np.where(np.isinf(d), -1, ids)
    x = vectors[ids]
    norms = (x * x).sum(axis=2)
    between = norms[:, :, None] + norms[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
    chosen = np.zeros((t, c), bool)
    closest = np.full((t, c), _FAR, np.float32)  # of each candidate to the chosen ones
    left = np.full(t, m)
    for j in range(c):
        take = (d[:, j] < closest[:, j]) & (left > 0) & ~np.isinf(d[:, j])
        chosen[:, j] = take
        left -= take
        closest = np.where(take[:, None], np.minimum(closest, between[:, j]), closest)
    rank = np.where(chosen, 0, c) + np.arange(c)
    rank[np.isinf(d)] = 3 * c
    order = np.argsort(rank, axis=1, kind="stable")[:, :m]
    return np.where(np.take_along_axis(rank, order, 1) >= 3 * c, -1, np.take_along_axis(ids, order, 1))


def _own(vectors: np.ndarray, norms: np.ndarray, nodes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Squared distances of nodes to their ids; infinite for -1."""
    d = _distances(vectors, norms, vectors[nodes], ids) + norms[nodes][:, None]
    return np.where(ids < 0, _FAR, np.maximum(d, 0))


def _sorted(ids: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(d, axis=1, kind="stable")
    return np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)


def _link_back(vectors: np.ndarray, norms: np.ndarray, links: np.ndarray, first: int, last: int) -> None:
    """Add the links of the nodes first..last to their neighbours' lists, keeping a spread of each list that overflows."""
    width = links.shape[1]
    source = np.repeat(np.arange(first, last), width)
    target = links[first:last].ravel()
    source, target = source[target >= 0], target[target >= 0]
    order = np.lexsort((source, target))
    source, target = source[order], target[order]
    starts = np.flatnonzero(np.concatenate(([True], target[1:] != target[:-1]))) if len(target) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(starts, len(target)))
    for low in range(0, len(starts), _BATCH):
        at, size = starts[low : low + _BATCH], sizes[low : low + _BATCH]
        nodes, most = target[at], int(size.max())
        new = np.full((len(at), most), -1, np.int64)
        within = np.arange(most)[None, :] < size[:, None]
        new[within] = source[(at[:, None] + np.arange(most)[None, :])[within]]
        old = links[nodes]
        new[(new[:, :, None] == old[:, None, :]).any(axis=2)] = -1  # members of one batch may have chosen each other
        both = np.concatenate((old, new), axis=1)
        both, d = _sorted(both, _own(vectors, norms, nodes, both))
        kept = max(width, int((~np.isinf(d)).sum(axis=1).max()))
        links[nodes] = _spread(vectors, both[:, :kept], d[:, :kept], width)[:, :width]


def _reached(links: np.ndarray) -> np.ndarray:
    """Which nodes a walk from node 0 comes to."""
    seen = np.zeros(len(links) + 1, bool)
    front = np.zeros(1, np.int64)
    seen[[0, -1]] = True
    while len(front):
        around = np.unique(links[front])
        front = around[~seen[around]]
        seen[front] = True
    return seen[:-1]


def _connect(links: np.ndarray, rounds: int = 4) -> None:
    """Link nodes that no walk from node 0 comes to from one of their own neighbours, in a free place or the last one."""
    for _ in range(rounds):
        lost = np.flatnonzero(~_reached(links))
        for node in lost.tolist():
            around = links[node][links[node] >= 0]
            free = [(int(t), int(np.flatnonzero(links[t] < 0)[0])) for t in around if (links[t] < 0).any()]
            host, place = free[0] if free else (int(around[node % len(around)]), links.shape[1] - 1)
            if node not in links[host]:
                links[host, place] = node
        if not len(lost):
            return


def build(vectors: np.ndarray, links: int = LINKS, ef: int = EF_BUILD) -> list[np.ndarray]:
    """The neighbour arrays of all levels, level 0 first. ``vectors`` are in insertion order, which should be random."""
    sizes = levels(len(vectors), links)
    vectors = np.ascontiguousarray(vectors, np.float32)
    norms = (vectors * vectors).sum(axis=1)
    graph: list[np.ndarray] = []
    for level in range(len(sizes) - 1, -1, -1):
        size, width = int(sizes[level]), links if level else 2 * links
        flat = np.full((size, width), -1, np.int64)
        done = 0
        while done < size:
            last = min(size, done + min(_BATCH, max(done, links)))
            batch = np.arange(done, last)
            queries = vectors[batch]
            # the batch itself: every member sees the others
            mates = norms[batch][None, :] - 2 * queries @ queries.T
            mates[np.arange(len(batch)), np.arange(len(batch))] = _FAR
            ids, d = np.broadcast_to(batch, mates.shape), mates
            if done:
                entry = descend(vectors, norms, graph, queries)
                found, near = _search(vectors, norms, flat, queries, np.where(entry < done, entry, -1), min(ef, done), done)
                ids, d = np.concatenate((found, ids), axis=1), np.concatenate((near, d), axis=1)
            ids, d = _sorted(ids, d)
            ids, d = ids[:, : ef + links], d[:, : ef + links]
            chosen = _spread(vectors, ids, np.where(ids < 0, _FAR, d + norms[batch][:, None]), links)
            flat[done:last, : chosen.shape[1]] = chosen[:, :width]
            _link_back(vectors, norms, flat, done, last)
            done = last
        _connect(flat)
        graph.insert(0, flat)
    return graph


def descend(vectors: np.ndarray, norms: np.ndarray, upper: list[np.ndarray], queries: np.ndarray, ef: int = ENTRIES) -> np.ndarray:
    """Entries for the level below ``upper`` (the lowest first): the nearest nodes found from the top down (-1: none)."""
    entry = np.zeros((len(queries), 1), np.int64)
    for flat in reversed(upper):
        entry, _ = _search(vectors, norms, flat, queries, entry, min(ef, len(flat)), len(flat))
    return entry


def search(vectors: np.ndarray, graph: list[np.ndarray], queries: np.ndarray, ef: int) -> np.ndarray:
    """The ``ef`` nearest nodes found for each query (-1: none), by single-precision distances; all nodes where there are fewer."""
    if len(vectors) <= ef:
        return np.broadcast_to(np.arange(len(vectors)), (len(queries), len(vectors)))
    vectors = np.ascontiguousarray(vectors, np.float32)
    norms = (vectors * vectors).sum(axis=1)
    out = [np.zeros((0, ef), np.int64)]
    for low in range(0, len(queries), _BATCH):
        part = np.ascontiguousarray(queries[low : low + _BATCH], np.float32)
        entry = descend(vectors, norms, graph[1:], part)
        out.append(_search(vectors, norms, graph[0], part, entry, ef, len(vectors))[0])
    return np.concatenate(out)
