"""Hierarchical navigable small-world graph of one shard, as flat neighbour arrays.

Nodes are numbered in the order in which they are inserted, those of the highest levels
first; so a level holds the nodes 0 … count - 1, and its links are one matrix with a row a
node, -1 where a node has fewer. Nodes are inserted in batches that search the graph so far
side by side.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

_CELLS = 1 << 22


@dataclass
class Graph:
    """``points`` (float32) of one shard and, by level, the matrix of links."""

    points: np.ndarray
    links: list[np.ndarray] = field(default_factory=list)

    @property
    def flat(self) -> tuple[np.ndarray, list[int], list[int]]:
        """All links in one array, with the number of nodes and of columns of each level."""
        joined = [x.ravel() for x in self.links]
        return (
            np.concatenate(joined) if joined else np.zeros(0, dtype=np.int32),
            [x.shape[0] for x in self.links],
            [x.shape[1] for x in self.links],
        )

    @staticmethod
    def from_flat(points: np.ndarray, flat: np.ndarray, counts: list[int], columns: list[int]) -> Graph:
        cuts = np.cumsum([0, *(a * b for a, b in zip(counts, columns, strict=True))])
        links = [flat[x:y].reshape(a, b) for x, y, a, b in zip(cuts, cuts[1:], counts, columns, strict=False)]
        return Graph(points, links)

    def beam(
        self, level: int, queries: np.ndarray, seeds: np.ndarray, width: int, size: int
    ) -> tuple[np.ndarray, np.ndarray]:
        """The ``width`` nearest nodes found on a level from the seeds of each query.

        Returns nodes (-1: none) and squared distances, nearest first. Only nodes below
        ``size`` are in the graph yet. Each round, every query expands its two nearest
        nodes not yet expanded, until its beam holds none.
        """
        links, rows = self.links[level], len(queries)
        nodes = np.full((rows, width), -1, dtype=np.int32)
        far = np.full((rows, width), np.inf, dtype=np.float32)
        seen = np.zeros((rows, size + 1), dtype=bool)  # the last column takes what is no node
        seen[:, size] = True
        done = np.zeros((rows, width), dtype=bool)
        self._join(queries, np.arange(rows), seeds, nodes, far, done, seen)
        active = np.arange(rows)
        while len(active):
            at = np.arange(len(active))
            open_ = np.where(done[active] | (nodes[active] < 0), np.inf, far[active])
            found = []
            for _ in range(min(2, width)):
                best = open_.argmin(axis=1)
                some = np.isfinite(open_[at, best])
                done[active[some], best[some]] = True
                node = np.where(some, nodes[active, best], -1)
                found.append(np.where(node[:, None] >= 0, links[node], -1))
                open_[at, best] = np.inf
            self._join(queries, active, np.concatenate(found, axis=1), nodes, far, done, seen)
            active = active[(~done[active] & (nodes[active] >= 0)).any(axis=1)]
        return nodes, far

    def _join(self, queries, who, new, nodes, far, done, seen):
        """Puts nodes not seen before into the beams of the queries ``who``."""
        size, half = seen.shape[1] - 1, new.shape[1] // 2
        # Rows of links repeat no node, but the two rows of a query may share some.
        for part in (slice(0, half), slice(half, None)):
            some = np.where(new[:, part] < 0, size, new[:, part])
            fresh = ~seen[who[:, None], some]
            new[:, part] = np.where(fresh, new[:, part], -1)
            seen[who[:, None], some] = True
        away = self.distances(queries[who], new)
        width = nodes.shape[1]
        every = np.concatenate([far[who], away], axis=1)
        if every.shape[1] > width:
            near = np.argpartition(every, width - 1, axis=1)[:, :width]
        else:
            near = np.broadcast_to(np.arange(every.shape[1]), every.shape)
        order = np.take_along_axis(near, np.take_along_axis(every, near, axis=1).argsort(axis=1), axis=1)
        far[who] = np.take_along_axis(every, order, axis=1)
        nodes[who] = np.take_along_axis(np.concatenate([nodes[who], new], axis=1), order, axis=1)
        was = np.concatenate([done[who], np.zeros(new.shape, dtype=bool)], axis=1)
        done[who] = np.take_along_axis(was, order, axis=1)

    def distances(self, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
        """Squared distances of each query to the nodes of its row; infinite for -1."""
        out = np.empty(nodes.shape, dtype=np.float32)
        step = max(1, _CELLS // max(1, nodes.shape[1] * queries.shape[1]))
        for k in range(0, len(queries), step):
            away = self.points[nodes[k : k + step]] - queries[k : k + step, None, :]
            out[k : k + step] = np.einsum("abc,abc->ab", away, away)
        return np.where(nodes < 0, np.float32(np.inf), out)

    def search(self, queries: np.ndarray, width: int) -> np.ndarray:
        """The ``width`` nearest nodes found for each query (-1: none), nearest first."""
        if not len(self.points):
            return np.full((len(queries), width), -1, dtype=np.int32)
        seeds = np.zeros((len(queries), 2), dtype=np.int32)
        seeds[:, 1] = -1
        for level in reversed(range(1, len(self.links))):
            size = len(self.links[level])
            seeds = self.beam(level, queries, seeds, min(size, 16), size)[0]
        return self.beam(0, queries, seeds, width, len(self.points))[0]


def _diverse(points: np.ndarray, nodes: np.ndarray, away: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of each row's nodes (sorted by distance) as links.

    A node is taken where it is nearer to the row's own point than to any node taken before;
    free places go to the nearest of the others.
    """
    rows, count = nodes.shape
    if count <= most:
        return nodes
    out = np.full((rows, most), -1, dtype=np.int32)
    step = max(1, _CELLS // (count * max(count, points.shape[1])))
    for k in range(0, rows, step):
        part, far = nodes[k : k + step], away[k : k + step]
        here = points[part]
        norm = np.einsum("abc,abc->ab", here, here)
        between = norm[:, :, None] + norm[:, None, :] - 2 * (here @ here.transpose(0, 2, 1))
        taken = np.zeros(part.shape, dtype=bool)
        nearest = np.full(part.shape, np.inf, dtype=np.float32)
        left = np.full(len(part), most)
        for j in range(count):
            yes = (part[:, j] >= 0) & (far[:, j] < nearest[:, j]) & (left > 0)
            taken[:, j] = yes
            left -= yes
            np.minimum(nearest, np.where(yes[:, None], between[:, j], np.inf), out=nearest)
            if not left.any():
                break
        # Taken first, then by distance; -1 last.
        rank = np.where(part < 0, 2, ~taken) * count + np.arange(count)
        pick = np.sort(rank, axis=1)[:, :most] % count
        out[k : k + step] = np.take_along_axis(part, pick, axis=1)
    return out


def _add_back(graph: Graph, level: int, own: np.ndarray, links: np.ndarray) -> None:
    """The links of new nodes as links of their ends; full rows choose anew."""
    table = graph.links[level]
    most = table.shape[1]
    source = np.repeat(own, links.shape[1])
    end = links.ravel()
    source, end = source[end >= 0], end[end >= 0]
    if not len(end):
        return
    order = np.argsort(end, kind="stable")
    source, end = source[order], end[order]
    first = np.flatnonzero(np.concatenate([[True], end[1:] != end[:-1]]))
    counts = np.diff(np.append(first, len(end)))
    ends = end[first]
    held = (table[ends] >= 0).sum(axis=1)
    room = held + counts <= most
    at = np.arange(len(end)) - np.repeat(first, counts) + np.repeat(held, counts)
    easy = np.repeat(room, counts)
    table[end[easy], at[easy]] = source[easy]
    full = np.flatnonzero(~room)
    # Rows with many new links are few; rows of about the same number go together.
    order = full[np.argsort(counts[full])]
    for k in range(0, len(order), 256):
        some = order[k : k + 256]
        more = int(counts[some].max())
        nodes = np.full((len(some), most + more), -1, dtype=np.int32)
        nodes[:, :most] = table[ends[some]]
        for r, g in enumerate(some):
            nodes[r, most : most + counts[g]] = source[first[g] : first[g] + counts[g]]
        away = graph.distances(graph.points[ends[some]], nodes)
        by = away.argsort(axis=1)[:, : 2 * most]
        nodes, away = np.take_along_axis(nodes, by, axis=1), np.take_along_axis(away, by, axis=1)
        keep = max(1, most * 3 // 4)  # leaves room, so that rows are seldom chosen anew
        fewer = _diverse(graph.points, nodes, away, keep)
        table[ends[some]] = -1
        table[ends[some], : fewer.shape[1]] = fewer


def build(points: np.ndarray, levels: np.ndarray, *, links: int = 16, width: int = 64, batch: int = 256) -> Graph:
    """The graph of ``points``, whose ``levels`` fall from first to last.

    A node gets up to ``links`` links a level when it is inserted, chosen from the ``width``
    nearest nodes found and from its own batch; a row holds twice as many on level 0.
    """
    points = np.ascontiguousarray(points, dtype=np.float32)
    n, top = len(points), int(levels[0]) if len(levels) else -1
    graph = Graph(points)
    for level in range(top + 1):
        count = int(np.searchsorted(-levels, -level, side="right"))
        graph.links.append(np.full((count, links * 2 if level == 0 else links), -1, dtype=np.int32))
    at = 0
    while at < n:
        stop = min(n, at + (batch if at == 0 else min(batch, max(32, at // 2))))
        own = np.arange(at, stop, dtype=np.int32)
        new = points[at:stop]
        norm = np.einsum("ab,ab->a", new, new)
        peers = norm[:, None] + norm[None, :] - 2 * (new @ new.T)
        np.fill_diagonal(peers, np.inf)
        seeds = np.full((len(own), 2), -1, dtype=np.int32)
        if at:
            seeds[:, 0] = 0
        for level in reversed(range(top + 1)):
            size = len(graph.links[level])
            joins = min(stop, size) - at  # of the batch, those that belong to this level
            if at:
                nodes = np.full((len(own), width), -1, dtype=np.int32)
                away = np.full((len(own), width), np.inf, dtype=np.float32)
                some = max(0, joins)
                before = min(at, size)
                if some:
                    nodes[:some], away[:some] = graph.beam(level, new[:some], seeds[:some], width, before)
                if some < len(own):
                    few = min(16, width)
                    found = graph.beam(level, new[some:], seeds[some:], few, before)
                    nodes[some:, :few], away[some:, :few] = found
                seeds = nodes[:, :16].copy()
            if joins <= 0:
                continue
            near = peers[:joins, :joins].astype(np.float32)
            few = min(joins, links * 2)
            pick = np.argpartition(near, few - 1, axis=1)[:, :few]
            peer = np.where(np.isfinite(np.take_along_axis(near, pick, axis=1)), pick + at, -1)
            near = np.take_along_axis(near, pick, axis=1)
            if at:
                peer = np.concatenate([nodes[:joins], peer], axis=1)
                near = np.concatenate([away[:joins], near], axis=1)
            by = near.argsort(axis=1)
            chosen = _diverse(
                points,
                np.take_along_axis(peer, by, axis=1).astype(np.int32),
                np.take_along_axis(near, by, axis=1),
                links,
            )
            graph.links[level][own[:joins], : chosen.shape[1]] = chosen
            # Peers that chose each other have the link already.
            back = np.where(chosen >= at, _one_way(chosen, at), chosen)
            _add_back(graph, level, own[:joins], back)
        at = stop
    return graph


def _one_way(chosen: np.ndarray, at: int) -> np.ndarray:
    """Links within a batch whose end does not link back; -1 for the others."""
    rows = len(chosen)
    linked = np.zeros((rows, rows), dtype=bool)
    inside = (chosen >= at) & (chosen < at + rows)
    r, c = np.nonzero(inside)
    linked[r, chosen[r, c] - at] = True
    out = chosen.copy()
    both = linked[chosen[r, c] - at, r]
    out[r[both], c[both]] = -1
    return out
