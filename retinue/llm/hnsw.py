"""A hierarchical navigable small-world graph in numpy, built and searched many points at a time."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np

#: Points that are searched together.
QUERIES = 256
#: Candidates of a search that are expanded at once, and the part of a wide beam that is.
STEP = 4
STEPS = 8
#: Places of beams that a block of searches holds together; wider beams are fewer.
PLACES = 1 << 18
#: Pairs whose cosines are computed at a time.
PAIRS = 1 << 12
#: A level with so many points at most is compared whole.
WHOLE = 256
#: No place in a beam: it sorts last and counts as expanded.
NONE = np.uint64((1 << 64) - 1)


def cosines(queries: np.ndarray, rows: np.ndarray, vectors: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Of pairs of a query and a vector. Room is used again, as fresh memory takes longer than the sums."""
    out = np.empty(len(rows), np.float32)
    room = np.empty((2, min(PAIRS, len(rows)), vectors.shape[1]), np.float32)
    for start in range(0, len(rows), PAIRS):
        own = slice(start, start + PAIRS)
        a, b = room[:, : len(rows[own])]
        queries.take(rows[own], axis=0, out=a, mode="clip")
        vectors.take(points[own], axis=0, out=b, mode="clip")
        np.einsum("nd,nd->n", a, b, out=out[own])
    return out


def _first(values: np.ndarray) -> np.ndarray:
    """Which of sorted values are the first of equal ones."""
    new = np.ones(len(values), bool)
    np.not_equal(values[1:], values[:-1], out=new[1:])
    return new


class Graph:
    """Unit vectors linked on levels; ``vectors`` are sorted so that each level is a beginning of them."""

    def __init__(self, vectors: np.ndarray, links: list[np.ndarray], beam: int, doors: list[int] | None = None):
        self.vectors, self.links, self.beam = vectors, links, beam
        #: Points at which every search of the lowest level also begins, see ``open_doors``.
        self.doors = doors or []

    def __len__(self) -> int:
        return len(self.vectors)

    def tobytes(self) -> bytes:
        return pickle.dumps((self.vectors, self.links, self.beam, self.doors), protocol=5)

    @classmethod
    def frombytes(cls, data: bytes) -> Graph:
        return cls(*pickle.loads(data))

    def _walk(self, level: int, queries: np.ndarray, entries: np.ndarray, beam: int, limit: int):
        """Best ``beam`` points for each query on a level, best first, from its entries (-1 for none).

        Expands the best points of each beam until the beam has no other. Only the first
        ``limit`` points exist. A place in a beam is a number: its bits are the distance, the
        point and whether that is expanded, so that sorting numbers sorts places.
        """
        links, vectors = self.links[level], self.vectors
        n, span = len(queries), limit + 1
        width = max(beam, entries.shape[1])
        step = max(STEP, width // STEPS)
        # A flag for each query and point, and before them one for -1, no point.
        seen = np.zeros(n * span, bool)
        first = np.arange(n, dtype=np.int32 if n * span < 1 << 31 else np.int64) * span + 1
        seen[first - 1] = True
        beams = np.full((n, width), NONE)
        live = np.arange(n)
        rows, j = np.nonzero(entries >= 0)
        near = first[rows] + entries[rows, j]
        while True:
            near = near[~seen.take(near)]
            near.sort()
            near = near[_first(near)]
            seen[near] = True
            rows = near // span
            points = near - rows * span - 1
            apart = np.maximum(1 - cosines(queries, rows, vectors, points), 0).view(np.uint32)
            worst = (beams[:, -1] >> 32).astype(np.uint32)
            better = np.flatnonzero(apart <= worst.take(rows))
            if len(better):
                rows = rows[better]
                places = apart[better].astype(np.uint64) << 32 | points[better].astype(np.uint64) << 1
                starts = np.flatnonzero(_first(rows))
                counts = np.diff(starts, append=len(rows))
                own = rows[starts]
                wide = np.full((len(own), width + int(counts.max())), NONE)
                wide[:, :width] = beams[own]
                at = np.arange(len(rows)) - np.repeat(starts - width, counts)
                wide[np.repeat(np.arange(len(own)), counts), at] = places
                wide.sort(axis=1)
                beams[own] = wide[:, :width]
            open_ = (beams[live] & 1) == 0
            alive = open_.any(axis=1)
            live, open_ = live[alive], open_[alive]
            if not len(live):
                break
            i, j = np.nonzero(open_ & (np.cumsum(open_, axis=1, dtype=np.int32) <= step))
            rows = live[i]
            best = beams[rows, j]
            beams[rows, j] = best | 1
            points = (best & 0xFFFFFFFF).astype(np.int64) >> 1
            near = (links.take(points, axis=0) + first[rows][:, None]).ravel()
        beams = beams[:, :beam]
        ids = ((beams & 0xFFFFFFFF) >> 1).astype(np.int32)
        sims = 1 - (beams >> 32).astype(np.uint32).view(np.float32)
        ids[beams == NONE], sims[beams == NONE] = -1, -np.inf
        return ids, sims

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1 where there are fewer) and cosines of the ``beam`` best points found for each query."""
        entries = np.zeros((len(queries), 1), np.int32)
        for level in range(len(self.links) - 1, 0, -1):
            size = len(self.links[level])
            if size > WHOLE:
                entries, _ = self._walk(level, queries, entries, STEP, size)
            elif len(self.links[level - 1]) > WHOLE or level == 1:
                step = min(STEP, size)
                best = np.argpartition(queries @ -self.vectors[:size].T, step - 1, axis=1)
                entries = best[:, :step].astype(np.int32)
        if self.doors:
            doors = np.broadcast_to(np.array(self.doors, np.int32), (len(queries), len(self.doors)))
            entries = np.concatenate([entries, doors], axis=1)
        return self._walk(0, queries, entries, min(beam, len(self)), len(self))

    def open_doors(self) -> None:
        """Where links alone do not lead from the first point to all others, begin at more points."""
        links, reached, self.doors = self.links[0], np.zeros(len(self), bool), []
        start = 0
        while True:
            reached[start] = True
            front = np.array([start])
            while len(front):
                ahead = np.unique(links[front])
                front = ahead[(ahead >= 0) & ~reached[ahead]]
                reached[front] = True
            if reached.all():
                return
            start = int(np.argmin(reached))
            self.doors.append(start)

    def finds(self, queries: np.ndarray, least: float, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (query, point) with a cosine of ``least`` or more, all pairs of a query at once.

        A query whose whole beam is that close may have more: its beam is widened fourfold
        until it is not, or has seen every point. Such queries of all blocks go together.
        """
        rows, width = np.arange(len(queries)), beam
        while len(rows):
            block = min(QUERIES, max(1, PLACES // width))
            wide = []
            for first in range(0, len(rows), block):
                own = rows[first : first + block]
                ids, sims = self.search(queries[own], width)
                close = (sims >= least) & (ids >= 0)
                full = close.all(axis=1) & (ids.shape[1] < len(self))
                i, j = np.nonzero(close & ~full[:, None])
                yield own[i], ids[i, j].astype(np.int64)
                wide.append(own[full])
            rows, width = np.concatenate(wide), width * 4

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """All pairs of :meth:`finds`."""
        none = np.empty(0, np.int64)
        pairs = [(none, none), *self.finds(queries, least, beam)]
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def _select(vectors: np.ndarray, points: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` of the candidates of each point, best first, none closer to a chosen one than to the point.

    Room that is left goes to the best of the others. Candidates are sorted, -1 for none.
    """
    n = len(points)
    chosen = np.full((n, most), -1, np.int32)
    taken = np.zeros(ids.shape, bool)
    count = np.zeros(n, np.int64)
    rows = np.arange(n)
    for c in range(ids.shape[1]):
        candidate = ids[:, c]
        ok = (candidate >= 0) & (count < most)
        if not ok.any():
            continue
        reach = int(count.max())
        if reach:
            others = np.einsum("nd,nkd->nk", vectors[candidate], vectors[chosen[:, :reach]])
            ok &= (np.where(chosen[:, :reach] >= 0, others, -np.inf) < sims[:, c, None]).all(axis=1)
        chosen[rows[ok], count[ok]] = candidate[ok]
        taken[ok, c] = True
        count += ok
    for c in range(ids.shape[1]):
        ok = (ids[:, c] >= 0) & ~taken[:, c] & (count < most)
        chosen[rows[ok], count[ok]] = ids[ok, c]
        count += ok
    return chosen


def _link(graph: Graph, level: int, points: np.ndarray, ids: np.ndarray, sims: np.ndarray, most: int) -> None:
    """Link new points to the best of their candidates, and these back to them."""
    links, vectors = graph.links[level], graph.vectors
    room = links.shape[1]
    chosen = _select(vectors, points, ids, sims, most)
    links[points, :most] = chosen
    i, j = np.nonzero(chosen >= 0)
    target, source = chosen[i, j].astype(np.int64), points[i]
    closeness = np.einsum("nd,nd->n", vectors[target], vectors[source])
    order = np.lexsort((-closeness, target))
    target, source = target[order], source[order]
    rank = np.arange(len(target)) - np.searchsorted(target, target)
    target, source, rank = target[rank < room], source[rank < room], rank[rank < room]
    ends, place = np.unique(target, return_inverse=True)
    old = links[ends]
    wide = np.concatenate([old, np.full((len(ends), room), -1, np.int32)], axis=1)
    wide[place, room + rank] = source
    known = (wide[:, room:, None] == old[:, None, :]).any(axis=2)
    wide[:, room:][known] = -1
    near = np.where(wide >= 0, np.einsum("nd,nkd->nk", vectors[ends], vectors[wide]), -np.inf)
    order = np.argsort(-near, axis=1, kind="stable")
    wide, near = np.take_along_axis(wide, order, axis=1), np.take_along_axis(near, order, axis=1)
    crowded = (wide >= 0).sum(axis=1) > room
    links[ends[~crowded]] = wide[~crowded, :room]
    if crowded.any():
        links[ends[crowded]] = _select(vectors, ends[crowded], wide[crowded], near[crowded], room)


def levels(uniform: np.ndarray, degree: int) -> np.ndarray:
    """Level of each point: each has about ``degree`` times fewer points than the one below."""
    return np.minimum((-np.log(uniform) / np.log(degree)).astype(np.int64), 12)


def build(vectors: np.ndarray, level: np.ndarray, *, degree: int = 12, beam: int = 64) -> Graph:
    """Graph of unit vectors that are sorted by falling ``level``; twice ``degree`` links on the lowest.

    Points come in batches that grow with the graph. A batch is searched together and its
    points are candidates of each other, so copies that arrive together find each other.
    """
    n = len(vectors)
    sizes = [int((level >= k).sum()) for k in range(int(level.max()) + 1 if n else 1)]
    links = [np.full((size, degree * 2 if k == 0 else degree), -1, np.int32) for k, size in enumerate(sizes)]
    graph = Graph(vectors, links, beam)
    start = 0
    while start < n:
        end = min(n, start + min(max(64, start // 2), QUERIES))
        points = np.arange(start, end)
        queries = vectors[start:end]
        entries = np.zeros((len(points), 1), np.int32)
        own = queries @ queries.T
        np.fill_diagonal(own, -np.inf)
        for k in range(len(sizes) - 1, -1, -1):
            limit = min(start, sizes[k])
            joins = min(end, sizes[k]) - start
            if limit:
                wide = beam if joins > 0 else STEP
                entries, sims = graph._walk(k, queries, entries, min(wide, limit), limit)
            if joins > 0:
                mates = np.broadcast_to(points[:joins], (joins, joins)).astype(np.int32)
                ids, near = mates, own[:joins, :joins]
                if limit:
                    ids = np.concatenate([entries[:joins], mates], axis=1)
                    near = np.concatenate([sims[:joins], near], axis=1)
                order = np.argsort(-near, axis=1, kind="stable")[:, :beam]
                ids, near = np.take_along_axis(ids, order, axis=1), np.take_along_axis(near, order, axis=1)
                _link(graph, k, points[:joins], np.where(near > -np.inf, ids, -1), near, degree)
            entries = entries[:, :STEP] if limit else entries
        start = end
    if n:
        graph.open_doors()
    return graph


def audit(graph: Graph, least: float, target: float, rng: np.random.Generator, probes: int = 128) -> int:
    """The beam with which the graph finds a share ``target`` of what brute force finds.

    Probes are points of the graph, half of them moved to just above the least cosine, so
    that there is something to find around each. That the others find themselves does not
    count. The share is the mean over probes, so that a few with many links do not hide
    others that lose theirs. The beam doubles until the share is reached, or it holds the
    whole graph.
    """
    n, dims = graph.vectors.shape
    chosen = rng.permutation(n)[:probes]
    queries = graph.vectors[chosen].astype(np.float64)
    noise = rng.normal(size=queries.shape)
    noise -= (noise * queries).sum(axis=1, keepdims=True) * queries
    noise /= np.maximum(np.linalg.norm(noise, axis=1, keepdims=True), 1e-12)
    cosine = min(1.0, least + 0.01)
    moved = cosine * queries + np.sqrt(1 - cosine * cosine) * noise
    unmoved = (np.arange(len(chosen)) % 2 == 1) | (dims == 1)
    queries[~unmoved] = moved[~unmoved]
    queries = queries.astype(np.float32)
    wanted = queries @ graph.vectors.T >= least
    wanted[unmoved, chosen[unmoved]] = False
    links = wanted.sum(axis=1)
    some = links > 0
    while True:
        rows, ids = graph.within(queries, least, graph.beam)
        found = np.bincount(rows, wanted[rows, ids], len(chosen))
        if not some.any() or (found[some] / links[some]).mean() >= target or graph.beam >= n:
            return graph.beam
        graph.beam *= 2
