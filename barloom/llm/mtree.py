"""A paged metric tree in memory, searched best-first by many queries together.

Vectors of whole numbers are placed in a Euclidean space with one more dimension, in which a larger
inner product with a query is a smaller distance: a vector x gets the coordinate
sqrt(M - |x|^2), M the greatest |x|^2, a query gets 0, and |q - x|^2 = |q|^2 + M - 2 q.x.

Each query visits pages in the order of their bounds, as it would alone. Queries whose next page is
the same are answered together, by one product with the page's entries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Entries of a page.
PAGE = 256
#: Choices of routing vectors that are compared when a page is split.
TRIES = 3
#: Bounds are computed in floating point; they give way by so much of the space's extent.
SLACK = 1e-9

#: The ends of the range of scores; products beyond them count as the end.
HIGHEST = 2**63 - 1
LOWEST = -HIGHEST


@dataclass
class Page:
    """A node: a routing vector, how far its vectors reach, and its entries' distances to it."""

    number: int
    parent: int
    pivot: np.ndarray
    radius: float
    apart: float  # distance to the parent's pivot
    entries: np.ndarray | None  # rows of the block, in a leaf
    distances: np.ndarray  # of the entries, or of the child pages' pivots, to the own pivot
    children: list[int] = field(default_factory=list)


def lifted(vectors: np.ndarray, top: float) -> np.ndarray:
    """Vectors with the coordinate that makes all of them equally long."""
    rows = vectors.astype(np.float64)
    left = np.maximum(top - (rows * rows).sum(axis=1), 0)
    return np.concatenate([rows, np.sqrt(left)[:, None]], axis=1)


def distances(point: np.ndarray, rows: np.ndarray) -> np.ndarray:
    apart = rows - point
    return np.sqrt((apart * apart).sum(axis=1))


def between(points: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Distances of all points to all rows; less exact than ``distances`` where they are near."""
    squares = (points * points).sum(axis=1)[:, None] + (rows * rows).sum(axis=1)
    return np.sqrt(np.maximum(squares - 2 * (points @ rows.T), 0))


def _dealt(points: np.ndarray, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Routing vectors and the nearest of them to each point: of some choices, each spread out
    from another start and moved to the middle of its points, the one that reaches least far."""
    best = None
    for turn in range(TRIES):
        chosen = [(seed + turn * 7919) % len(points)]
        far = distances(points[chosen[0]], points)
        while len(chosen) < count:
            chosen.append(int(far.argmax()))
            far = np.minimum(far, distances(points[chosen[-1]], points))
        pivots = points[chosen]
        nearest = between(points, pivots).argmin(axis=1)
        pivots = np.stack([
            points[nearest == i].mean(axis=0) if (nearest == i).any() else pivots[i] for i in range(count)
        ])
        apart = between(points, pivots)
        nearest = apart.argmin(axis=1)
        reach = apart[np.arange(len(points)), nearest].sum()
        if best is None or reach < best[0]:
            best = reach, pivots, nearest
    return best[1], best[2]


def build(points: np.ndarray) -> list[Page]:
    """Pages of a block of lifted vectors, the root first; every page holds at most PAGE entries."""
    pages: list[Page] = []

    def add(rows: np.ndarray, parent: int, pivot: np.ndarray, apart: float) -> int:
        own = len(pages)
        far = distances(pivot, points[rows])
        radius = float(far.max()) if len(far) else 0.0
        leaf = len(rows) <= PAGE
        page = Page(own, parent, pivot, radius, apart, rows if leaf else None, far)
        pages.append(page)
        if leaf:
            return own
        count = min(PAGE, -(-len(rows) // PAGE) + 1)
        pivots, nearest = _dealt(points[rows], count, own)
        groups = [(pivots[i], rows[nearest == i]) for i in range(count) if (nearest == i).any()]
        if max(len(g) for _, g in groups) > 0.9 * len(rows):  # little tells them apart: cut evenly
            parts = np.array_split(rows[np.argsort(far, kind="stable")], count)
            groups = [(points[part].mean(axis=0), part) for part in parts]
        gaps = [float(g) for g in distances(pivot, np.stack([p for p, _ in groups]))]
        page.children = [add(g, own, p, gap) for (p, g), gap in zip(groups, gaps, strict=True)]
        page.distances = np.array(gaps)
        return own

    if len(points):
        add(np.arange(len(points)), -1, points.mean(axis=0), 0.0)
    return pages


def products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact; those beyond the range of scores at its ends."""
    if not rows.size:
        return np.zeros((len(queries), len(rows)), dtype=np.int64)
    most = np.abs(queries).max(axis=1) * np.abs(rows).max() * rows.shape[1]
    out = np.empty((len(queries), len(rows)), dtype=np.int64)
    small, whole = most < 2**53, most < 2**62
    out[small] = (queries[small] @ rows.T).astype(np.int64)
    middle = whole & ~small & (np.abs(queries).max(axis=1) < 2**62)
    if middle.any() and np.abs(rows).max() < 2**62:
        out[middle] = queries[middle].astype(np.int64) @ rows.T.astype(np.int64)
        small = small | middle
    if not small.all():
        exact = [[int(x) for x in row] for row in rows.tolist()]
        for i in np.nonzero(~small)[0]:
            query = [int(x) for x in queries[i].tolist()]
            scores = (sum(a * b for a, b in zip(query, row, strict=True)) for row in exact)
            out[i] = [min(max(s, LOWEST), HIGHEST) for s in scores]
    return out


class Best:
    """The k best entries so far of each of some queries."""

    def __init__(self, vectors: np.ndarray, rows: np.ndarray, floors: np.ndarray, floored: np.ndarray, k: int):
        self.vectors, self.rows, self.k = vectors.astype(np.float64), rows, k
        self.squares = (self.vectors * self.vectors).sum(axis=1)
        self.points = np.concatenate([self.vectors, np.zeros((len(vectors), 1))], axis=1)
        #: No score below this is among the k best; LOWEST while that is not known.
        self.worst = np.where(floored, floors, LOWEST)
        self.known = floored.copy()
        self.found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = [
            (np.zeros(0, np.int64),) * 3 for _ in range(len(vectors))
        ]  # scores, ids and rows of each query's best, in order

    def limits(self, top: float) -> np.ndarray:
        """No entry of use is farther from each query than this."""
        slack = SLACK * (self.squares + top + 1)
        extent = np.maximum(self.squares + top - 2.0 * self.worst, 0) + slack
        return np.where(self.known, np.sqrt(extent) * (1 + SLACK), np.inf)

    def add(self, group: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        """Scores of some entries, a line per query of the group."""
        useful = (scores >= self.worst[group][:, None]) & (rows[None, :] != self.rows[group][:, None])
        for line in np.nonzero(useful.any(axis=1))[0]:
            q, some = int(group[line]), useful[line]
            s, i, r = self.found[q]
            s = np.concatenate([s, scores[line, some]])
            i, r = np.concatenate([i, ids[some]]), np.concatenate([r, rows[some]])
            order = np.lexsort((r, i, -s))[: self.k]
            self.found[q] = s[order], i[order], r[order]
            if len(order) == self.k:
                self.worst[q] = max(self.worst[q], s[order[-1]])
                self.known[q] = True


class Search:
    """Exact search of one block: its pages, and ids, row numbers and whole numbers of its vectors."""

    def __init__(self, pages: list[Page], ids: np.ndarray, rows: np.ndarray, vectors: np.ndarray, top: float):
        self.pages, self.ids, self.rows, self.top = pages, ids, rows, top
        self.vectors = vectors.astype(np.float64)
        self.reached = 0  # products that were computed

    def nearest(self, best: Best) -> None:
        """Add the block's entries to the queries' best, best-first by page."""
        if not self.pages or not len(best.rows):
            return
        shape = (len(best.rows), len(self.pages))
        bounds, gaps = np.full(shape, np.inf), np.zeros(shape)
        gaps[:, 0] = between(best.points, self.pages[0].pivot[None])[:, 0]
        bounds[:, 0] = 0.0
        waiting = np.arange(len(best.rows))
        while len(waiting):
            limits = best.limits(self.top)
            near = bounds[waiting].argmin(axis=1)
            least = bounds[waiting, near]
            going = np.isfinite(least) & ~(least > limits[waiting])
            waiting, near = waiting[going], near[going]
            for number in np.unique(near):
                group = waiting[near == number]
                bounds[group, number] = np.inf
                self._visit(self.pages[number], group, best, limits[group], bounds, gaps)

    def _visit(self, page: Page, group: np.ndarray, best: Best, limits, bounds, gaps) -> None:
        """A page for the queries whose next one it is.

        The stored distance of an entry to the page's pivot and the query's own bound their
        distance from below; entries that are too far for every query of the group are left out.
        """
        apart = np.abs(gaps[group, page.number][:, None] - page.distances)
        if page.entries is None:
            radii = np.array([self.pages[c].radius for c in page.children])
            use = ~(apart - radii > limits[:, None] + self._slack(best, group))
            some = np.nonzero(use.any(axis=0))[0]
            children = [page.children[i] for i in some]
            if not children:
                return
            far = between(best.points[group], np.stack([self.pages[c].pivot for c in children]))
            least = np.maximum(far - radii[some] - self._slack(best, group), 0)
            for i, child in enumerate(children):
                mine = use[:, some[i]]
                gaps[group[mine], child] = far[mine, i]
                bounds[group[mine], child] = np.where(np.isnan(least[mine, i]), 0.0, least[mine, i])
            return
        use = ~(apart > limits[:, None] + self._slack(best, group))
        some = np.nonzero(use.any(axis=0))[0]
        if not len(some):
            return
        rows = page.entries[some]
        self.reached += len(rows) * len(group)
        scores = products(best.vectors[group], self.vectors[rows])
        best.add(group, scores, self.ids[rows], self.rows[rows])

    def _slack(self, best: Best, group: np.ndarray) -> np.ndarray:
        """What distances by one product may be off: the root of rounding errors of squares."""
        return np.sqrt(SLACK * 1e-3 * (best.squares[group] + self.top + 1))[:, None]
