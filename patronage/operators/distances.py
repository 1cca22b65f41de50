"""Sums of distances from points to the points of each cluster, in numpy.

Points stand in boxes that are halved at the middle of their widest side. Two boxes meet once: where the gap
between them is large enough for their sides, the distance is a smooth function of both
points, and polynomials through Chebyshev nodes stand for it (a box has a grid of nodes, few in the
directions in which it is flat); else they are opened, down to leaves, whose points meet one by one.

A distance as a function of one coordinate of a point in a box of half side h has no singularity in the
complex plane nearer to the side than the gap g, so that its Chebyshev coefficients fall at least as the powers
of ``g / h + sqrt(1 + (g / h)^2)``. A grid has as many nodes as bring that power below ``REST``, for the least
gap at which it is used; a box has a grid for each of the gaps ``APART``. What is left is
smaller still, as the coefficients of a root fall faster, and has either sign: sums of distances
were within 1e-11 of direct ones, and means of many rows nearer.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Least gaps at which the grids of a box are used, as multiples of its larger half side.
APART = (2.0, 3.0, 5.0)
#: Bound of the power at which a polynomial ends.
REST = 1e-9
#: Points of a leaf at most, but for copies.
LEAF_ROWS = 192
# How much larger than the gap a box may be that meets a grid; squares by a product of matrices then keep their digits.
_LARGER = 16
# Multiplications in a product of matrices that the library leaves to one thread.
_ALONE = 262_144

# More nodes than a box has points.
_NO_GRID = 2**40

#: How a box meets another: by the grid of that number, or by its points.
POINTS = len(APART)
KINDS = POINTS + 1


@dataclass
class Boxes:
    """Boxes as arrays; ``left`` and ``right`` are a box's halves, -1 for leaves. ``reach``, ``nodes``, ``cells``
    and ``gridded`` have a row a grid: the least gap, the nodes by direction, their product, and
    whether they are fewer than the points."""

    low: np.ndarray
    high: np.ndarray
    left: np.ndarray
    right: np.ndarray
    count: np.ndarray

    def __post_init__(self) -> None:
        self.half = (self.high - self.low) / 2
        self.middle = self.low + self.half
        self.widest = self.half.max(axis=1)
        self.leaf = self.left < 0
        self.reach = np.array(APART)[:, None] * self.widest
        ratio = np.full((len(APART), *self.half.shape), np.inf)
        some = np.broadcast_to(self.half > 0, ratio.shape)
        with np.errstate(invalid="ignore"):
            np.divide(self.reach[:, :, None], self.half, out=ratio, where=some)
        # No grid has so many nodes as one over a side without an end, or of very many columns.
        steps = np.nan_to_num(np.ceil(-np.log(REST) / np.arcsinh(ratio)), nan=_NO_GRID)
        self.nodes = np.where(some, np.clip(steps, 1, _NO_GRID), 1).astype(np.int64)
        cells = self.nodes.prod(axis=2, dtype=float)
        self.cells = np.minimum(cells, _NO_GRID).astype(np.int64)
        self.gridded = self.cells < self.count

    def __reduce__(self) -> tuple:
        # What follows from the edges is worked out again where it is needed, and not sent.
        return Boxes, (self.low, self.high, self.left, self.right, self.count)

    def grid(self, box: int, kind: int) -> np.ndarray:
        """The nodes of a box's grid."""
        sides = [
            middle + half * _chebyshev(n)
            for middle, half, n in zip(
                self.middle[box], self.half[box], self.nodes[kind, box], strict=True
            )
        ]
        return np.stack(np.meshgrid(*sides, indexing="ij"), axis=-1).reshape(-1, len(sides))

    def kind_within(self, box: int, gap: float) -> int:
        """The smallest grid that a box may be met by from ``gap`` away, ``POINTS`` for none."""
        some = np.flatnonzero(self.gridded[:, box] & (self.reach[:, box] <= gap))
        return int(some[-1]) if len(some) else POINTS

    def weights(self, box: int, kind: int, x: np.ndarray) -> list[np.ndarray]:
        """For each direction, what a node of the box's grid counts at each of the points."""
        found = []
        for c, n in enumerate(self.nodes[kind, box]):
            if n == 1:
                found.append(np.ones((len(x), 1)))
                continue
            at = np.clip((x[:, c] - self.middle[box, c]) / self.half[box, c], -1, 1)
            waves = np.cos(np.arccos(at)[:, None] * np.arange(n))
            found.append(waves @ _to_nodes(n))
        return found

    def onto_grid(self, box: int, kind: int, x: np.ndarray, w: np.ndarray) -> np.ndarray:
        """Weights of the grid's nodes, a column a cluster, that stand for weights ``w`` of points."""
        first, *rest = self.weights(box, kind, x)
        other = _products(rest, len(x))
        out = [(first * column[:, None]).T @ other for column in w.T]
        return np.stack([values.ravel() for values in out], axis=1)

    def off_grid(self, box: int, kind: int, values: np.ndarray, x: np.ndarray) -> np.ndarray:
        """Values at points from those at the grid's nodes."""
        first, *rest = self.weights(box, kind, x)
        other = _products(rest, len(x))
        parts = (first @ values.reshape(first.shape[1], -1)).reshape(len(x), other.shape[1], -1)
        return np.matmul(other[:, None, :], parts)[:, 0]


def _chebyshev(n: int) -> np.ndarray:
    return np.cos(np.pi * (np.arange(n) + 0.5) / n) if n > 1 else np.zeros(1)


def _to_nodes(n: int) -> np.ndarray:
    """What a wave of a polynomial of degree below ``n`` counts at each node."""
    waves = np.cos(np.arange(n)[:, None] * (np.pi * (np.arange(n) + 0.5) / n))
    waves *= 2 / n
    waves[0] /= 2
    return waves


def _products(sides: list[np.ndarray], n: int) -> np.ndarray:
    out = np.ones((n, 1))
    for side in sides:
        out = (out[:, :, None] * side[:, None, :]).reshape(n, -1)
    return out


def boxes_of(x: np.ndarray, most: int) -> tuple[Boxes, np.ndarray, np.ndarray]:
    """Boxes of points, the first around all, with at most ``most`` in a leaf unless they are equal; the
    points' order in which a box's are neighbours, and where each box begins in it."""
    order = np.arange(len(x))
    low, high, left, right, begin, count = [], [], [], [], [], []

    def box(a: int, b: int) -> int:
        points = x[order[a:b]]
        low.append(points.min(axis=0))
        high.append(points.max(axis=0))
        left.append(-1)
        right.append(-1)
        begin.append(a)
        count.append(b - a)
        return len(low) - 1

    open_to = [box(0, len(x))]
    while open_to:
        i = open_to.pop()
        a, n = begin[i], count[i]
        side = high[i] - low[i]
        c = int(side.argmax())
        if n <= most or not 0 < side[c] < np.inf:
            continue
        some = order[a : a + n]
        upper = x[some, c] > low[i][c] + side[c] / 2
        m = n - int(upper.sum())
        if not 0 < m < n:  # neighbours among the numbers
            continue
        order[a : a + n] = np.concatenate([some[~upper], some[upper]])
        left[i], right[i] = box(a, a + m), box(a + m, a + n)
        open_to += [left[i], right[i]]
    arrays = [np.array(v) for v in (low, high, left, right, count)]
    return Boxes(*arrays), order, np.array(begin)


def meetings(boxes: Boxes, one: int, others: np.ndarray) -> np.ndarray:
    """Boxes inside ``one`` and boxes inside ``others`` that meet, such that each two points do once: rows of
    receiver, how it takes part, box met, and how that one takes part."""
    t, s = np.full(len(others), one), np.asarray(others)
    found = []

    def kinds(gap: np.ndarray, box: np.ndarray, other: np.ndarray) -> np.ndarray:
        gap = np.where(gap >= boxes.widest[other] / _LARGER, gap, -1.0)
        kind = np.full(len(box), POINTS)
        for k in range(POINTS):
            kind[boxes.gridded[k, box] & (gap >= boxes.reach[k, box])] = k
        return kind

    while len(t):
        gaps = np.maximum(boxes.low[s] - boxes.high[t], boxes.low[t] - boxes.high[s])
        gap = np.sqrt((np.maximum(gaps, 0) ** 2).sum(axis=1))
        mine, its = kinds(gap, t, s), kinds(gap, s, t)
        by_mine, by_its = mine < POINTS, its < POINTS
        done = (by_mine | boxes.leaf[t]) & (by_its | boxes.leaf[s])
        found.append(np.column_stack([t[done], mine[done], s[done], its[done]]))
        larger = boxes.widest[t] >= boxes.widest[s]
        halved = ~by_mine & ~boxes.leaf[t] & (by_its | boxes.leaf[s] | larger)
        a, b = np.flatnonzero(~done & halved), np.flatnonzero(~done & ~halved)
        t, s = (
            np.concatenate([boxes.left[t[a]], boxes.right[t[a]], t[b], t[b]]),
            np.concatenate([s[a], s[a], boxes.left[s[b]], boxes.right[s[b]]]),
        )
    return np.concatenate(found)


def add_near(out: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray, cells: int) -> None:
    """Add to ``out`` the sums of distances from ``x`` to ``y`` by cluster, ``w`` a column a cluster, ``cells``
    distances at once. Differences are taken first, so that equal points are at distance 0."""
    step, tile = _tiles(len(x), len(y), min(cells, _ALONE // w.shape[1]))
    gap, away = np.empty((2, tile, step))
    for b in range(0, len(y), step):
        some, weight = np.ascontiguousarray(y[b : b + step].T), w[b : b + step]
        for a in range(0, len(x), tile):
            part = x[a : a + tile]
            squared = gap[: len(part), : some.shape[1]]
            one = away[: len(part), : some.shape[1]]
            for c in range(len(some)):
                np.subtract(part[:, c, None], some[c], out=one if c else squared)
                if c:
                    one *= one
                    squared += one
                else:
                    squared *= squared
            np.sqrt(squared, out=squared)
            out[a : a + tile] += squared @ weight


def add_apart(out: np.ndarray, x: np.ndarray, y: np.ndarray, w: np.ndarray, cells: int) -> None:
    """The same where no two points are near for their distance from the middle of ``x``: squares are worked out
    by a product of matrices."""
    middle = x.mean(axis=0)
    x, y = x - middle, y - middle
    left = np.column_stack([x, (x * x).sum(axis=1), np.ones(len(x))])
    right = np.column_stack([-2 * y, np.ones(len(y)), (y * y).sum(axis=1)])
    cells = min(cells, _ALONE // max(w.shape[1], len(right[0])))
    step, tile = _tiles(len(x), len(y), cells)
    gap = np.empty((tile, step))
    for b in range(0, len(y), step):
        some, weight = np.ascontiguousarray(right[b : b + step].T), w[b : b + step]
        for a in range(0, len(x), tile):
            part = left[a : a + tile]
            squared = np.matmul(part, some, out=gap[: len(part), : some.shape[1]])
            np.maximum(squared, 0, out=squared)
            np.sqrt(squared, out=squared)
            out[a : a + tile] += squared @ weight


def _tiles(n: int, m: int, cells: int) -> tuple[int, int]:
    """Points met at once, and those that meet them."""
    step = max(1, min(m, cells // min(n, 256)))
    return step, max(1, min(n, cells // step))
