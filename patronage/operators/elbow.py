"""K-Means for many numbers of clusters at once: one aggregation of the rows per round.

Rows lie in the leaves of a tree of clustering features. Where one centre is nearest to a leaf's
whole box, as the triangle inequality shows from the box alone, the leaf's feature
stands for its rows, in that round and for that number of clusters. Only rows of leaves that a
border crosses are compared with centres, with those that may be nearest somewhere in their box. The
result of a round is exactly that of Lloyd's method over all rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .cftree import feature_tree, refine, with_leaf

#: Share of the error inside the leaves; a finer tree leaves fewer rows to compare.
LEAF_SHARE = 0.0001
#: Leaves wanted per cluster of the largest number, as far as there are distinct points.
LEAVES_PER_CLUSTER = 20
#: A fit has converged when no centre moves farther in a round.
TOLERANCE = 1e-5
#: Rounds over the leaves that find where the rounds over the rows start.
START_ROUNDS = 100


@dataclass
class Fit:
    """Centres of ``k`` clusters, the rows of each, and their squared error about the centres.

    ``compared`` counts, over all rounds, the rows that were compared with centres.
    """

    centres: np.ndarray
    sse: float = 0.0
    counts: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    converged: bool = False
    rounds: int = 0
    compared: int = 0

    @property
    def k(self) -> int:
        return len(self.centres)


def candidates(
    low: np.ndarray, high: np.ndarray, mean: np.ndarray, centres: np.ndarray
) -> np.ndarray:
    """Which centres (columns) may be nearest to some point of each box, the first of equals.

    A centre is out if it is farther from the box's mean than the nearest one by twice the
    distance of the mean to the box's farthest corner. Of those left, centre a rules b out where
    the corner of the box farthest towards b is still nearer to a.
    """
    radius = np.sqrt((np.maximum(high - mean, mean - low) ** 2).sum(axis=1))
    to_mean = np.sqrt(_squared(mean, centres))
    reach = to_mean.min(axis=1) + 2 * radius
    out = to_mean <= (reach + 1e-9 * (1 + reach))[:, None]
    rest = np.flatnonzero(out.sum(axis=1) > 1)
    for a, one in enumerate(centres):
        near = rest[out[rest, a]]
        for b, other in enumerate(centres):
            rows = near[out[near, b]] if a != b else rest[:0]
            if len(rows):
                corner = np.where(other > one, high[rows], low[rows])
                to_one = ((corner - one) ** 2).sum(axis=1)
                to_other = ((corner - other) ** 2).sum(axis=1)
                out[rows, b] = ~((to_one < to_other) | ((to_one == to_other) & (a < b)))
    return out


def _squared(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.zeros((len(x), len(centres)))
    for c in range(x.shape[1]):
        out += (x[:, c, None] - centres[None, :, c]) ** 2
    return out


def _lloyd(x: np.ndarray, weight: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, float]:
    """Centres and cost after rounds over weighted points."""
    for _ in range(START_ROUNDS):
        near = ((centres**2).sum(axis=1) - 2 * (x @ centres.T)).argmin(axis=1)
        total = np.bincount(near, weight, len(centres))
        sums = [np.bincount(near, weight * x[:, c], len(centres)) for c in range(x.shape[1])]
        moved = np.where(
            total[:, None] > 0, np.column_stack(sums) / np.maximum(total, 1)[:, None], centres
        )
        if np.abs(moved - centres).max() <= TOLERANCE:
            break
        centres = moved
    return centres, float((weight * _squared(x, centres).min(axis=1)).sum())


def starts(x: np.ndarray, weight: np.ndarray, ks: Sequence[int], seed: int) -> dict[int, np.ndarray]:
    """Centres for each k from weighted points: the cheaper of a spread-out random draw, and of the
    centres for one cluster fewer and the point that costs most. More clusters so never cost more."""
    draw = np.random.default_rng(seed)
    out, last = {}, np.zeros((0, x.shape[1]))
    for k in range(1, max(ks) + 1):
        drawn = x[[draw.choice(len(x), p=weight / weight.sum())]]
        while len(drawn) < k:
            cost = weight * _squared(x, drawn).min(axis=1)
            share = cost / cost.sum() if cost.sum() > 0 else weight / weight.sum()
            drawn = np.concatenate([drawn, x[[draw.choice(len(x), p=share)]]])
        tried = [_lloyd(x, weight, drawn)]
        if len(last):
            worst = (weight * _squared(x, last).min(axis=1)).argmax()
            tried.append(_lloyd(x, weight, np.concatenate([last, x[[worst]]])))
        last = min(tried, key=lambda found: found[1])[0]
        out[k] = last
    return {k: out[k] for k in ks}


def fit_all(
    points: DataFrame,
    columns: Sequence[str],
    ks: Sequence[int],
    seed: int,
    max_iterations: int,
    share: float = LEAF_SHARE,
) -> list[Fit]:
    """K-Means of staged ``points`` for every k, all from the same rounds.

    The rounds are as many as the slowest k needs, ``max_iterations`` at most. A cluster that loses its
    rows keeps its centre. Centres are the means of their rows in the last round, and ``sse`` is
    the squared error about them.
    """
    if not ks or min(ks) < 1:
        raise ValueError("numbers of clusters start at 1")
    tree = feature_tree(points, columns, share)
    while len(tree.leaves) < LEAVES_PER_CLUSTER * max(ks) and share > 1e-12:
        share /= 4
        refine(points, tree, share)
    if not tree.total and not tree.count.sum():
        raise ValueError("K-Means needs at least one row")
    located = stage(with_leaf(points.select(*columns), tree), "located")
    leaves = tree.leaves
    count, mean = tree.count[leaves], tree.mean[leaves]
    error = tree.error[leaves].sum(axis=1)
    d = len(columns)
    names = [f"s{c}" for c in range(d)]
    fits = [Fit(centres) for centres in starts(mean, count, ks, seed).values()]

    def compared(active: list[tuple[int, np.ndarray, np.ndarray]]) -> dict[int, np.ndarray]:
        """Per fit and centre: rows, squared error about the centre, and sums about it."""
        # Tasks get the open leaves alone and drop the rows of all others at once.
        crossed = np.column_stack([open_to.any(axis=1) for _, _, open_to in active])
        kept = np.flatnonzero(crossed.any(axis=1))
        place = np.full(len(tree.first), -1)
        place[leaves[kept]] = np.arange(len(kept))
        crossed = crossed[kept]
        active = [(i, centres, open_to[kept]) for i, centres, open_to in active]

        def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            totals = [np.zeros((len(centres), 2 + d)) for _, centres, _ in active]
            for batch in batches:
                at = place[batch.column("leaf").to_numpy()]
                open_rows = np.flatnonzero(at >= 0)
                at = at[open_rows]
                x = np.column_stack(
                    [batch.column(c).to_numpy(zero_copy_only=False)[open_rows] for c in columns]
                )
                for n, (total, (_, centres, open_to)) in enumerate(zip(totals, active, strict=True)):
                    rows = np.flatnonzero(crossed[at, n])
                    if not len(rows):
                        continue
                    some, may = x[rows], open_to[at[rows]]
                    squared = np.zeros(may.shape)
                    for c in range(d):
                        squared += (some[:, c, None] - centres[None, :, c]) ** 2
                    squared[~may] = np.inf
                    near = squared.argmin(axis=1)
                    k = len(centres)
                    total[:, 0] += np.bincount(near, minlength=k)
                    total[:, 1] += np.bincount(near, squared[np.arange(len(near)), near], k)
                    away = some - centres[near]
                    for c in range(d):
                        total[:, 2 + c] += np.bincount(near, away[:, c], k)
            out = [
                (i, j, *row)
                for total, (i, _, _) in zip(totals, active, strict=True)
                for j, row in enumerate(total.tolist())
                if row[0]
            ]
            columns_of = list(zip(*out, strict=True)) or [[]] * (4 + d)
            kinds = [pa.int32(), pa.int32(), *[pa.float64()] * (2 + d)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kind) for v, kind in zip(columns_of, kinds, strict=True)],
                ["fit", "centre", "n", "cost", *names],
            )

        kind = "fit int, centre int, n double, cost double, " + ", ".join(f"{s} double" for s in names)
        summed = located.mapInArrow(tasks, kind).groupBy("fit", "centre")
        rows = summed.agg(*(F.sum(c).alias(c) for c in ("n", "cost", *names))).collect()
        found = {i: np.zeros((len(centres), 2 + d)) for i, centres, _ in active}
        for row in rows:  # a row per centre of every k
            found[row.fit][row.centre] = row[2:]
        return found

    for _ in range(max_iterations):
        active, settled = [], {}
        for i, fit in enumerate(fits):
            if fit.converged:
                continue
            may = candidates(tree.low[leaves], tree.high[leaves], mean, fit.centres)
            bulk = np.flatnonzero(may.sum(axis=1) == 1)
            near = may[bulk].argmax(axis=1)
            away = mean[bulk] - fit.centres[near]
            weight = count[bulk]
            known = np.zeros((fit.k, 2 + d))
            known[:, 0] = np.bincount(near, weight, fit.k)
            cost = error[bulk] + weight * (away**2).sum(axis=1)
            known[:, 1] = np.bincount(near, cost, fit.k)
            for c in range(d):
                known[:, 2 + c] = np.bincount(near, weight * away[:, c], fit.k)
            settled[i] = known
            may[bulk] = False
            fit.compared += int(count.sum() - weight.sum())
            active.append((i, fit.centres, may))
        if not active:
            break
        busy = [entry for entry in active if entry[2].any()]
        found = compared(busy) if busy else {}
        for i, known in settled.items():
            fit, total = fits[i], known + found.get(i, 0)
            n = total[:, 0]
            step = total[:, 2:] / np.maximum(n, 1)[:, None]
            fit.centres = fit.centres + step
            fit.sse = float(total[:, 1].sum() - (n * (step**2).sum(axis=1)).sum())
            fit.counts = n.astype(np.int64)
            fit.rounds += 1
            fit.converged = bool(np.abs(step).max(initial=0) <= TOLERANCE)
    return fits
