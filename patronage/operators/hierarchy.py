"""Ward's hierarchical clustering of customers."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CLUSTER, CUSTOMER, METRICS, check_k
from ..session import stage
from .cftree import feature_tree, with_leaf
from .features import SCALED, standardize

#: Share of the total squared error that the merged leaves may have inside.
ERROR_SHARE = 0.002
_CHUNK_CELLS = 2_000_000  # distances held at once

_MERGES = T.StructType(
    [
        T.StructField("step", T.IntegerType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("right", T.IntegerType()),
        T.StructField("height", T.DoubleType()),
        T.StructField("size", T.LongType()),
    ]
)


@dataclass(frozen=True)
class Ward:
    """A merge tree of cells over staged customers.

    ``tree`` has a row per merge. ``squared_error_inside`` is what the cells cost: the squared error
    inside them, in units of the standardised metrics, no more than the wanted share of
    ``squared_error``, that of one single cluster.
    """

    located: DataFrame
    cells: pd.DataFrame
    merges: list[tuple[int, int, float, int]]
    squared_error_inside: float
    squared_error: float

    def squared_error_of(self, k: int) -> float:
        """Squared error of the tree cut at ``k``: inside the cells, and of the merges up to there."""
        heights = [height for _, _, height, _ in self.merges[: max(len(self.cells) - k, 0)]]
        return self.squared_error_inside + sum(h * h for h in heights) / 2

    @property
    def tree(self) -> DataFrame:
        rows = [(i, *merge) for i, merge in enumerate(self.merges)]
        return self.located.sparkSession.createDataFrame(rows, _MERGES)

    def segments(self, k: int) -> DataFrame:
        """Customers in ``k`` clusters, from the tree cut at ``k``."""
        check_k(k)
        if len(self.cells) < k:
            raise ValueError(f"cannot make {k} clusters of {len(self.cells)} cells")
        labels = cut_tree(self.merges, self.cells["weight"].to_numpy(), k)
        mapping = self.cells[["micro"]].assign(**{CLUSTER: np.array(labels, "int32")})
        # As many rows as there are cells.
        small = F.broadcast(self.located.sparkSession.createDataFrame(mapping))
        return self.located.join(small, "micro").select(CUSTOMER, *METRICS, *SCALED, CLUSTER)


def _search(
    wanted: np.ndarray, alive: np.ndarray, size: np.ndarray, centre: np.ndarray
) -> tuple[np.ndarray, np.ndarray]:
    """For each wanted node the alive node it is cheapest to merge with (the
    lowest numbered of equals), and the cost: the rise in squared error, doubled."""
    nearest, cost = np.empty(len(wanted), dtype=np.int64), np.empty(len(wanted))
    others, other_size = centre[alive], size[alive]
    at_once = max(1, _CHUNK_CELLS // len(alive))
    for start in range(0, len(wanted), at_once):
        part = wanted[start : start + at_once]
        gap = np.zeros((len(part), len(alive)))
        for c in range(centre.shape[1]):
            step = centre[part, c, None] - others[None, :, c]
            step *= step
            gap += step
        own = size[part, None]
        gap *= 2.0 * (own * other_size) / (own + other_size)
        gap[part[:, None] == alive[None, :]] = np.inf
        best = gap.argmin(axis=1)
        nearest[start : start + at_once] = alive[best]
        cost[start : start + at_once] = gap[np.arange(len(part)), best]
    return nearest, cost


def ward_merges(
    weights: np.ndarray, centroids: np.ndarray
) -> list[tuple[int, int, float, int]]:
    """Merge tree of a bounded number of weighted points: (left, right, height,
    size) by rising height. Inputs are nodes 0..m-1, merge i makes node m + i.

    Each round merges every pair of mutually nearest nodes. Under Ward's cost a
    merged node is never closer to a third one than the nearer of its parts
    was, so such pairs are merges of the sequential method too, and only nodes
    that merged or lost their nearest node need a new search.
    """
    m = len(weights)
    size, centre = weights.astype(float), centroids.astype(float).copy()
    alive = np.ones(m, dtype=bool)
    nearest, cost = np.full(m, -1, dtype=np.int64), np.full(m, np.inf)
    found: list[tuple[float, int, int]] = []
    stale = np.arange(m)
    while len(found) < m - 1:
        here = np.flatnonzero(alive)
        nearest[stale], cost[stale] = _search(stale, here, size, centre)
        left = here[(nearest[nearest[here]] == here) & (here < nearest[here])]
        if len(left) == 0:
            # Only rounding can leave no mutual pair; a full search has one.
            stale = here
            continue
        right = nearest[left]
        found.extend(zip(np.sqrt(cost[left]).tolist(), left.tolist(), right.tolist()))
        total = size[left] + size[right]
        centre[left] = (
            size[left, None] * centre[left] + size[right, None] * centre[right]
        ) / total[:, None]
        size[left] = total
        alive[right] = False
        touched = np.zeros(m, dtype=bool)
        touched[left] = touched[right] = True
        stale = np.flatnonzero(alive & (touched | touched[nearest]))

    # Number the nodes in order of height.
    found.sort(key=lambda merge: merge[0])
    owner = list(range(m))  # point -> a point of its current node
    node = list(range(m))  # number of the node such a point stands for
    count = weights.astype(int).tolist()

    def top(point: int) -> int:
        while owner[point] != point:
            owner[point] = owner[owner[point]]
            point = owner[point]
        return point

    merges = []
    for i, (height, a, b) in enumerate(found):
        a, b = top(a), top(b)
        first, second = sorted((node[a], node[b]))
        owner[b] = a
        count[a] += count[b]
        node[a] = m + i
        merges.append((first, second, height, count[a]))
    return merges


def cut_tree(
    merges: list[tuple[int, int, float, int]], weights: np.ndarray, k: int
) -> list[int]:
    """Cluster 0..k-1 of each input point after undoing the last k - 1 merges;
    cluster 0 is the largest."""
    m = len(weights)
    top = list(range(2 * m))
    for i in reversed(range(m - k)):
        left, right, _, _ = merges[i]
        top[left] = top[right] = top[m + i]
    tops = np.array(top[:m])
    names, first, member = np.unique(tops, return_index=True, return_inverse=True)
    sizes = np.bincount(member, weights=weights)
    label = np.empty(len(names), dtype=int)
    label[np.lexsort((first, -sizes))] = np.arange(len(names))
    return label[member].tolist()


def ward(rfm: DataFrame, share: float = ERROR_SHARE) -> Ward:
    """Ward's method on the standardised metrics of all customers.

    At every size the same way: Spark summarises the customers by the leaves of a tree of
    clustering features, split until at most ``share`` of the squared error is inside them, and
    Ward's method merges the weighted leaves. With a share of 0 a leaf holds equal customers and
    the tree is that of Ward's method over all of them. Half the sum of the tree's squared heights and the
    error inside the leaves add up to the error of one single cluster. Only the leaves
    reach the driver; their number grows as the share falls, by its power -3/2 at most where
    the three metrics fill space evenly. Stage ``rfm`` first.
    """
    features = stage(standardize(rfm), "standardized")
    grown = feature_tree(features, SCALED, share)
    located = stage(with_leaf(features, grown, "micro"), "located")
    leaves = grown.leaves
    cells = pd.DataFrame(grown.mean[leaves], columns=list(SCALED)).assign(
        micro=leaves, weight=grown.count[leaves], error=grown.error[leaves].sum(axis=1)
    )
    merges = ward_merges(cells["weight"].to_numpy(), cells[list(SCALED)].to_numpy())
    return Ward(located, cells, merges, grown.inside, grown.total)


def ward_segments(rfm: DataFrame, k: int, share: float = ERROR_SHARE) -> DataFrame:
    """Customers in ``k`` Ward clusters."""
    check_k(k)
    return ward(rfm, share).segments(k)
