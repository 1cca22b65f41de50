"""A tree of clustering features over many points.

A feature is a box's number of points, their mean and squared error per dimension, and the
smallest box around them. Features of tasks add up, so every round is one aggregation. A leaf
splits at its mean, in every dimension in which it has a width, until the error inside all leaves
is a stated share of the whole. How many leaves that takes depends on the share and on the shape of
the data, not on the number of points; only features reach the driver.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

#: Nodes that a tree may have before it is refused: what the driver and every task hold.
MOST_NODES = 1_000_000
#: Error of a leaf, as a share of the whole, that rounding may leave.
_ROUNDING = 1e-14

_KIND = "node long, part int, n long, s double, q double, low double, high double"


class FeatureTree:
    """Nodes as arrays; ``first`` is a node's first child of ``2 ** dimensions``, -1 for leaves.

    Roots are the nodes of the labels, in the labels' order. Nodes that hold no point have
    ``count`` 0. ``cross`` holds the sums of products of deviations in the pairs ``crossed`` of
    dimensions, none unless ``mixed``.
    """

    def __init__(self, columns: Sequence[str], labels: list, mixed: bool = False) -> None:
        self.columns, self.labels = list(columns), labels
        d = len(self.columns)
        self.fan, n = 1 << d, len(labels)
        self.first = np.full(n, -1, np.int64)
        self.label = np.arange(n)
        self.count = np.zeros(n, np.int64)
        self.mean, self.error = np.zeros((n, d)), np.zeros((n, d))
        self.low, self.high = np.full((n, d), np.inf), np.full((n, d), -np.inf)
        self.crossed = list(combinations(range(d), 2)) if mixed else []
        self.cross = np.zeros((n, len(self.crossed)))

    @property
    def leaves(self) -> np.ndarray:
        """Leaves that hold points."""
        return np.flatnonzero((self.first < 0) & (self.count > 0))

    @property
    def total(self) -> float:
        """Squared error of the points about their label's mean."""
        return float(self.error[: len(self.labels)].sum())

    @property
    def inside(self) -> float:
        """Squared error of the points about their leaf's mean."""
        return float(self.error[self.leaves].sum())

    def leaf_of(self, x: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.asarray(label, np.int64).copy()
        weights = 1 << np.arange(x.shape[1])
        rows = np.arange(len(x))
        while len(rows):
            rows = rows[self.first[node[rows]] >= 0]
            at = node[rows]
            node[rows] = self.first[at] + ((x[rows] > self.mean[at]) * weights).sum(axis=1)
        return node

    def wanted(self, share: float) -> np.ndarray:
        """Leaves to split so that no more than ``share`` of the total error stays inside: all but
        the smallest, which together keep half of it."""
        leaves, allowed = self.leaves, share * self.total
        error = self.error[leaves].sum(axis=1)
        if error.sum() <= allowed:
            return leaves[:0]
        order = np.argsort(error, kind="stable")
        kept = np.searchsorted(np.cumsum(error[order]), allowed / 2, "right")
        large = leaves[order[kept:]]
        divisible = (self.high[large] > self.low[large]).any(axis=1)
        worth = self.error[large].sum(axis=1) > _ROUNDING * self.total
        return large[divisible & worth]

    def split(self, nodes: np.ndarray) -> np.ndarray:
        """Give ``nodes`` children, still empty; returns all children."""
        n, more = len(self.first), len(nodes) * self.fan
        if n + more > MOST_NODES:
            raise ValueError(f"the wanted error takes more than {MOST_NODES} nodes")
        self.first[nodes] = n + np.arange(len(nodes)) * self.fan
        d = self.mean.shape[1]
        self.first = np.append(self.first, np.full(more, -1))
        self.label = np.append(self.label, np.repeat(self.label[nodes], self.fan))
        self.count = np.append(self.count, np.zeros(more, np.int64))
        self.mean = np.concatenate([self.mean, np.repeat(self.mean[nodes], self.fan, axis=0)])
        self.error = np.concatenate([self.error, np.zeros((more, d))])
        self.cross = np.concatenate([self.cross, np.zeros((more, len(self.crossed)))])
        self.low = np.concatenate([self.low, np.full((more, d), np.inf)])
        self.high = np.concatenate([self.high, np.full((more, d), -np.inf)])
        return np.arange(n, n + more)


def _columns_of(batch: pa.RecordBatch, tree: FeatureTree, label: str | None):
    x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in tree.columns])
    if label is None:
        return x, np.zeros(len(x), np.int64)
    code = {name: i for i, name in enumerate(tree.labels)}
    names = batch.column(label).dictionary_encode()
    known = np.array([code[name] for name in names.dictionary.to_pylist()], np.int64)
    return x, known[names.indices.to_numpy()]


def _measure(points: DataFrame, tree: FeatureTree, label: str | None, fresh: np.ndarray) -> None:
    """Fill the features of the ``fresh`` leaves from the points. Sums are taken about the mean of the
    parent, which ``tree.mean`` holds until then."""
    if not len(fresh):
        return
    base = int(fresh[0])  # fresh nodes are the last ones, one after another

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, d = len(fresh), len(tree.columns)
        count = np.zeros(n, np.int64)
        s, q = np.zeros((n, d)), np.zeros((n, d))
        low, high = np.full((n, d), np.inf), np.full((n, d), -np.inf)
        cross = np.zeros((n, len(tree.crossed)))
        for batch in batches:
            x, codes = _columns_of(batch, tree, label)
            leaf = tree.leaf_of(x, codes) - base
            some = leaf >= 0
            x, leaf = x[some], leaf[some]
            count += np.bincount(leaf, minlength=n)
            away = x - tree.mean[leaf + base]
            for c in range(d):
                s[:, c] += np.bincount(leaf, away[:, c], n)
                q[:, c] += np.bincount(leaf, away[:, c] ** 2, n)
                np.minimum.at(low[:, c], leaf, x[:, c])
                np.maximum.at(high[:, c], leaf, x[:, c])
            for i, (a, b) in enumerate(tree.crossed):
                cross[:, i] += np.bincount(leaf, away[:, a] * away[:, b], n)
        # Products of two dimensions are further parts with a sum alone.
        parts, none = d + len(tree.crossed), np.zeros_like(cross)
        s, low, high = (np.concatenate([v, none], axis=1) for v in (s, low, high))
        q = np.concatenate([q, cross], axis=1)
        met = np.repeat(np.flatnonzero(count), parts)
        part = np.tile(np.arange(parts), len(met) // max(parts, 1))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(met + base),
                pa.array(part, pa.int32()),
                pa.array(count[met]),
                *(pa.array(values[met, part]) for values in (s, q, low, high)),
            ],
            ["node", "part", "n", "s", "q", "low", "high"],
        )

    read = points.select(*tree.columns, *([label] if label else []))
    rows = (
        read.mapInArrow(tasks, _KIND)
        .groupBy("node", "part")
        .agg(
            F.sum("n").alias("n"),
            F.sum("s").alias("s"),
            F.sum("q").alias("q"),
            F.min("low").alias("low"),
            F.max("high").alias("high"),
        )
        .toPandas()  # a row per new node and dimension
    )
    d = len(tree.columns)
    products, rows = rows[rows["part"] >= d], rows[rows["part"] < d]
    node, part, n = rows["node"].to_numpy(), rows["part"].to_numpy(), rows["n"].to_numpy()
    s = rows["s"].to_numpy()
    if len(products):
        sums = np.zeros((len(fresh), d))
        sums[node - base, part] = s
        at, pair = products["node"].to_numpy(), products["part"].to_numpy() - d
        a, b = np.array(tree.crossed)[pair].T
        tree.cross[at, pair] = products["q"].to_numpy() - (
            sums[at - base, a] * sums[at - base, b] / products["n"].to_numpy()
        )
    tree.count[node] = n
    tree.mean[node, part] += s / n
    tree.error[node, part] = np.maximum(rows["q"].to_numpy() - s * s / n, 0)
    tree.low[node, part], tree.high[node, part] = rows["low"].to_numpy(), rows["high"].to_numpy()


def refine(points: DataFrame, tree: FeatureTree, share: float, label: str | None = None) -> None:
    """Split leaves, one aggregation a round, until ``share`` of the total error is inside."""
    while len(nodes := tree.wanted(share)):
        _measure(points, tree, label, tree.split(nodes))


def feature_tree(
    points: DataFrame,
    columns: Sequence[str],
    share: float,
    label: str | None = None,
    mixed: bool = False,
) -> FeatureTree:
    """A tree over the points, or one per value of ``label``, with ``share`` of the error inside.

    Points have numbers in all ``columns``. Stage ``points`` first: each round scans them once. A share
    of 0 splits until every leaf holds equal points. More than ``MOST_NODES`` nodes are refused.
    """
    if share < 0:
        raise ValueError("the share of the error cannot be negative")
    ship(points.sparkSession)
    labels = [None]
    if label is not None:
        found = points.select(label).distinct().limit(MOST_NODES + 1).collect()
        if len(found) > MOST_NODES:
            raise ValueError(f"more than {MOST_NODES} labels")
        labels = sorted((row[0] for row in found), key=lambda v: (v is None, v))
    tree = FeatureTree(columns, labels, mixed)
    _measure(points, tree, label, np.arange(len(labels)))
    refine(points, tree, share, label)
    return tree


def with_leaf(
    points: DataFrame, tree: FeatureTree, name: str = "leaf", label: str | None = None
) -> DataFrame:
    """Add each point's leaf."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf_of(*_columns_of(batch, tree, label))
            yield batch.append_column(name, pa.array(leaf))

    kind = T.StructType([*points.schema.fields, T.StructField(name, T.LongType())])
    return points.mapInArrow(tasks, kind)
