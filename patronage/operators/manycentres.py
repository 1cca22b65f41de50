"""The nearest of many centres.

``centres.nearest`` writes every centre into the plan and measures every distance, which suits a
model of a few clusters. Here the centres form a k-d tree that tasks search for a batch of rows at a
time: each row is first measured against the leaf it falls into, then only against the leaves whose
box is no farther than the best so far.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship

#: Centres that a table may have before it is refused: what the driver and every task hold.
MOST_CENTRES = 1_000_000
#: Centres of a leaf.
LEAF_CENTRES = 16


class CentreTree:
    """A k-d tree over (number, coordinates); of equal centres only the smallest number is kept."""

    def __init__(self, numbers: np.ndarray, points: np.ndarray) -> None:
        if not len(numbers):
            raise ValueError("at least one centre is needed")
        if not np.isfinite(points).all():
            raise ValueError("a centre's coordinates must be finite numbers")
        order = np.argsort(numbers, kind="stable")
        _, first = np.unique(points[order] + 0.0, axis=0, return_index=True)
        order = order[first]
        low, high, axis, cut, left, spans = [], [], [], [], [], []

        def node(span: np.ndarray) -> None:
            low.append(points[span].min(axis=0))
            high.append(points[span].max(axis=0))
            axis.append(-1), cut.append(0.0), left.append(-1), spans.append(span)

        node(order)
        at = 0
        while at < len(spans):
            span = spans[at]
            if len(span) > LEAF_CENTRES:
                axis[at] = int(np.argmax(high[at] - low[at]))
                along = points[span, axis[at]]
                halves = np.argsort(along, kind="stable")
                middle = len(span) // 2
                left[at], cut[at] = len(spans), along[halves[middle]]
                node(span[halves[:middle]])
                node(span[halves[middle:]])
                spans[at] = span[:0]
            at += 1
        self.low, self.high = np.array(low), np.array(high)
        self.axis, self.cut, self.left = np.array(axis), np.array(cut), np.array(left)
        # By number inside a leaf, so that the first of the least distances is the tie's winner.
        spans = [span[np.argsort(numbers[span], kind="stable")] for span in spans]
        self.end = np.cumsum([len(span) for span in spans])
        self.begin = self.end - [len(span) for span in spans]
        self.numbers = numbers[np.concatenate(spans)]
        self.points = points[np.concatenate(spans)]

    def _home(self, x: np.ndarray) -> np.ndarray:
        """The leaf on each row's side of all cuts."""
        node = np.zeros(len(x), np.int64)
        rows = np.arange(len(x))
        while len(rows := rows[self.left[node[rows]] >= 0]):
            at = node[rows]
            node[rows] = self.left[at] + (x[rows, self.axis[at]] >= self.cut[at])
        return node

    def search(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each row's nearest centre, and the squared distance to it.

        Bounds and distances round the same way, dimension by dimension, so no bound exceeds
        the distance of a centre in its box and ties are found exactly.
        """
        squared = np.full(len(x), np.inf)
        number = np.full(len(x), np.iinfo(np.int64).max)

        def measure(rows: np.ndarray, leaf: int) -> None:
            span = slice(self.begin[leaf], self.end[leaf])
            away = np.zeros((len(rows), span.stop - span.start))
            for c in range(x.shape[1]):
                away += (x[rows, c][:, None] - self.points[span, c]) ** 2
            place = np.argmin(away, axis=1)
            found, its = away[np.arange(len(rows)), place], self.numbers[span][place]
            better = (found < squared[rows]) | ((found == squared[rows]) & (its < number[rows]))
            squared[rows[better]], number[rows[better]] = found[better], its[better]

        with np.errstate(over="ignore"):
            home = self._home(x)
            order = np.argsort(home, kind="stable")
            for rows in np.split(order, np.flatnonzero(np.diff(home[order])) + 1):
                if len(rows):
                    measure(rows, home[rows[0]])
            waiting = [(0, np.arange(len(x)))]
            while waiting:
                node, rows = waiting.pop()
                bound = np.zeros(len(rows))
                for c in range(x.shape[1]):
                    some = x[rows, c]
                    outside = np.maximum(self.low[node, c] - some, some - self.high[node, c])
                    bound += np.maximum(outside, 0.0) ** 2
                rows = rows[bound <= squared[rows]]
                if self.left[node] >= 0:
                    if len(rows):
                        waiting += [(self.left[node] + 1, rows), (self.left[node], rows)]
                elif len(rows := rows[home[rows] != node]):
                    measure(rows, node)
        return number, squared


def centre_tree(centres: DataFrame | Sequence[tuple], most: int = MOST_CENTRES) -> CentreTree:
    """A tree of rows (number, one coordinate per value); more than ``most`` are refused."""
    if isinstance(centres, DataFrame):
        number, *parts = (F.col(f"`{c.replace('`', '``')}`") for c in centres.columns)
        read = centres.select(number.cast("long"), *(p.cast("double") for p in parts))
        rows = [tuple(row) for row in read.limit(most + 1).collect()]
    else:
        rows = list(centres)
    if len(rows) > most:
        raise ValueError(f"more than {most} centres")
    numbers = np.array([row[0] for row in rows], np.int64)
    return CentreTree(numbers, np.array([row[1:] for row in rows], float))


def nearest_of_many(
    df: DataFrame,
    values: Sequence[Column],
    centres: DataFrame | Sequence[tuple] | CentreTree,
    most: int = MOST_CENTRES,
) -> DataFrame:
    """Add the nearest centre's ``cluster`` and the ``distance`` to it, as ``centres.nearest`` does.

    ``centres`` are rows (cluster, one number per value): a table or a sequence of at most ``most``
    rows, or a tree made before. Ties go to the smallest cluster. A row with a null or NaN value
    has neither cluster nor distance. Columns named like the two new ones are replaced.
    """
    ship(df.sparkSession)
    tree = centres if isinstance(centres, CentreTree) else centre_tree(centres, most)
    if tree.points.shape[1] != len(values):
        raise ValueError("a centre needs one coordinate per value")
    at = df.select("*", *(v.cast("double") for v in values)).toDF(
        *(f"c{i}" for i in range(len(df.columns) + len(values)))
    )
    width = len(df.columns)
    kept = [i for i, name in enumerate(df.columns) if name.lower() not in ("cluster", "distance")]
    schema = T.StructType([at.schema.fields[i] for i in kept])
    schema = schema.add("cluster", T.LongType()).add("distance", T.DoubleType())

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.column_stack(
                [
                    batch.column(i).to_numpy(zero_copy_only=False).astype(float)
                    for i in range(width, batch.num_columns)
                ]
            )
            known = ~np.isnan(x).any(axis=1)
            number, squared = np.zeros(len(x), np.int64), np.zeros(len(x))
            number[known], squared[known] = tree.search(x[known])
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(i) for i in kept),
                    pa.array(number, mask=~known),
                    pa.array(np.sqrt(squared), mask=~known),
                ],
                schema.names,
            )

    names = [df.columns[i] for i in kept]
    return at.mapInArrow(tasks, schema).toDF(*names, "cluster", "distance")
