"""Mean silhouette under Euclidean distance."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from itertools import combinations_with_replacement, pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship, stage
from .cftree import FeatureTree, feature_tree, refine
from .distances import (
    KINDS,
    LEAF_ROWS,
    POINTS,
    Boxes,
    add_apart,
    add_near,
    boxes_of,
    meetings,
)
from .features import SCALED
from .kmeans import SEED
from .microclusters import MICRO_CLUSTERS, fit_micro_clusters, summarise, with_micro

# Points of a block in the pairwise method, blocks of a task's region at most, and regions that a core should have.
BLOCK_ROWS = 4_000
_REGION_BLOCKS, _REGIONS_A_CORE = 8, 8

# How far apart the bounds of the tree method may be.
TOLERANCE = 0.005

# Cells that a caller's column may make.
MOST_CELLS = 100_000

# Share of the squared error inside the leaves of the first trees, and of a row's scale that
# a box's mean distance may be uncertain by at first.
_FIRST_SHARE, _FIRST_OPEN = 0.02, 2.0

_PARTS_A_CORE = 4  # of the points that meet the trees
_CHUNK_CELLS = 4_000_000  # distances held at once in a task
# Rows that a task sorts into groups of near ones, those of a group at least and at most, groups of a table
# about, and groups and boxes that meet at once.
_ROWS_AT_ONCE, _GROUP_ROWS, _MOST_GROUP_ROWS, _GROUPS = 65_536, 32, 512, 4_000
_GROUPS_AT_ONCE, _BOXES_AT_ONCE = 64, 512
_THIRD = 1 / (3 * math.sqrt(3))  # a sixth of the bound of a distance's third derivative
_TILE_CELLS = 128_000  # distances worked out at once, which fit a core's cache
_BLOCK = "region int, box int, kind int, x array<double>, own array<int>, weight array<double>"
_EDGES = KINDS  # kind of the row with the edges of a region's boxes
_PLACE = "_place"
_ROWS_SENT = 1_000  # blocks handed to Spark at once


def silhouette_euclidean(
    df: DataFrame,
    label: str,
    columns: Sequence[str] = SCALED,
    method: str = "tree",
    cell: str | None = None,
    micro: int = MICRO_CLUSTERS,
    seed: int = SEED,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row: the mean silhouette, a lower and an upper bound of it, the
    number of rows and of clusters. Every row counts; none is sampled.

    The caller chooses the method, whatever the size of the data:

    ``tree`` is linear in the rows and gives bounds no farther apart than ``tolerance``. Every
    cluster has a tree of clustering features; a row opens a box only while the box's mean distance
    is uncertain at the row's own scale, so far boxes stay whole and near ones are
    opened. The trees grow, and the rows are read again, until the bounds meet the tolerance.

    ``cells`` is linear in the rows. Clusters are summarised by cells holding
    weight, centroid and mean squared radius: those of the column ``cell``, or ``micro``
    micro-clusters split by label. The mean distance from a point to a cell of centroid c
    and mean squared radius v lies between ``d = |x - c|`` and ``sqrt(d^2 + v)``
    (Jensen's inequality, both ways), so a row's silhouette is bounded on both
    sides; the value is the middle. The table of cells goes to every task: more than
    ``MOST_CELLS`` are refused.

    ``pairwise`` takes the distances between all distinct rows, exact but for the last digits: far boxes
    of rows meet by polynomials that stand for the distance, near ones row by row.
    """
    if method == "pairwise":
        return _pairwise(df.select(F.col(label).alias("label"), *columns), list(columns))
    if method == "tree" and cell is None:
        return _tree(df.select(F.col(label).alias("label"), *columns), list(columns), tolerance)
    if method not in ("cells", "tree"):
        raise ValueError(f"unknown method {method!r}")
    rows = df.select(
        F.col(label).alias("label"), *columns, *([F.col(cell).alias("micro")] if cell else [])
    )
    if cell is None:
        rows = with_micro(rows, fit_micro_clusters(rows, columns, micro, seed))
    rows = stage(rows, "located")
    known = summarise(rows, columns, ["label", "micro"]).limit(MOST_CELLS + 1).toPandas()
    if len(known) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} cells")
    names = sorted(known["label"].unique())
    if len(names) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    bounds = _bounds_of_rows(known, names, list(columns))
    per_row = rows.select("label", *columns).mapInPandas(bounds, "low double, high double")
    low, high = F.avg("low"), F.avg("high")
    return per_row.agg(
        ((low + high) / 2).alias("silhouette"),
        low.alias("silhouette_low"),
        high.alias("silhouette_high"),
        F.count(F.lit(1)).alias("n_rows"),
        F.lit(len(names)).alias("n_clusters"),
    )


def _tree(rows: DataFrame, columns: list[str], tolerance: float) -> DataFrame:
    """Bounds within ``tolerance`` from trees that grow until they are."""
    if tolerance <= 0:
        raise ValueError("the tolerance must be positive")
    rows = stage(rows, "rows")
    share, opening = _FIRST_SHARE, _FIRST_OPEN * tolerance
    tree = feature_tree(rows, columns, share, "label", mixed=True)
    if len(tree.labels) < 2:
        raise ValueError("a silhouette needs at least two clusters")
    # Equal rows have equal bounds. A task takes points of one part of the space, whose groups are small boxes.
    points = rows.groupBy("label", *columns).agg(F.count(F.lit(1)).alias("weight"))
    roots = slice(len(tree.labels))
    placed = _placed(points, columns, tree.low[roots].min(axis=0), tree.high[roots].max(axis=0))
    parts = _PARTS_A_CORE * rows.sparkSession.sparkContext.defaultParallelism
    dealt = placed.repartitionByRange(parts, _PLACE, *columns).sortWithinPartitions(_PLACE)
    points = stage(dealt.drop(_PLACE), "points")
    n = int(tree.count[roots].sum())
    # The more points, the nearer are those of a group to each other, and the more meet the boxes together.
    group_rows = min(max(_GROUP_ROWS, points.count() // _GROUPS), _MOST_GROUP_ROWS)
    while True:
        bounds = _bounds_from_tree(tree, opening, group_rows)
        per_point = points.mapInArrow(bounds, "low double, high double, weight double")
        low, high = per_point.agg(
            *(F.sum(F.col(c) * F.col("weight")) / F.lit(float(n)) for c in ("low", "high"))
        ).first()
        if high - low <= tolerance:
            break
        # What single boxes leave uncertain falls with both; distinct points end it.
        share, opening = share / 8, opening / 2
        refine(rows, tree, share, "label")
    return rows.sparkSession.createDataFrame(
        [((low + high) / 2, low, high, n, len(tree.labels))],
        "silhouette double, silhouette_low double, silhouette_high double, n_rows long,"
        " n_clusters int",
    )


def _bounds_from_tree(tree: FeatureTree, opening: float, group_rows: int = _GROUP_ROWS):
    """A ``mapInArrow`` function giving each row's silhouette bounds.

    Rows are taken in groups of near ones, and a group meets the boxes once. It opens a box while a row's mean
    distance from it may be uncertain by more than ``opening`` of the smallest scale in the group; a row's
    scale is the distance to the nearest other cluster's mean.

    A row stands by ``a`` from its group's centre, a point of the box by ``b`` from the box's mean, the mean by d from
    the centre. Where d exceeds ``|a| + |b|``, the distance of row and point is Taylor's series in ``a - b``:
    d, the part of ``a - b`` along the line of sight, and the square of that across it over 2d; for
    the mean over the box's points the moments of the box are enough. Third derivatives of a distance
    are at most ``2 / sqrt(3)`` over its square, which bounds what is left by
    ``(|a| + |b|)^3 / (3 sqrt(3) (d - |a| - |b|)^2)``. Sums over boxes are kept as coefficients, so a row costs
    as much as its group has clusters. In the boxes left, row by row, the mean distance lies
    between that from the box's mean and the root of its square and the box's mean squared radius.
    """
    labels, d = len(tree.labels), len(tree.columns)
    count = np.maximum(tree.count, 1)
    squares = tree.error.sum(axis=1) / count
    spread = tree.error / count[:, None]
    mixed = tree.cross / count[:, None]
    held_points = tree.count > 0
    corner = np.maximum(tree.high - tree.mean, tree.mean - tree.low)
    radius = np.sqrt(np.where(held_points[:, None], corner, 0.0) ** 2 @ np.ones(d))
    # Means of |b| and its second and third power, at most.
    powers = np.column_stack([np.sqrt(squares), squares, radius * squares])
    sizes = tree.count[:labels].astype(float)
    forms = list(combinations_with_replacement(range(d), 2))
    held = [np.flatnonzero(tree.count[a : a + tree.fan]) + a for a in tree.first if a >= 0]
    many = np.zeros(len(tree.first), np.int64)
    many[tree.first >= 0] = [len(some) for some in held]
    children = np.concatenate([*held, np.zeros(0, np.int64)])
    begins = np.cumsum(many) - many

    def met(centre: np.ndarray, reach: np.ndarray, allowed: np.ndarray):
        """For each group and cluster the coefficients of far boxes; and the near boxes of each group."""
        n = len(centre)
        group, node = np.repeat(np.arange(n), labels), np.tile(np.arange(labels), n)
        series = np.zeros((n * labels, 1 + d + len(forms) + 4))
        groups, nodes = [], []
        while len(group):
            away, r = centre[group] - tree.mean[node], reach[group]
            distance = np.sqrt((away * away).sum(axis=1))
            gap = distance - r - radius[node]
            first, second, third = powers[node].T
            rest = ((r + 3 * first) * r + 3 * second) * r + third
            left = np.full(len(node), np.inf)
            np.divide(_THIRD * rest, gap * gap, out=left, where=gap > 1e-6 * distance)
            near = np.maximum(distance - r, 0.0)
            unsure = np.sqrt(near * near + squares[node]) - near
            end = many[node] == 0
            far = (2 * left <= allowed[group]) | (end & (2 * left <= unsure))
            some = np.flatnonzero(far)
            if len(some):
                g, k, w = group[some], node[some], tree.count[node[some]]
                cell = g * labels + tree.label[k]
                along, apart = away[some] / distance[some, None], distance[some]
                across = squares[k] - (spread[k] * along * along).sum(axis=1)
                for i, (a, b) in enumerate(tree.crossed):
                    across -= 2 * mixed[k, i] * along[:, a] * along[:, b]
                parts = [w * (apart + across / (2 * apart)), *(w[:, None] * along).T]
                half = w / (2 * apart)
                parts += [
                    half * ((a == b) - along[:, a] * along[:, b]) * (1 if a == b else 2)
                    for a, b in forms
                ]
                over = w * _THIRD / gap[some] ** 2
                parts += [over * third[some], 3 * over * second[some], 3 * over * first[some], over]
                for i, part in enumerate(parts):
                    series[:, i] += np.bincount(cell, part, n * labels)
            closed = ~far & (end | (unsure <= allowed[group]))
            groups.append(group[closed])
            nodes.append(node[closed])
            open_to = ~far & ~closed
            group, node = group[open_to], node[open_to]
            each = many[node]
            begin = np.repeat(begins[node] - (np.cumsum(each) - each), each)
            group, node = np.repeat(group, each), children[begin + np.arange(each.sum())]
        groups, nodes = np.concatenate(groups), np.concatenate(nodes)
        ends = np.cumsum(np.bincount(groups, minlength=n))[:-1]
        near_boxes = np.split(nodes[np.argsort(groups, kind="stable")], ends)
        return series.reshape(n, labels, -1), near_boxes

    def sums(
        x: np.ndarray, near: np.ndarray, centre: np.ndarray, series: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper sums of distances to the rows of each cluster from rows of a group,
        which are taken from its centre."""
        length = np.sqrt((x * x).sum(axis=1))
        terms = [np.ones(len(x)), *x.T, *(x[:, a] * x[:, b] for a, b in forms)]
        middle = np.column_stack(terms) @ series[:, : len(terms)].T
        rest = np.column_stack([length**i for i in range(4)]) @ series[:, len(terms) :].T
        low, high = middle - rest, middle + rest
        for at in range(0, len(near), _BOXES_AT_ONCE):
            node = near[at : at + _BOXES_AT_ONCE]
            mean = tree.mean[node] - centre
            squared = np.zeros((len(x), len(node)))
            for c in range(d):
                squared += (x[:, c, None] - mean[None, :, c]) ** 2
            weight = np.zeros((len(node), labels))
            weight[np.arange(len(node)), tree.label[node]] = tree.count[node]
            low += np.sqrt(squared) @ weight
            squared += squares[node]
            high += np.sqrt(squared, out=squared) @ weight
        return low, high

    def bounds_of(x: np.ndarray, mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows = np.arange(len(x))
        to_roots = np.zeros((len(x), labels))
        for c in range(d):
            to_roots += (x[:, c, None] - tree.mean[None, :labels, c]) ** 2
        # No mean distance to a cluster is below the distance to its mean.
        to_roots[rows, mine] = np.inf
        scale = np.sqrt(to_roots.min(axis=1))
        groups = _near_rows(x, group_rows)
        points = x[groups]
        centre = (points.max(axis=1) + points.min(axis=1)) / 2
        reach = np.sqrt(((points - centre[:, None]) ** 2).sum(axis=2).max(axis=1))
        allowed = opening * scale[groups].min(axis=1)
        near, far = np.empty((len(x), labels)), np.empty((len(x), labels))
        for at in range(0, len(groups), _GROUPS_AT_ONCE):
            some = slice(at, at + _GROUPS_AT_ONCE)
            series, boxes = met(centre[some], reach[some], allowed[some])
            for i, (group, middle) in enumerate(zip(groups[some], centre[some], strict=True)):
                near[group], far[group] = sums(x[group] - middle, boxes[i], middle, series[i])
        others = np.maximum(sizes[mine] - 1, 1)
        own_low, own_high = near[rows, mine] / others, far[rows, mine] / others
        near, far = near / sizes, far / sizes
        near[rows, mine] = np.inf
        far[rows, mine] = np.inf
        other_low, other_high = near.min(axis=1), far.min(axis=1)
        alone = sizes[mine] == 1  # counts 0
        low = np.where(alone, 0.0, _value(own_high, other_low))
        return low, np.where(alone, 0.0, _value(own_low, other_high))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = {name: i for i, name in enumerate(tree.labels)}

        def found(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
            x, mine, weight = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
            columns = [pa.array(v) for v in (*bounds_of(x, mine), weight)]
            return pa.RecordBatch.from_arrays(columns, ["low", "high", "weight"])

        parts: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for at in range(0, len(batch), _ROWS_AT_ONCE):
                parts.append(_points_of(batch.slice(at, _ROWS_AT_ONCE), tree.columns, code))
                if sum(len(mine) for _, mine, _ in parts) >= _ROWS_AT_ONCE:
                    yield found(parts)
                    parts = []
        if any(len(mine) for _, mine, _ in parts):
            yield found(parts)

    return bounds


def _near_rows(x: np.ndarray, group_rows: int) -> np.ndarray:
    """Groups of near rows as rows of indices, by halving at the median of the widest side; the last
    row fills up what the halves lack."""
    halvings = max(0, math.ceil(math.log2(len(x) / group_rows)))
    each = -(-len(x) // (1 << halvings))
    order = np.minimum(np.arange(each << halvings), len(x) - 1)[None]
    for _ in range(halvings):
        points = x[order]
        widest = (points.max(axis=1) - points.min(axis=1)).argmax(axis=1)
        side = np.take_along_axis(points, widest[:, None, None], axis=2)[:, :, 0]
        order = np.take_along_axis(order, side.argsort(axis=1), axis=1)
        order = order.reshape(2 * len(order), -1)
    return order


def _pairwise(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The silhouette from the distances between all rows.

    Equal rows of a cluster are one point with a weight. Points are dealt to regions along a curve that fills space,
    and a region's task halves its box down to leaves. Boxes far apart meet by polynomials that stand for the
    distance to about the last digits of a double, near leaves point by point (see ``distances``). A
    region is sent the leaves around it and the grids of the boxes farther off, so that what is sent and worked out
    grows about with the points, and a task holds a region and a part of what it is sent. The
    driver holds the edges of all boxes.
    """
    spark = rows.sparkSession
    ship(spark)
    weight = F.count(F.lit(1)).alias("weight")
    points = stage(rows.groupBy("label", *columns).agg(weight), "points")
    ends = [f(c) for f in (F.min, F.max) for c in columns]
    found = points.groupBy("label").agg(F.sum("weight"), F.count(F.lit(1)), *ends).collect()
    found.sort(key=lambda row: (row[0] is None, row[0]))
    d, labels, n = len(columns), len(found), sum(row[1] for row in found)
    if labels < 2:
        raise ValueError("a silhouette needs at least two clusters")
    code = {row[0]: i for i, row in enumerate(found)}
    sizes = np.array([row[1] for row in found], float)
    edges = np.array([row[3:] for row in found], float)
    low, high = edges[:, :d].min(axis=0), edges[:, d:].max(axis=0)
    n_points = sum(row[2] for row in found)
    # Large regions are sent less, but every core should have some.
    even = n_points // (_REGIONS_A_CORE * spark.sparkContext.defaultParallelism)
    region_rows = min(max(even, BLOCK_ROWS), _REGION_BLOCKS * BLOCK_ROWS)
    region_rows = max(1, min(region_rows, _CHUNK_CELLS // labels))
    regions = -(-n_points // region_rows)
    dealt = _placed(points, columns, low, high).repartitionByRange(regions, _PLACE, *columns)
    most = min(LEAF_ROWS, BLOCK_ROWS)
    blocks = stage(dealt.mapInArrow(_blocked(columns, code, most), _BLOCK), "blocks")
    boxes, first, roots = _all_boxes(blocks.where(F.col("kind") == _EDGES).toArrow(), d)
    wanted = spark.range(0, len(roots), 1, min(len(roots), 1_000)).mapInArrow(
        _wanted(boxes, first, roots), "target int, region int, box int, kind int"
    )
    # A hint, as the size of what a function returns is not known and may be large.
    sent = blocks.join(wanted.hint("merge"), ["region", "box", "kind"])
    own = (F.col("region") == F.col("target")) & (F.col("kind") == POINTS)
    sorted_rows = (
        sent.withColumn("own_points", own)
        .repartition(len(roots), "target")
        .sortWithinPartitions("target", F.desc("own_points"), "region", "box")
    )
    values = sorted_rows.mapInArrow(_met(boxes, first, roots, sizes), "total double")
    mean = F.sum("total") / F.lit(float(n))
    return values.agg(
        mean.alias("silhouette"),
        mean.alias("silhouette_low"),
        mean.alias("silhouette_high"),
        F.lit(n).cast("long").alias("n_rows"),
        F.lit(labels).cast("int").alias("n_clusters"),
    )


def _placed(points: DataFrame, columns: list[str], low: np.ndarray, high: np.ndarray) -> DataFrame:
    """Add points' place (``_PLACE``) on a curve that goes through octants of octants."""
    axes = columns[:60]
    bits = 60 // len(axes)
    width = np.maximum((high - low).max(), np.finfo(float).tiny)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.zeros(len(batch), np.int64)
            for c, name in enumerate(axes):
                x = batch.column(name).to_numpy(zero_copy_only=False).astype(float)
                step = np.nan_to_num((x - low[c]) / width * ((1 << bits) - 1))
                step = np.clip(step, 0, (1 << bits) - 1).astype(np.int64)
                for bit in range(bits):
                    found |= ((step >> bit) & 1) << (bit * len(axes) + c)
            yield batch.append_column(_PLACE, pa.array(found))

    kind = T.StructType([*points.schema.fields, T.StructField(_PLACE, T.LongType())])
    return points.mapInArrow(place, kind)


def _points_of(batch: pa.RecordBatch, columns: list[str], code: dict) -> tuple[np.ndarray, ...]:
    """Places, clusters and weights of points, each one row where there is no column of weights."""
    x = np.column_stack([batch.column(c).to_numpy(zero_copy_only=False) for c in columns])
    names = batch.column("label").dictionary_encode()
    known = np.array([code[name] for name in names.dictionary.to_pylist()], np.int32)
    # A null among the labels has no entry in the dictionary.
    own = names.indices.fill_null(-1).to_numpy()
    own = np.where(own >= 0, known[own], code.get(None, -1)) if len(known) else np.full(len(own), code[None])
    weighted = "weight" in batch.schema.names
    weight = batch.column("weight").to_numpy() if weighted else np.ones(len(batch))
    return x.astype(float), own.astype(np.int32), weight.astype(float)


def _by_cluster(own: np.ndarray, weight: np.ndarray, labels: int) -> np.ndarray:
    """Weights of points, a column a cluster."""
    out = np.zeros((len(own), labels))
    out[np.arange(len(own)), own] = weight
    return out


def _blocked(columns: list[str], code: dict, most: int):
    """A ``mapInArrow`` function packing a region: a row with the edges of its boxes, a row a leaf with
    its points, a row a grid with the weights of its nodes for the clusters its box holds."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_points_of(batch, columns, code) for batch in batches if len(batch)]
        if not parts:
            return
        x, own, weight = (np.concatenate(arrays) for arrays in zip(*parts, strict=True))
        boxes, order, begin = boxes_of(x, most)
        x, own, weight, labels = x[order], own[order], weight[order], len(code)
        tree = np.concatenate([boxes.left, boxes.right, boxes.count])
        none = np.zeros(0)
        rows = [(-1, _EDGES, np.concatenate([boxes.low, boxes.high]).ravel(), tree, none)]
        grids: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

        def seen(box: int, gap: float) -> list[tuple[np.ndarray, np.ndarray]]:
            """What stands for a box from ``gap`` away."""
            kind = boxes.kind_within(box, gap)
            if kind < POINTS:
                return [grids[box, kind]]
            if boxes.leaf[box]:
                some = slice(begin[box], begin[box] + boxes.count[box])
                return [(x[some], _by_cluster(own[some], weight[some], labels))]
            return seen(boxes.left[box], gap) + seen(boxes.right[box], gap)

        for box in reversed(range(len(begin))):  # halves come after their box
            if boxes.leaf[box]:
                some = slice(begin[box], begin[box] + boxes.count[box])
                rows.append((box, POINTS, x[some].ravel(), own[some], weight[some]))
                inside = [(x[some], _by_cluster(own[some], weight[some], labels))]
            for kind in np.flatnonzero(boxes.gridded[:, box]):
                gap = boxes.reach[kind, box]
                if not boxes.leaf[box]:
                    inside = seen(boxes.left[box], gap) + seen(boxes.right[box], gap)
                here, w = (np.concatenate(arrays) for arrays in zip(*inside, strict=True))
                present = np.flatnonzero((w != 0).any(axis=0))
                found = boxes.onto_grid(box, kind, here, w[:, present])
                rows.append((box, kind, none, present, found.T.ravel()))
                w = np.zeros((len(found), labels))
                w[:, present] = found
                grids[box, kind] = boxes.grid(box, kind), w
        region = TaskContext.get().partitionId()
        for at in range(0, len(rows), _ROWS_SENT):
            yield _block_rows(region, rows[at : at + _ROWS_SENT])

    return blocks


def _block_rows(region: int, rows: list[tuple]) -> pa.RecordBatch:
    box, kind, *arrays = zip(*rows, strict=True)
    columns = [pa.array(np.full(len(box), region, np.int32)), pa.array(box, pa.int32())]
    columns.append(pa.array(kind, pa.int32()))
    for values, held in zip(arrays, (pa.float64(), pa.int32(), pa.float64()), strict=True):
        ends = np.cumsum([0, *map(len, values)])
        flat = pa.array(np.concatenate(values), held)
        columns.append(pa.ListArray.from_arrays(pa.array(ends, pa.int32()), flat))
    return pa.RecordBatch.from_arrays(columns, ["region", "box", "kind", "x", "own", "weight"])


def _all_boxes(edges: pa.Table, d: int) -> tuple[Boxes, np.ndarray, np.ndarray]:
    """The boxes of all regions, one region after another; the number of each one's first box, by region, and
    the regions that have points."""
    edges = edges.sort_by("region")
    regions = edges.column("region").to_numpy()
    sides, trees = [], []
    for i in range(len(edges)):
        tree = edges.column("own")[i].values.to_numpy().astype(np.int64).reshape(3, -1)
        sides.append(edges.column("x")[i].values.to_numpy().reshape(2, -1, d))
        trees.append(tree)
    first = np.zeros(int(regions[-1]) + 1, np.int64)
    counts = np.array([tree.shape[1] for tree in trees])
    first[regions] = np.cumsum(counts) - counts
    for region, tree in zip(regions, trees, strict=True):
        tree[:2] += np.where(tree[:2] >= 0, first[region], 0)
    low, high = np.concatenate(sides, axis=1)
    return Boxes(low, high, *np.concatenate(trees, axis=1)), first, regions.astype(np.int64)


def _wanted(boxes: Boxes, first: np.ndarray, regions: np.ndarray):
    """A ``mapInArrow`` function giving the blocks that each region meets, and its own leaves."""

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = first[regions]
        for batch in batches:
            for target in regions[batch.column(0).to_numpy()]:
                root = int(first[target])
                met = meetings(boxes, root, starts)
                last = np.append(starts[1:], len(boxes.leaf))[np.searchsorted(regions, target)]
                mine = np.arange(root, last)
                mine = mine[boxes.leaf[mine]] * KINDS + POINTS
                keys = np.unique(np.concatenate([met[:, 2] * KINDS + met[:, 3], mine]))
                box = keys // KINDS
                which = np.searchsorted(starts, box, "right") - 1
                columns = (
                    np.full(len(keys), target), regions[which], box - starts[which], keys % KINDS
                )
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v.astype(np.int32)) for v in columns],
                    ["target", "region", "box", "kind"],
                )

    return wanted


class _Region:
    """Sums of distances from the points of a region to those of each cluster, as blocks come in."""

    def __init__(self, boxes: Boxes, root: int, last: int, roots: np.ndarray, labels: int) -> None:
        self.boxes, self.root, self.last, self.labels = boxes, root, last, labels
        met = meetings(boxes, root, roots)
        self.met = met[np.lexsort((met[:, 3], met[:, 1], met[:, 0]))]
        self.keys = self.met[:, 2] * KINDS + self.met[:, 3]
        self.leaves: dict[int, tuple[np.ndarray, ...]] = {}
        self.at_points: dict[int, np.ndarray] = {}
        self.at_grid: dict[tuple[int, int], np.ndarray] = {}

    def meet(self, blocks: list[tuple]) -> None:
        """Add distances to ``blocks``; those of the region's own leaves come before all others."""
        boxes, labels = self.boxes, self.labels
        keys, places, weights = [], [], []
        for box, kind, x, own, weight in blocks:
            if kind == POINTS:
                x = x.reshape(-1, boxes.low.shape[1])
                if self.root <= box < self.last:
                    self.leaves[box] = x, own, weight
                    self.at_points[box] = np.zeros((len(x), labels))
                w = _by_cluster(own, weight, labels)
            else:
                x = boxes.grid(box, kind)
                w = np.zeros((len(x), labels))
                w[:, own] = weight.reshape(len(own), -1).T
            keys.append(box * KINDS + kind)
            places.append(x)
            weights.append(w)
        order = np.argsort(keys)
        length = np.array([len(x) for x in places])
        begin = np.cumsum(length) - length
        place, weight = np.concatenate(places), np.concatenate(weights)
        known = np.array(keys)[order]
        at = np.minimum(np.searchsorted(known, self.keys), len(known) - 1)
        here = np.flatnonzero(known[at] == self.keys)
        block, met = order[at[here]], self.met[here]
        if not len(met):
            return
        cuts = np.flatnonzero((np.diff(met[:, [0, 1, 3]], axis=0) != 0).any(axis=1)) + 1
        for a, b in pairwise([0, *cuts, len(met)]):
            box, mine, _, its = map(int, met[a])
            some = block[a:b]
            each = length[some]
            index = np.repeat(begin[some] - (np.cumsum(each) - each), each) + np.arange(each.sum())
            if mine == POINTS:
                x, out = self.leaves[box][0], self.at_points[box]
            else:
                x = boxes.grid(box, mine)
                out = self.at_grid.setdefault((box, mine), np.zeros((len(x), labels)))
            add = add_near if mine == its == POINTS else add_apart
            add(out, x, place[index], weight[index], _TILE_CELLS)

    def total(self, sizes: np.ndarray) -> float:
        """The sum of the silhouettes of the region's rows."""
        boxes = self.boxes
        for box in range(self.root, self.last):  # from large to small
            for kind in range(POINTS):
                values = self.at_grid.pop((box, kind), None)
                if values is None:
                    continue
                gap = boxes.reach[kind, box]
                inside = [box] if boxes.leaf[box] else [boxes.left[box], boxes.right[box]]
                while inside:
                    part = int(inside.pop())
                    lower = boxes.kind_within(part, gap) if part != box else POINTS
                    if lower < POINTS:
                        nodes = boxes.off_grid(box, kind, values, boxes.grid(part, lower))
                        if (part, lower) in self.at_grid:
                            nodes += self.at_grid[part, lower]
                        self.at_grid[part, lower] = nodes
                    elif boxes.leaf[part]:
                        x = self.leaves[part][0]
                        self.at_points[part] += boxes.off_grid(box, kind, values, x)
                    else:
                        inside += [boxes.left[part], boxes.right[part]]
        found = 0.0
        for box, (_, own, weight) in self.leaves.items():
            totals, at = self.at_points[box], np.arange(len(own))
            a = totals[at, own] / np.maximum(sizes[own] - 1, 1)
            totals = totals / sizes
            totals[at, own] = np.inf
            value = np.where(sizes[own] == 1, 0.0, _value(a, totals.min(axis=1)))
            found += float((weight * value).sum())
        return found


def _met(boxes: Boxes, first: np.ndarray, regions: np.ndarray, sizes: np.ndarray):
    """A ``mapInArrow`` function over the blocks sent to regions, sorted by region: the sum of the silhouettes
    of each region's rows."""
    most = max(1, _CHUNK_CELLS // len(sizes))

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts = first[regions]
        lasts = np.append(starts[1:], len(boxes.leaf))
        region, target, blocks, held = None, None, [], 0

        def ended() -> pa.RecordBatch:
            if blocks:
                region.meet(blocks)
            return pa.RecordBatch.from_arrays([pa.array([region.total(sizes)])], ["total"])

        for batch in batches:
            targets, numbers, kinds = (
                batch.column(c).to_numpy() for c in ("target", "box", "kind")
            )
            numbers = numbers + first[batch.column("region").to_numpy()]
            arrays = [batch.column(c) for c in ("x", "own", "weight")]
            ends = [v.offsets.to_numpy() for v in arrays]
            flat = [v.values.to_numpy(zero_copy_only=False) for v in arrays]
            for i in range(len(batch)):
                if targets[i] != target:
                    if region is not None:
                        yield ended()
                    target, blocks, held = targets[i], [], 0
                    which = int(np.searchsorted(regions, target))
                    region = _Region(
                        boxes, int(starts[which]), int(lasts[which]), starts, len(sizes)
                    )
                box = int(numbers[i])
                own_points = kinds[i] == POINTS and region.root <= box < region.last
                if held >= most and not own_points:
                    region.meet(blocks)
                    blocks, held = [], 0
                # Copies, so that a batch is not kept for a few of its rows.
                x, own, weight = (
                    v[e[i] : e[i + 1]].copy() for v, e in zip(flat, ends, strict=True)
                )
                blocks.append((box, int(kinds[i]), x, own, weight))
                held += int(boxes.count[box] if kinds[i] == POINTS else boxes.cells[kinds[i], box])
        if region is not None:
            yield ended()

    return tasks


def _value(own: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Silhouettes of rows from their mean distances to their own and to the nearest other cluster."""
    larger = np.maximum(own, other)
    return np.divide(other - own, larger, out=np.zeros_like(own), where=larger > 0)


def _bounds_of_rows(known: pd.DataFrame, names: list, columns: list[str]):
    """A ``mapInPandas`` function giving each row's silhouette bounds."""
    centres = known[columns].to_numpy(float)
    spread = known["spread"].to_numpy(float)
    code = {name: i for i, name in enumerate(names)}
    # Column j holds the weights of the cells of cluster j.
    by_cluster = np.zeros((len(known), len(names)))
    by_cluster[np.arange(len(known)), known["label"].map(code)] = known["weight"]
    sizes = by_cluster.sum(axis=0)
    rows_at_once = max(1, _CHUNK_CELLS // len(known))

    def bounds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), rows_at_once):
                part = batch.iloc[start : start + rows_at_once]
                x = part[columns].to_numpy(float)
                squared = np.zeros((len(part), len(centres)))
                for c in range(len(columns)):
                    squared += (x[:, c, None] - centres[None, :, c]) ** 2
                near = np.sqrt(squared) @ by_cluster
                far = np.sqrt(squared + spread) @ by_cluster
                mine = part["label"].map(code).to_numpy()
                rows = np.arange(len(part))
                others = np.maximum(sizes[mine] - 1, 1)
                own_low, own_high = near[rows, mine] / others, far[rows, mine] / others
                near, far = near / sizes, far / sizes
                near[rows, mine] = np.inf
                far[rows, mine] = np.inf
                other_low, other_high = near.min(axis=1), far.min(axis=1)
                # A row alone in its cluster counts 0.
                alone = sizes[mine] == 1
                low = np.where(alone, 0.0, _value(own_high, other_low))
                high = np.where(alone, 0.0, _value(own_low, other_high))
                yield pd.DataFrame({"low": low, "high": high})

    return bounds
