"""Sums of distances by boxes, beside those of all pairs."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from patronage.operators import distances, features, silhouette
from patronage.session import stage


def _cloud(kind, n):
    rng = np.random.default_rng(11)
    x = rng.random((n, 3))
    if kind == "planes":  # whole numbers in one direction, as numbers of purchases are
        x = np.column_stack([rng.exponential(size=n), rng.poisson(10, n) / 3, rng.normal(size=n)])
    if kind == "outliers":  # a thousand times the width of the rest, and a dense corner
        x[: n // 50] *= 1000
        x[n // 2 :] *= 1e-5
    if kind == "copies":
        x = np.round(x, 1)
    return x


def _points_of(boxes, order, begin, box):
    return order[begin[box] : begin[box] + boxes.count[box]]


@pytest.mark.parametrize("kind", ["solid", "planes", "outliers", "copies"])
def test_boxes_meet_each_two_points_once(kind):
    x = _cloud(kind, 1_500)
    boxes, order, begin = distances.boxes_of(x, 20)
    met = np.zeros((len(x), len(x)), int)
    for t, mine, s, its in distances.meetings(boxes, 0, np.array([0])):
        met[np.ix_(_points_of(boxes, order, begin, t), _points_of(boxes, order, begin, s))] += 1
        gap = np.maximum(boxes.low[s] - boxes.high[t], boxes.low[t] - boxes.high[s])
        gap = np.sqrt((np.maximum(gap, 0) ** 2).sum())
        for box, how in ((t, mine), (s, its)):
            if how == distances.POINTS:
                assert boxes.leaf[box]
            else:
                assert gap >= distances.APART[how] * boxes.widest[box]
                assert boxes.cells[how, box] < boxes.count[box]
    assert (met == 1).all()


def test_what_is_worked_out_grows_about_with_the_points():
    """All pairs would be 16 times as many for four times the points."""
    found = []
    for n in (80_000, 320_000):
        boxes = distances.boxes_of(_cloud("planes", n), distances.LEAF_ROWS)[0]
        rows = np.vstack([boxes.cells, boxes.count])
        t, mine, s, its = distances.meetings(boxes, 0, np.array([0])).T
        found.append((rows[mine, t] * rows[its, s]).sum())
    assert found[1] < 6 * found[0]


@pytest.mark.parametrize("columns", [12, 24, 60])
def test_boxes_of_many_columns_have_no_grids(columns):
    """Their nodes would be more than a number of 64 bits holds."""
    x = np.random.default_rng(2).random((400, columns))
    boxes = distances.boxes_of(x, 50)[0]
    assert (boxes.cells > boxes.count).all() and not boxes.gridded.any()
    x[0, 0] = np.inf
    boxes = distances.boxes_of(x[:, :1], 50)[0]
    assert not boxes.gridded.any()


def brute(x, own, weight):
    """The mean silhouette of rows, some points being several."""
    labels = own.max() + 1
    sums = np.zeros((len(x), labels))
    for at in range(0, len(x), 500):
        squared = sum((x[at : at + 500, c, None] - x[None, :, c]) ** 2 for c in range(x.shape[1]))
        for c in range(labels):
            sums[at : at + 500, c] = np.sqrt(squared[:, own == c]) @ weight[own == c]
    sizes, rows = np.bincount(own, weight), np.arange(len(x))
    a = sums[rows, own] / (sizes[own] - 1)
    sums /= sizes
    sums[rows, own] = np.inf
    b = sums.min(axis=1)
    return float(((b - a) / np.maximum(a, b) * weight).sum() / weight.sum())


@pytest.mark.parametrize("kind", ["solid", "planes", "outliers"])
def test_silhouette_of_many_regions(spark, kind, monkeypatch):
    """Regions that meet by grids and by points; some points are thousands of rows."""
    monkeypatch.setattr(silhouette, "BLOCK_ROWS", 300)
    x = _cloud(kind, 9_000)
    own = np.digitize(x[:, 0] + 0.3 * x[:, 2], np.quantile(x[:, 0], [0.4, 0.8])).astype(int)
    weight = np.ones(len(x))
    weight[:3] = 4_000
    rows = [(f"c{c}", *map(float, p), int(w)) for c, p, w in zip(own, x, weight)]
    frame = spark.createDataFrame(rows, ["label", *features.SCALED, "n"])
    frame = stage(frame.withColumn("copy", F.explode(F.sequence(F.lit(1), "n"))).drop("n", "copy"))
    row = silhouette.silhouette_euclidean(frame, "label", method="pairwise").head()
    assert row["silhouette"] == pytest.approx(brute(x, own, weight), abs=1e-12)
    assert (row["n_rows"], row["n_clusters"]) == (8_997 + 12_000, 3)


def test_silhouette_of_a_cluster_without_a_name(spark):
    x = _cloud("planes", 600)
    own = (x[:, 0] > 1).astype(int)
    rows = [(None if c else "a", *map(float, p)) for c, p in zip(own, x)]
    frame = spark.createDataFrame(rows, "label string, " + ", ".join(f"{c} double" for c in features.SCALED))
    row = silhouette.silhouette_euclidean(frame, "label", method="pairwise").head()
    assert row["silhouette"] == pytest.approx(brute(x, own, np.ones(len(x))), abs=1e-12)


def test_equal_rows_meet_the_trees_as_one_point_and_groups_grow_with_the_points(spark, monkeypatch):
    """Points come by their place, so that groups of more points are not larger boxes."""
    x = _cloud("planes", 4_000)
    own = np.digitize(x[:, 0], [0.4, 1.2])
    weight = np.where(np.arange(len(x)) % 3 == 0, 4, 1)
    rows = [(int(c), *map(float, p), int(w)) for c, p, w in zip(own, x, weight)]
    frame = spark.createDataFrame(rows, ["label", *features.SCALED, "n"])
    frame = frame.withColumn("copy", F.explode(F.sequence(F.lit(1), "n"))).drop("n", "copy")
    staged, sizes, bounds = {}, [], silhouette._bounds_from_tree

    def noted(df, name="stage"):
        staged[name] = stage(df, name)
        return staged[name]

    def grouped(tree, opening, group_rows):
        sizes.append(group_rows)
        return bounds(tree, opening, group_rows)

    monkeypatch.setattr(silhouette, "stage", noted)
    monkeypatch.setattr(silhouette, "_bounds_from_tree", grouped)
    monkeypatch.setattr(silhouette, "_GROUPS", 50)
    row = silhouette.silhouette_euclidean(frame, "label", tolerance=0.01).head()
    expected = brute(x, own, weight)
    assert row["silhouette_low"] - 1e-9 <= expected <= row["silhouette_high"] + 1e-9
    assert row["silhouette_high"] - row["silhouette_low"] <= 0.01
    assert (row["n_rows"], row["n_clusters"]) == (weight.sum(), 3)
    assert staged["points"].count() == len(x)
    assert set(sizes) == {80}
    # A file holds one part of the space: far less than all of it.
    file = F.input_file_name().alias("file")
    width = [F.max(c) - F.min(c) for c in features.SCALED[1:]]
    parts = staged["points"].select(file, *features.SCALED).groupBy("file").agg(*width).collect()
    area = np.prod([p[1:] for p in parts], axis=1)
    assert np.median(area) < 0.4 * np.prod(np.ptp(x[:, 1:], axis=0))
