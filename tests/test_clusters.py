import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from patronage.operators import (
    centres,
    cftree,
    comparison,
    elbow,
    features,
    hierarchy,
    kmeans,
    manycentres,
    scoring,
    silhouette,
)
from patronage.plans import queries, segmentation
from patronage.schema import METRICS, TRANSACTION_SCHEMA
from patronage.session import scratch_path, stage
from patronage.sources import results
from pyspark.sql import functions as F

BLOBS = [(10, 2, 50.0), (200, 20, 900.0), (400, 8, 3000.0)]


@pytest.fixture(scope="module")
def blobs(make_rfm):
    rng = np.random.default_rng(5)
    rows = []
    for b, (r, f, m) in enumerate(BLOBS):
        for i in range(30 + 10 * b):
            noise = rng.normal(size=3)
            rows.append((100 * b + i, int(r + 3 * noise[0]), max(1, int(f + noise[1])),
                         round(float(m + 20 * noise[2]), 2)))
    return stage(make_rfm(rows))


def matrix(df, columns):
    rows = sorted(df.select("customer_id", *columns).collect())
    return np.array([[float(v) for v in r[1:]] for r in rows])


def test_standardize(blobs):
    raw, z = matrix(blobs, METRICS), matrix(features.standardize(blobs), features.SCALED)
    assert np.allclose(z, (raw - raw.mean(axis=0)) / raw.std(axis=0))
    unit = matrix(features.minmax(blobs), features.SCALED)
    assert np.allclose(unit, (raw - raw.min(axis=0)) / (raw.max(axis=0) - raw.min(axis=0)))


def test_constant_metrics(make_rfm):
    rfm = make_rfm([(1, 5, 2, 3.0), (2, 5, 2, 3.0)])
    assert (matrix(features.standardize(rfm), features.SCALED) == 0).all()
    assert (matrix(features.minmax(rfm), features.SCALED) == 0.5).all()


def test_kmeans_finds_the_blobs_and_assigns_to_the_nearest_centre(blobs):
    model = kmeans.fit_kmeans(blobs, 3, seeds=(1, 2, 3))
    assigned = kmeans.assign(model, blobs).collect()
    groups = {}
    for r in assigned:
        groups.setdefault(r["customer_id"] // 100, set()).add(r["Cluster"])
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == 3
    scaled = model.transform(blobs).select(kmeans.SCALED_VECTOR, "Cluster").collect()
    fitted = np.array(model.stages[-1].clusterCenters())
    for r in scaled:
        distances = ((fitted - r[0].toArray()) ** 2).sum(axis=1)
        assert distances[r["Cluster"]] == distances.min()
    assert kmeans.silhouette_squared(model.transform(blobs)) > 0.9
    with pytest.raises(ValueError):
        kmeans.fit_kmeans(blobs, 8)
    with pytest.raises(ValueError):
        kmeans.fit_kmeans(blobs, 3, scaler="log")


def test_saved_model_predicts_the_same(blobs, spark):
    model = kmeans.fit_kmeans(blobs, 3, scaler="minmax")
    path = scratch_path(spark, "model")
    results.save_model(model, path)
    loaded = results.load_model(path)
    assert sorted(kmeans.assign(model, blobs).collect()) == sorted(
        kmeans.assign(loaded, blobs).collect()
    )


def test_elbow(blobs):
    costs = {r["k"]: r["sse"] for r in kmeans.elbow(blobs, range(1, 5)).collect()}
    n = blobs.count()
    assert costs[1] == pytest.approx(3 * n)
    one = features.squared_error_of_one_cluster(features.standardize(blobs)).head()["sse"]
    assert costs[1] == pytest.approx(one)
    assert costs[1] > costs[2] > costs[3] >= costs[4] * 0.99
    z = matrix(features.standardize(blobs), features.SCALED)
    ids = np.array([r[0] // 100 for r in sorted(blobs.select("customer_id").collect())])
    within = sum(((z[ids == b] - z[ids == b].mean(axis=0)) ** 2).sum() for b in range(3))
    assert costs[3] == pytest.approx(within)


def brute_lloyd(x, centres):
    """Rounds over all points until nothing moves."""
    while True:
        near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
        moved = np.array(
            [x[near == j].mean(axis=0) if (near == j).any() else c for j, c in enumerate(centres)]
        )
        if np.abs(moved - centres).max() <= elbow.TOLERANCE:
            return moved, near
        centres = moved


@pytest.mark.parametrize("share", [1.0, 0.05, 1e-4])
def test_all_numbers_of_clusters_at_once_equal_rounds_over_all_rows(spark, monkeypatch, share):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(600, 3)) * [1, 2, 0.1]
    x[:200] = x[0]  # a third of all rows are copies of one point
    points = stage(spark.createDataFrame(x.tolist(), "a double, b double, c double"))
    begin = {k: x[200 : 200 + k].copy() for k in range(1, 8)}
    monkeypatch.setattr(elbow, "LEAVES_PER_CLUSTER", 1)
    monkeypatch.setattr(elbow, "starts", lambda means, weight, ks, seed: {k: begin[k] for k in ks})
    for fit in elbow.fit_all(points, ["a", "b", "c"], list(begin), 0, 300, share):
        centres, near = brute_lloyd(x, begin[fit.k])
        assert fit.converged and fit.centres == pytest.approx(centres, abs=1e-4)
        assert fit.sse == pytest.approx(((x - centres[near]) ** 2).sum())
        assert fit.counts.tolist() == np.bincount(near, minlength=fit.k).tolist()
        assert fit.compared <= 600 * fit.rounds
    one = elbow.fit_all(points, ["a", "b", "c"], [5], 0, 1, share)[0]
    assert not one.converged and one.rounds == 1
    with pytest.raises(ValueError):
        elbow.fit_all(points.where("false"), ["a", "b", "c"], [1], 0, 5)
    with pytest.raises(ValueError):
        kmeans.elbow(points, [1], scaler="log")


def test_errors_shown_add_up_where_rows_still_change_centres(blobs, monkeypatch):
    monkeypatch.setattr(elbow, "TOLERANCE", 0.3)
    monkeypatch.setattr(elbow, "START_ROUNDS", 0)
    scaled = stage(features.standardize(blobs), "scaled")
    shown = queries._elbow_shown(blobs, scaled, "standard").collect()
    assert {round(row.sse_of_one, 4) for row in shown} == {round(3.0 * blobs.count(), 4)}


def test_no_centre_is_ruled_out_that_is_nearest_in_its_box():
    rng = np.random.default_rng(4)
    for _ in range(50):
        centres = rng.integers(0, 5, (6, 2)).astype(float)
        low = rng.integers(0, 4, (20, 2)).astype(float)
        high = low + rng.integers(0, 3, (20, 2))
        may = elbow.candidates(low, high, (low + high) / 2, centres)
        for i in range(20):
            x = low[i] + rng.random((40, 2)) * (high[i] - low[i])
            near = ((x[:, None] - centres[None]) ** 2).sum(axis=2).argmin(axis=1)
            assert may[i, near].all()


def test_feature_tree(spark, monkeypatch):
    rng = np.random.default_rng(6)
    x = np.round(rng.normal(size=(500, 2)), 2)
    labels = rng.integers(0, 3, 500)
    rows = [(int(label), *map(float, point)) for label, point in zip(labels, x)]
    points = stage(spark.createDataFrame(rows, "label int, a double, b double"))
    for share in (1, 0.1, 0.003, 0):
        tree = cftree.feature_tree(points, ["a", "b"], share, "label")
        total = sum(((x[labels == k] - x[labels == k].mean(axis=0)) ** 2).sum() for k in range(3))
        assert tree.total == pytest.approx(total)
        assert tree.inside <= share * total + 1e-9
        placed = cftree.with_leaf(points, tree, label="label").toPandas()
        assert (tree.label[placed["leaf"]] == placed["label"]).all()
        for leaf, own in placed.groupby("leaf"):
            own = own[["a", "b"]].to_numpy()
            assert tree.count[leaf] == len(own)
            assert tree.mean[leaf] == pytest.approx(own.mean(axis=0))
            assert tree.error[leaf].sum() == pytest.approx(
                ((own - own.mean(axis=0)) ** 2).sum(), abs=1e-9
            )
            assert (tree.low[leaf] == own.min(axis=0)).all()
            assert (tree.high[leaf] == own.max(axis=0)).all()
        if share == 0:
            assert len(tree.leaves) == len(set(rows))
    assert cftree.feature_tree(points.where("false"), ["a", "b"], 0.1).leaves.size == 0
    monkeypatch.setattr(cftree, "MOST_NODES", 20)
    with pytest.raises(ValueError, match="more than 20 nodes"):
        cftree.feature_tree(points, ["a", "b"], 0.001)


def test_assign_nearest(spark, blobs):
    given = [(7, *BLOBS[0]), (3, *BLOBS[1]), (5, *BLOBS[2])]
    rows = kmeans.assign_nearest(blobs, given, METRICS).collect()
    assert {(r["customer_id"] // 100, r["cluster"]) for r in rows} == {(0, 7), (1, 3), (2, 5)}
    tied = [(2, *BLOBS[0]), (1, *BLOBS[0])]
    assert {r["cluster"] for r in kmeans.assign_nearest(blobs, tied, METRICS).collect()} == {1}
    with pytest.raises(ValueError):
        kmeans.assign_nearest(blobs, [], METRICS)
    many = [(i, 1e6 + i, 0.0, 0.0) for i in range(150)] + [(150, *BLOBS[0])]
    assert {r["cluster"] for r in kmeans.assign_nearest(blobs, many, METRICS).collect()} == {150}


def test_nearest_of_many_equals_all_distances():
    rng = np.random.default_rng(3)
    for n, d, values in ((1, 3, 9), (40, 1, 5), (700, 2, 12), (3_000, 3, 40), (500, 3, 2)):
        # Few distinct coordinates make ties and equal centres.
        points = rng.integers(0, values, (n, d)) / 4
        numbers = rng.permutation(n) - 5
        x = np.concatenate([rng.integers(0, values, (300, d)) / 4, rng.normal(0, 99, (300, d))])
        x[0] = np.inf
        away = np.zeros((len(x), n))
        for c in range(d):
            away += (x[:, c][:, None] - points[:, c]) ** 2
        least = away.min(axis=1)
        want = np.where(away == least[:, None], numbers, numbers.max() + 1).min(axis=1)
        number, squared = manycentres.CentreTree(numbers, points).search(x)
        assert (number == want).all() and (squared == least).all()


def test_nearest_of_many_rows(spark, blobs):
    given = [(7, *BLOBS[0]), (3, *BLOBS[1]), (5, *BLOBS[2]), (9, *BLOBS[2])]
    values = [F.col(m) for m in METRICS]
    few = centres.nearest(blobs, values, given)
    rows = [(number, *map(float, centre)) for number, *centre in given]
    table = spark.createDataFrame(rows, "`a b` int, x double, `y.z` double, w double")
    for some in (given, table, manycentres.centre_tree(given)):
        many = manycentres.nearest_of_many(blobs, values, some)
        assert many.columns == few.columns
        assert sorted(many.collect()) == sorted(few.collect())
    assert manycentres.nearest_of_many(blobs.where("false"), values, given).count() == 0
    odd = spark.createDataFrame(
        [(1, None, 2.0), (2, float("nan"), 1.0), (3, 1.0, 1.0), (3, 1.0, 1.0)],
        "Cluster int, `a.b` double, `x ``y` double",
    )
    parts = [F.col("`a.b`"), F.col("`x ``y`")]
    rows = manycentres.nearest_of_many(odd, parts, [(1, 0.0, 1.0), (4, 3.0, 1.0)])
    assert rows.columns == ["a.b", "x `y", "cluster", "distance"]
    assert sorted((r["cluster"], r["distance"]) for r in rows.collect() if r["cluster"]) == [
        (1, 1.0)
    ] * 2
    assert rows.where("cluster is null and distance is null").count() == 2
    for wrong in ([], [(1, None, 1.0)], [(1, 1.0)]):
        with pytest.raises(ValueError):
            manycentres.nearest_of_many(odd, parts, wrong)
    with pytest.raises(ValueError, match="more than 2 centres"):
        manycentres.nearest_of_many(blobs, values, table, most=2)


@pytest.mark.parametrize("scaler", ["standard", "minmax"])
def test_centre_table_assigns_as_the_pipeline_does(spark, blobs, scaler):
    model = kmeans.fit_kmeans(blobs, 3, scaler=scaler)
    assert kmeans.converged(model)
    path = scratch_path(spark, "centres")
    centres.save_centres(spark, centres.centre_model(model), path)
    loaded = centres.load_centres(spark, path)
    assert loaded == centres.centre_model(model)
    assert sorted(centres.assign_centres(loaded, blobs).collect()) == sorted(
        kmeans.assign(model, blobs).collect()
    )
    again = centres.rescaled(loaded, blobs)
    assert np.allclose(again.shift, loaded.shift) and np.allclose(again.scale, loaded.scale)


def test_a_fit_cut_short_says_so(blobs):
    assert not kmeans.converged(kmeans.fit_kmeans(blobs, 5, max_iterations=1))


def test_profiles(spark, blobs):
    assigned = blobs.withColumn("Cluster", F.expr("int(customer_id div 100)"))
    rows = {r["Cluster"]: r for r in kmeans.cluster_profile(assigned, 3).collect()}
    assert {c: r["Count"] for c, r in rows.items()} == {
        "Cluster 0": 30, "Cluster 1": 40, "Cluster 2": 50}
    names = [r["Cluster"] for r in kmeans.cluster_profile_descending(assigned, 3).collect()]
    assert names == ["Cluster 2", "Cluster 1", "Cluster 0"]
    joined = kmeans.attach_clusters(blobs, assigned.where("Cluster > 0"))
    assert joined.count() == 90


def brute_silhouette(x, labels):
    labels = np.array(labels)
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    values = []
    for i, own in enumerate(labels):
        same = labels == own
        if same.sum() == 1:
            values.append(0.0)
            continue
        a = d[i, same].sum() / (same.sum() - 1)
        b = min(d[i, labels == c].mean() for c in set(labels) - {own})
        values.append((b - a) / max(a, b) if max(a, b) > 0 else 0.0)
    return float(np.mean(values))


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(3)
    x = np.round(rng.normal(size=(240, 3)), 1)
    x[:80] = x[0]  # a third of all rows are copies of one point
    labels = [("a", "b", "c")[int(v > -0.5) + int(v > 0.7)] for v in x[:, 0] + x[:, 1]]
    labels[-1] = "alone"
    rows = [(label, *map(float, point)) for label, point in zip(labels, x)]
    return spark.createDataFrame(rows, ["label", *features.SCALED]), x, labels


@pytest.mark.parametrize("block", [2000, 50])
def test_pairwise_silhouette(labelled, block, monkeypatch):
    monkeypatch.setattr(silhouette, "BLOCK_ROWS", block)
    df, x, labels = labelled
    row = silhouette.silhouette_euclidean(df, "label", method="pairwise").head()
    expected = brute_silhouette(x, labels)
    for name in ("silhouette", "silhouette_low", "silhouette_high"):
        assert row[name] == pytest.approx(expected, abs=1e-12)
    assert (row["n_rows"], row["n_clusters"]) == (240, 4)


def test_pairwise_silhouette_of_copies_and_blocks_met_once(labelled, monkeypatch):
    """Copies count as rows but meet others as one point; what is written grows with the points."""
    monkeypatch.setattr(silhouette, "BLOCK_ROWS", 20)
    monkeypatch.setattr(silhouette, "_TILE_CELLS", 100)
    df, x, labels = labelled
    staged = {}

    def noted(frame, name="stage"):
        staged[name] = stage(frame, name)
        return staged[name]

    monkeypatch.setattr(silhouette, "stage", noted)
    many = df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(5)))).drop("copy")
    row = silhouette.silhouette_euclidean(many, "label", method="pairwise").head()
    expected = brute_silhouette(np.repeat(x, 5, axis=0), np.repeat(labels, 5))
    assert row["silhouette"] == pytest.approx(expected, abs=1e-12)
    assert (row["n_rows"], row["n_clusters"]) == (1200, 4)
    codes = np.unique(labels, return_inverse=True)[1]
    assert staged["points"].count() == len(np.unique(np.column_stack([x, codes]), axis=0))
    assert staged["blocks"].count() > 4


@pytest.mark.parametrize("micro", [2, 20, 60])
def test_bounded_silhouette_encloses_the_exact_one(labelled, micro):
    df, x, labels = labelled
    row = silhouette.silhouette_euclidean(df, "label", method="cells", micro=micro).head()
    expected = brute_silhouette(x, labels)
    assert row["silhouette_low"] - 1e-9 <= expected <= row["silhouette_high"] + 1e-9
    if micro == 60:
        assert row["silhouette_high"] - row["silhouette_low"] < 0.2
    assert row["n_rows"] == 240


@pytest.mark.parametrize("tolerance", [0.2, 0.01, 1e-6])
def test_silhouette_to_a_tolerance(labelled, tolerance):
    df, x, labels = labelled
    row = silhouette.silhouette_euclidean(df, "label", tolerance=tolerance).head()
    expected = brute_silhouette(x, labels)
    assert row["silhouette_low"] - 1e-9 <= expected <= row["silhouette_high"] + 1e-9
    assert row["silhouette_high"] - row["silhouette_low"] <= tolerance
    assert (row["n_rows"], row["n_clusters"]) == (240, 4)
    with pytest.raises(ValueError):
        silhouette.silhouette_euclidean(df, "label", tolerance=0)


@pytest.mark.parametrize("opening", [1e-4, 0.05, 1.0])
def test_each_row_is_within_its_bounds_met_in_groups(spark, opening):
    """Rows of skew clusters, near and far, in groups of 32 that meet the boxes together."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(900, 3)) @ np.array([[2.0, 1.5, 0], [0, 0.5, -0.4], [0, 0, 0.2]])
    labels = np.arange(900) % 3
    x[labels == 1] += [9, 0, 0]
    x[labels == 2] += [40, 30, 0]
    rows = [(int(own), *map(float, point)) for own, point in zip(labels, x)]
    points = stage(spark.createDataFrame(rows, "label int, a double, b double, c double"))
    tree = cftree.feature_tree(points, ["a", "b", "c"], 0.05, "label", mixed=True)
    for node in range(3):
        about = x[labels == node] - x[labels == node].mean(axis=0)
        products = [(about[:, a] * about[:, b]).sum() for a, b in tree.crossed]
        assert tree.cross[node] == pytest.approx(products)
    frame = pd.DataFrame({"label": labels, "a": x[:, 0], "b": x[:, 1], "c": x[:, 2]})
    found = silhouette._bounds_from_tree(tree, opening)(iter([pa.RecordBatch.from_pandas(frame)]))
    low, high = (np.concatenate(v) for v in zip(*((b["low"], b["high"]) for b in found)))
    away = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    mean = np.column_stack([away[:, labels == c].sum(axis=1) / 300 for c in range(3)])
    own = mean[np.arange(900), labels] * 300 / 299
    mean[np.arange(900), labels] = np.inf
    exact = (mean.min(axis=1) - own) / np.maximum(mean.min(axis=1), own)
    assert (low - 1e-9 <= exact).all() and (exact <= high + 1e-9).all()


def test_cells_of_a_column_are_bounded(labelled, monkeypatch):
    monkeypatch.setattr(silhouette, "MOST_CELLS", 10)
    rows = labelled[0].withColumn("cell", F.monotonically_increasing_id())
    with pytest.raises(ValueError, match="more than 10 cells"):
        silhouette.silhouette_euclidean(rows, "label", cell="cell")


@pytest.mark.parametrize("method", ["tree", "cells", "pairwise"])
def test_silhouette_needs_two_clusters(labelled, method):
    with pytest.raises(ValueError):
        silhouette.silhouette_euclidean(labelled[0].where("label = 'a'"), "label", method=method)
    with pytest.raises(ValueError):
        silhouette.silhouette_euclidean(labelled[0], "label", method="sampled")


def test_silhouette_by_given_cells(labelled):
    df, x, labels = labelled
    rows = df.withColumn("cell", F.concat_ws(",", *(F.round(c).cast("string") for c in features.SCALED)))
    row = silhouette.silhouette_euclidean(rows, "label", cell="cell").head()
    expected = brute_silhouette(x, labels)
    assert row["silhouette_low"] - 1e-9 <= expected <= row["silhouette_high"] + 1e-9


def brute_ward(weights, centres):
    """Cheapest merge first, over all pairs."""
    nodes = {i: (float(w), np.array(c, float)) for i, (w, c) in enumerate(zip(weights, centres))}
    merges, following = [], len(nodes)
    while len(nodes) > 1:
        height, a, b = min(
            (float(np.sqrt(2 * wa * wb / (wa + wb) * ((ca - cb) ** 2).sum())), a, b)
            for a, (wa, ca) in nodes.items() for b, (wb, cb) in nodes.items() if a < b
        )
        (wa, ca), (wb, cb) = nodes.pop(a), nodes.pop(b)
        nodes[following] = (wa + wb, (wa * ca + wb * cb) / (wa + wb))
        merges.append((a, b, height, int(wa + wb)))
        following += 1
    return merges


@pytest.mark.parametrize("seed", range(5))
def test_merge_tree_matches_brute_force(seed):
    rng = np.random.default_rng(seed)
    weights, centres = rng.integers(1, 6, 40), rng.normal(size=(40, 3))
    ours, theirs = hierarchy.ward_merges(weights, centres), brute_ward(weights, centres)
    assert [(a, b, size) for a, b, _, size in ours] == [(a, b, size) for a, b, _, size in theirs]
    assert [m[2] for m in ours] == pytest.approx([m[2] for m in theirs])


def test_hand_computed_tree():
    # On a line at 0, 1, 5, 7: first 0-1 (height 1), then 5-7 (2), then both pairs:
    # sqrt(2 * 2 * 2 / 4) * |6 - 0.5|.
    merges = hierarchy.ward_merges(np.ones(4), np.array([[0.0], [1.0], [5.0], [7.0]]))
    assert [(a, b, n) for a, b, _, n in merges] == [(0, 1, 2), (2, 3, 2), (4, 5, 4)]
    assert [m[2] for m in merges] == pytest.approx([1.0, 2.0, 2**0.5 * 5.5])
    assert hierarchy.cut_tree(merges, np.ones(4), 2) == [0, 0, 1, 1]
    assert hierarchy.cut_tree(merges, np.ones(4), 4) == [0, 1, 2, 3]


def test_merge_tree_on_a_line_of_growing_gaps():
    rng = np.random.default_rng(9)
    weights, centres = rng.integers(1, 6, 60), rng.normal(size=(60, 3))
    # Growing gaps on a line leave one mutual pair per round.
    centres[:12] = np.array([[100 + 2.0**i, 0, 0] for i in range(12)])
    ours = hierarchy.ward_merges(weights, centres)
    theirs = brute_ward(weights, centres)
    assert [(a, b, size) for a, b, _, size in ours] == [(a, b, size) for a, b, _, size in theirs]


def test_merge_tree_with_equal_distances():
    grid = np.array([[x, y, 0.0] for x in range(6) for y in range(6)])
    merges = hierarchy.ward_merges(np.ones(36), grid)
    assert len(merges) == 35 and merges[-1][3] == 36
    assert sorted(n for left, right, _, _ in merges for n in (left, right)) == list(range(70))


@pytest.mark.parametrize("share", [0, 0.002, 0.02])
def test_ward_segments(blobs, share):
    found = hierarchy.ward(blobs, share)
    segments, tree = found.segments(3), found.tree
    rows = segments.collect()
    assert len(rows) == 120
    assert {(r["customer_id"] // 100, r["Cluster"]) for r in rows} == {(0, 2), (1, 1), (2, 0)}
    heights = [r["height"] for r in tree.orderBy("step").collect()]
    assert heights == sorted(heights)
    assert tree.orderBy(F.desc("step")).head()["size"] == 120
    with pytest.raises(ValueError):
        hierarchy.ward_segments(stage(blobs.limit(2)), 3)
    one = features.squared_error_of_one_cluster(features.standardize(blobs)).head()["sse"]
    between = sum(r["height"] ** 2 for r in tree.collect()) / 2
    assert between + found.squared_error_inside == pytest.approx(one)
    assert found.squared_error == pytest.approx(one)
    assert found.squared_error_inside <= share * one + 1e-9
    z = matrix(features.standardize(blobs).join(segments, "customer_id"), ["customer_id", "Cluster"])
    assert len(z) == 120
    within = 0.0
    for cluster in range(3):
        own = matrix(segments.where(F.col("Cluster") == cluster), features.SCALED)
        within += ((own - own.mean(axis=0)) ** 2).sum()
    assert found.squared_error_of(3) == pytest.approx(within)


def test_tree_of_the_cells_equals_brute_force(blobs):
    found = hierarchy.ward(blobs, 0.001)
    assert 5 < len(found.cells) < 100
    expected = brute_ward(
        found.cells["weight"].to_numpy(), found.cells[list(features.SCALED)].to_numpy()
    )
    assert [m[2] for m in found.merges] == pytest.approx([m[2] for m in expected])
    assert [m[3] for m in found.merges] == [m[3] for m in expected]
    for k in (2, 5):
        assert found.segments(k).select("Cluster").distinct().count() == k


def test_bisecting(blobs):
    rows = kmeans.bisecting_segments(blobs, 3).collect()
    assert len({(r["customer_id"] // 100, r["Cluster"]) for r in rows}) == 3


def test_scoring_uses_the_trained_scaler(spark, blobs):
    model = kmeans.fit_kmeans(blobs, 3)
    rows = spark.sql(
        "select 'new' customer_id, date '1998-06-20' transaction_date, 1 num_cds_purchased,"
        " cast(25 as decimal(18,2)) transaction_value from range(2)"
    )
    one = scoring.score(rows, model).head()
    assert (one["Recency"], one["Frequency"], float(one["Monetary"])) == (10, 2, 50.0)
    near = kmeans.assign(model, blobs).where("customer_id < 100").head()["Cluster"]
    assert one["Cluster"] == near
    both = scoring.score(rows.union(rows.withColumn("customer_id", F.lit("other"))), model)
    assert {r["Cluster"] for r in both.collect()} == {near}
    single = scoring.score_single(rows.drop("customer_id"), model).collect()
    assert [(r["customer_id"], r["Cluster"]) for r in single] == [("00001", near)]
    late = rows.withColumn("transaction_date", F.expr("date '1999-01-01'"))
    assert scoring.score_single(late, model).count() == 0
    with pytest.raises(ValueError):
        scoring.score(rows, model, rescale="other")


def test_rescaling_to_the_batch(spark, blobs):
    model = kmeans.fit_kmeans(blobs, 3)
    rows = spark.createDataFrame(
        [(f"c{i}", i % 2) for i in range(20)], "customer_id string, kind int"
    ).selectExpr(
        "customer_id",
        "if(kind = 0, date '1998-06-01', date '1997-06-01') transaction_date",
        "1 num_cds_purchased", "cast(if(kind = 0, 10, 2000) as decimal(18,2)) transaction_value",
    )
    scored = scoring.score(rows, model, rescale="batch").collect()
    assert len(scored) == 20 and len({r["Cluster"] for r in scored}) == 2
    alone = scoring.score(rows.limit(1), model, rescale="batch").collect()
    assert len(alone) == 1


def test_timed_includes_the_work(spark):
    result, seconds = comparison.timed(lambda: spark.range(1000).selectExpr("sum(id) as s"))
    assert seconds > 0 and result.head()["s"] == 499500


def test_project_from_transactions_to_model_selection(spark):
    rows = spark.range(400).selectExpr(
        "lpad(string(id % 40), 5, '0') customer_id",
        "date_add(date '1997-01-01', int(id * 7 % 300)) transaction_date",
        "int(1 + id % 3) num_cds_purchased",
        "cast(5 + (id * id) % 90 as decimal(18,2)) transaction_value",
    )
    assert rows.columns == TRANSACTION_SCHEMA.fieldNames()
    root = scratch_path(spark, "project")
    segmentation.build_project(spark, rows, 3, root)
    comparison_table = segmentation.build_project(spark, rows, 2, root)
    assert comparison_table.count() == 6
    chosen, combined = segmentation.select_model(spark, 2, root)
    assert {r["Model"] for r in chosen.collect()} == {
        "RFM Analysis", "KMean Clustering", "Hierachical Clustering"}
    assert "Number of Clusters" not in chosen.columns + combined.columns
    sizes = {}
    for r in combined.collect():
        sizes[r["Model"]] = sizes.get(r["Model"], 0) + r["Count"]
    assert sizes == {"RFM": 40, "KMeans": 40, "Hierarchical": 40}
