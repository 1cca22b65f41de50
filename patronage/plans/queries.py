"""Every operator as a query over the given tables.

Each takes (spark, folder of Parquet tables). Money is shown as double and days
as text, so that results compare across engines whatever their decimal and date
types look like outside.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators import centres, clean, comparison, daily, density, describe, features, hierarchy
from ..operators import kmeans, manycentres
from ..operators import ranking, rfm, scoring, segments, silhouette
from ..schema import (
    CLUSTER,
    COUNT,
    CUSTOMER,
    DATE,
    LEVEL,
    METRICS,
    MODEL,
    MONEY,
    NUM_CLUSTERS,
    PERCENT,
    QUANTITY,
    SECONDS,
    SILHOUETTE,
    VALUE,
)
from ..session import scratch_path, stage
from ..sources import comparison as comparison_source
from ..sources import results as results_source
from ..sources import transactions as transactions_source
from ..streaming import corrections, purchases
from ..streaming import quartiles as live_quartiles
from . import bindings, segmentation

Query = Callable[[SparkSession, str], DataFrame]

KS = tuple(range(2, 8))
# The day new customers are scored at, and the days accepted, in the queries:
# the given orders and events lie outside the default window.
AS_OF = "2000-06-30"
ORDER_DAYS = ("1996-01-01", "2000-06-30")
EVENT_DAYS = ("2024-01-03", "2024-01-27")
EVENT_AS_OF = "2024-01-31"
# Centres on the standardised metrics for the queries that assign to given centres.
CELL_STEP = 0.5
# A grid of 16 cells a metric, the outer ones open, whose cells' means are many centres.
GRID_STEP, GRID_REACH = 0.25, 8
CENTRES = ((0, -0.5, 1.0, 1.0), (1, 0.0, 0.0, 0.0), (2, 1.5, -1.0, -1.0), (3, -0.5, -0.5, -0.5))


def _shown(df: DataFrame) -> DataFrame:
    """Decimals as double and dates as text."""
    as_type = {"decimal": "double", "date": "string"}
    return df.select(
        *(
            F.col(f"`{name}`").cast(as_type[kind.split("(")[0]]).alias(name)
            if kind.split("(")[0] in as_type
            else F.col(f"`{name}`")
            for name, kind in df.dtypes
        )
    )


def _rounded(df: DataFrame, columns, digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in columns})


def _rfm(spark: SparkSession, folder: str) -> DataFrame:
    return segmentation.staged_rfm(bindings.transactions(spark, folder))


def _scored(spark: SparkSession, folder: str) -> DataFrame:
    return segments.scores(ranking.quartiles(_rfm(spark, folder)))


def _standardized(spark: SparkSession, folder: str) -> DataFrame:
    return features.standardize(_rfm(spark, folder))


def _nearest(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.assign_nearest(_standardized(spark, folder), CENTRES, features.SCALED)


def _given_model(customers: DataFrame) -> centres.CentreModel:
    """The given centres with the customers' scaling."""
    unscaled = centres.CentreModel(
        centres.STANDARD, (0.0,) * 3, (1.0,) * 3, tuple(c[1:] for c in CENTRES)
    )
    return centres.rescaled(unscaled, customers)


def _in_range(assigned: DataFrame, k: int) -> DataFrame:
    """Assignments with a flag in place of the cluster's number, which a fit chooses."""
    in_range = F.col(CLUSTER).between(0, k - 1).alias("in_range")
    return _shown(assigned.select(CUSTOMER, *METRICS, in_range))


def _sizes(profile: DataFrame, by) -> DataFrame:
    """Segments and customers of profiles whose segments' numbers a fit chooses."""
    return profile.groupBy(*by).agg(
        F.count(F.lit(1)).cast("long").alias("n_segments"), F.sum(COUNT).alias("n_customers")
    )


def _one_cluster_error(scaled: DataFrame) -> float:
    return features.squared_error_of_one_cluster(scaled).first()["sse"]


# --- sources and sinks


def load_transactions(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    bindings.transaction_lines(spark, folder, mixed=False).write.text(path)
    return _shown(transactions_source.load_transactions(spark, path))


def _mixed_lines(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "lines")
    bindings.transaction_lines(spark, folder).write.text(path)
    return spark.read.text(path)


def parse_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(transactions_source.parse_transactions(_mixed_lines(spark, folder))[0])


def parse_transactions_four_fields(spark: SparkSession, folder: str) -> DataFrame:
    lines = _mixed_lines(spark, folder)
    return _shown(transactions_source.parse_transactions(lines, layouts=(4,))[0])


def parse_surplus_decimals(spark: SparkSession, folder: str) -> DataFrame:
    """Lines with unpadded ids, some with a third decimal, parsed in one pass."""
    path, lines = scratch_path(spark, "parsed"), bindings.unpadded_lines(spark, folder)
    transactions_source.write_parsed(lines, path, id_width=10)
    good, rejects = transactions_source.read_parsed(spark, path)
    good = good.withColumn(QUANTITY, F.col(QUANTITY).cast("double"))
    return _shown(good).unionByName(rejects, allowMissingColumns=True)


def parse_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return transactions_source.parse_transactions(_mixed_lines(spark, folder))[1]


def load_row_count(spark: SparkSession, folder: str) -> DataFrame:
    lines = _mixed_lines(spark, folder)
    return transactions_source.row_count(transactions_source.parse_transactions(lines)[0])


def tsv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "tsv")
    rows = bindings.transactions(spark, folder)
    rows = rows.withColumn(CUSTOMER, F.col(CUSTOMER).cast("string"))
    transactions_source.write_tsv(rows, path)
    return _shown(transactions_source.read_tsv(spark, path))


def results_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "results")
    results_source.save_results(segments.rfm_profiles(_scored(spark, folder), KS), path)
    return results_source.read_results(spark, path, LEVEL)


def assignments_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "assignments")
    rows = _shown(
        _nearest(spark, folder)
        .select(CUSTOMER, *METRICS, F.col("cluster").alias(CLUSTER))
        .withColumn(NUM_CLUSTERS, F.lit(len(CENTRES)))
    )
    results_source.save_results(rows, path)
    return results_source.read_results(spark, path, rows.schema)


def _comparison_rows(scored: DataFrame, ks, share) -> DataFrame:
    """Rows for the comparison made from the data: the number of customers
    stands in for the time and a segment's share for the silhouette."""
    rows = None
    for k in ks:
        profile = segments.rfm_profile(scored, k)
        row = profile.agg(
            F.lit(k).alias(NUM_CLUSTERS),
            F.lit("RFM Analysis").alias(MODEL),
            (F.sum(COUNT) / F.lit(1000.0)).alias(SECONDS),
            (share(PERCENT) / 100).alias(SILHOUETTE),
        )
        rows = row if rows is None else rows.unionByName(row)
    return rows


def upsert_comparison(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "comparison")
    scored = _scored(spark, folder)
    comparison_source.upsert_comparison(spark, path, _comparison_rows(scored, (2, 3), F.max))
    return comparison_source.upsert_comparison(
        spark, path, _comparison_rows(scored, (3, 4), F.min)
    )


def model_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    customers = _rfm(spark, folder)
    model = kmeans.fit_kmeans(customers, 4)
    path = scratch_path(spark, "model")
    results_source.save_model(model, path)
    loaded = results_source.load_model(path).transform(customers)
    both = kmeans.assign(model, customers).join(
        loaded.select(CUSTOMER, F.col(CLUSTER).alias("loaded")), CUSTOMER
    )
    return both.agg(
        F.count("*").alias("n_customers"),
        F.count_if(F.col(CLUSTER) != F.col("loaded")).alias("n_different"),
    )


# --- cleaning and exploring


def clean_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(clean.clean_transactions(bindings.dirty_transactions(spark, folder)))


def validate_transactions(spark: SparkSession, folder: str) -> DataFrame:
    rows = bindings.dirty_transactions(spark, folder).withColumn(
        QUANTITY, F.coalesce(QUANTITY, F.lit(0))
    )
    checked = clean.validate_transactions(rows, *ORDER_DAYS)
    return _shown(checked.select(bindings.ORDER, DATE, QUANTITY, VALUE, clean.REASON))


def sample_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = bindings.orders_as_transactions(spark, folder)
    return _shown(describe.sample_rows(rows, [bindings.ORDER]))


def head_rows(spark: SparkSession, folder: str) -> DataFrame:
    rows = bindings.orders_as_transactions(spark, folder)
    return _shown(describe.head_rows(rows, [bindings.ORDER]))


def describe_transactions(spark: SparkSession, folder: str) -> DataFrame:
    summary = describe.describe(bindings.transactions(spark, folder))
    return _rounded(summary, ["mean", "std", "p25", "p50", "p75"], 4)


def daily_profile(spark: SparkSession, folder: str) -> DataFrame:
    """The profile merged from days kept in three batches, with a snapshot after the second.

    Percentiles and numbers of ids are estimates: the query says whether the exact rank of each
    percentile in the whole table lies within twice the stated error (which has 99 % confidence),
    and the number of ids within its own.
    """
    orders = stage(bindings.dirty_transactions(spark, folder), "orders")
    out = scratch_path(spark, "days")
    key = F.col(bindings.ORDER)
    for number in range(3):
        daily.add_days(orders.where(key % 3 == number), out, number)
        if number == 1:
            daily.compact_days(spark, out)
    merged = stage(daily.profile(spark, out), "profile")
    checks = []
    for row in merged.collect():  # one row per column
        value, n = F.col(row["column"]).cast("double"), row["count"]
        off = F.lit(0.0)
        for percent in describe.SUMMARY_PERCENTS:
            answer, asked = row[f"p{percent}"], percent / 100
            below, upto = F.count_if(value < answer) / n, F.count_if(value <= answer) / n
            off = F.greatest(off, below - asked, asked - upto)
        within = off <= 2 * daily.rank_error()
        checks.append(
            orders.agg(within.alias("ranks_within")).select(
                F.lit(row["column"]).alias("column"), "ranks_within"
            )
        )
    found = daily.customer_stats(spark, out).first()
    exact = describe.id_stats(orders).first()
    off = abs(found["unique_ids"] - exact["unique_ids"])
    ids_within = off <= daily.distinct_error() * exact["unique_ids"]
    shown = merged.select(
        "column",
        "count",
        F.round("mean", 4).alias("mean"),
        F.round("std", 4).alias("std"),
        "min",
        "max",
        "Missing_Values",
        F.lit(found["missing_ids"]).cast("long").alias("missing_ids"),
        F.lit(ids_within).alias("ids_within"),
    )
    return shown.join(F.broadcast(checks[0].unionByName(checks[1])), "column")


def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return describe.null_counts(bindings.dirty_transactions(spark, folder))


def date_range(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(describe.date_range(bindings.transactions(spark, folder)))


def id_stats(spark: SparkSession, folder: str) -> DataFrame:
    return describe.id_stats(bindings.dirty_transactions(spark, folder))


# --- RFM


def rfm_table(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(rfm.rfm_table(bindings.transactions(spark, folder)))


def rfm_table_dirty(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(rfm.rfm_table(bindings.dirty_transactions(spark, folder)))


def rfm_table_asof(spark: SparkSession, folder: str) -> DataFrame:
    rows = bindings.transactions(spark, folder)
    return _shown(rfm.rfm_table(rows, as_of=AS_OF, clean=False))


def rfm_ranks(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.first_ranks(_rfm(spark, folder))


def rfm_quartiles(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.quartiles(_rfm(spark, folder)).select(CUSTOMER, "R", "F", "M")


def rfm_quartiles_scaled(spark: SparkSession, folder: str) -> DataFrame:
    return ranking.quartiles_from_ranks(stage(ranking.first_ranks(_rfm(spark, folder)), "ranked"))


def rfm_scores(spark: SparkSession, folder: str) -> DataFrame:
    return _shown(_scored(spark, folder))


def segment_code_count(spark: SparkSession, folder: str) -> DataFrame:
    return segments.segment_code_count(_scored(spark, folder))


def _level(k: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return segments.levels(_scored(spark, folder), k).select(CUSTOMER, LEVEL)

    return query


def _profile(k: int) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        return segments.rfm_profile(_scored(spark, folder), k)

    return query


def segment_labels(spark: SparkSession, folder: str) -> DataFrame:
    return segments.segment_labels(segments.rfm_profile(_scored(spark, folder), 4), LEVEL)


def rfm_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return _rounded(density.histogram(_rfm(spark, folder)), ["bin_start", "bin_end"], 4)


def rfm_kde(spark: SparkSession, folder: str) -> DataFrame:
    curve = density.density_curve(_rfm(spark, folder))
    return _rounded(curve.select("metric", "point", "x", "curve"), ["x", "curve"], 4)


# --- scaling and clustering


def rfm_standardized(spark: SparkSession, folder: str) -> DataFrame:
    scaled = _standardized(spark, folder).select(CUSTOMER, *features.SCALED)
    return _rounded(scaled, features.SCALED)


def rfm_minmax(spark: SparkSession, folder: str) -> DataFrame:
    scaled = features.minmax(_rfm(spark, folder)).select(CUSTOMER, *features.SCALED)
    return _rounded(scaled, features.SCALED)


def assign_nearest(spark: SparkSession, folder: str) -> DataFrame:
    nearest = _nearest(spark, folder).select(CUSTOMER, "cluster", "distance")
    return _rounded(nearest, ["distance"])


def assign_many_centres(spark: SparkSession, folder: str) -> DataFrame:
    """The nearest of the means of a grid's cells; of the 4,096 cells, those with customers."""
    customers = stage(_standardized(spark, folder), "standardized")
    cell = F.lit(0)
    for c in features.SCALED:
        step = F.floor(F.col(c) / GRID_STEP)
        step = F.greatest(F.least(step, F.lit(GRID_REACH - 1)), F.lit(-GRID_REACH))
        cell = cell * (2 * GRID_REACH) + step + GRID_REACH
    means = customers.groupBy(cell.alias("cell")).agg(
        *(F.round(F.avg(c), 9).alias(c) for c in features.SCALED)
    )
    nearest = manycentres.nearest_of_many(customers, [F.col(c) for c in features.SCALED], means)
    return _rounded(nearest.select(CUSTOMER, "cluster", "distance"), ["distance"])


def attach_clusters(spark: SparkSession, folder: str) -> DataFrame:
    stored = _nearest(spark, folder).select(CUSTOMER, F.col("cluster").alias(CLUSTER))
    customers = segmentation.staged_rfm(bindings.dirty_transactions(spark, folder))
    return _shown(kmeans.attach_clusters(customers, stored))


def cluster_profile(spark: SparkSession, folder: str) -> DataFrame:
    return kmeans.cluster_profile(_nearest(spark, folder), len(CENTRES), label="cluster")


def cluster_profile_2dp(spark: SparkSession, folder: str) -> DataFrame:
    assigned = _nearest(spark, folder).withColumnRenamed("cluster", CLUSTER)
    return kmeans.cluster_profile_descending(assigned, len(CENTRES))


def _centre_gap(assigned: DataFrame, fitted: centres.CentreModel) -> float:
    """The largest distance of a centre from the mean of its customers, in hundredths: 0 for
    a fit that has ended, and not for one that was stopped on its way."""
    means = assigned.groupBy(CLUSTER).agg(*(F.avg(v) for v in fitted.scaled())).collect()
    gaps = [math.dist(row[1:], fitted.centres[row[0]]) for row in means]
    return round(max(gaps), 2) + 0.0


def kmeans_segments(spark: SparkSession, folder: str) -> DataFrame:
    """Each customer beside what must hold of a fit: the cluster is one of four, and
    its centre is the nearest of the fitted ones."""
    customers = _rfm(spark, folder)
    model = kmeans.fit_kmeans(customers, 4)
    fitted = centres.centre_model(model)
    numbered = [(i, *centre) for i, centre in enumerate(fitted.centres)]
    assigned = stage(kmeans.assign(model, customers), "assigned")
    placed = centres.nearest(assigned, fitted.scaled(), numbered)
    own = F.sqrt(
        sum(
            F.pow(value - F.element_at(F.array(*[F.lit(c[i]) for c in fitted.centres]),
                                       F.col(CLUSTER) + 1), 2)
            for i, value in enumerate(fitted.scaled())
        )
    )
    return _shown(
        placed.select(
            CUSTOMER,
            *METRICS,
            F.col(CLUSTER).between(0, 3).alias("in_range"),
            (own <= F.col("distance") + 1e-9).alias("at_nearest"),
            F.lit(_centre_gap(assigned, fitted)).alias("centre_gap"),
            F.lit(kmeans.converged(model)).alias("converged"),
        )
    )


def kmeans_profile(spark: SparkSession, folder: str) -> DataFrame:
    result = segmentation.kmeans_segmentation(_rfm(spark, folder), 4)
    bounded = F.lit(-1 <= result.silhouette <= 1).alias("silhouette_in_bounds")
    return _sizes(result.profile, [NUM_CLUSTERS]).select("*", bounded)


def kmeans_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """K-Means for every supported k: sizes, and whether more clusters than one pay."""
    customers = _rfm(spark, folder)
    one = _one_cluster_error(stage(features.standardize(customers), "scaled"))
    out = None
    for k in KS:
        model = kmeans.fit_kmeans(customers, k)
        assigned = kmeans.assign(model, customers)
        cost = model.stages[-1].summary.trainingCost
        row = _sizes(kmeans.cluster_profile(assigned, k), [NUM_CLUSTERS]).withColumns(
            {
                "below_one_cluster": F.lit(cost < one),
                "centre_gap": F.lit(_centre_gap(assigned, centres.centre_model(model))),
            }
        )
        out = row if out is None else out.unionByName(row)
    return out


def score_customers(spark: SparkSession, folder: str) -> DataFrame:
    """A scored batch saved customer by customer, and read back."""
    path = scratch_path(spark, "scored")
    batch, _ = transactions_source.parse_transactions(_mixed_lines(spark, folder))
    scored = _shown(scoring.score(batch, _given_model(_rfm(spark, folder)), AS_OF))
    rows = scored.withColumn(NUM_CLUSTERS, F.lit(len(CENTRES)))
    results_source.save_results(rows, path)
    return results_source.read_results(spark, path, rows.schema)


def select_model(spark: SparkSession, folder: str) -> DataFrame:
    """All three models built, saved and read back for selection."""
    root = scratch_path(spark, "project")
    segmentation.build_project(spark, bindings.transactions(spark, folder), 4, root)
    compared, combined = segmentation.select_model(spark, 4, root)
    return _sizes(combined, [MODEL]).withColumn("n_compared", F.lit(compared.count()).cast("long"))


def kmeans_minmax_profile(spark: SparkSession, folder: str) -> DataFrame:
    customers = _rfm(spark, folder)
    model = kmeans.fit_kmeans(customers, 4, scaler="minmax")
    profile = kmeans.cluster_profile_descending(kmeans.assign(model, customers), 4)
    silhouette_value = kmeans.silhouette_squared(model.transform(customers))
    bounded = F.lit(-1 <= silhouette_value <= 1).alias("silhouette_in_bounds")
    gap = _centre_gap(kmeans.assign(model, customers), centres.centre_model(model))
    return _sizes(profile, [NUM_CLUSTERS]).select("*", bounded, F.lit(gap).alias("centre_gap"))


def _squared_from(values, centre) -> F.Column:
    squares = (F.pow(value - float(c), 2) for value, c in zip(values, centre, strict=True))
    return sum(squares, F.lit(0.0))


def _elbow_shown(customers: DataFrame, scaled: DataFrame, scaler: str) -> DataFrame:
    """Each k beside what must hold of fits that have ended: the customers' error about the
    nearest centre is the fit's, with that of the centres about the mean it is the error
    of one cluster, and more clusters never cost more. The errors add up over the rows that each centre
    is the mean of; a row on a border may be nearer to another centre once the last round has moved them."""
    fits = kmeans.elbow_fits(customers, scaler=scaler)
    values = [F.col(c) for c in features.SCALED]
    mean = list(scaled.agg(*(F.avg(v) for v in values)).first())
    sums = [
        F.sum(F.array_min(F.array(*(_squared_from(values, c) for c in fit.centres)))) for fit in fits
    ]
    rows, last = [], None
    for fit, within in zip(fits, scaled.agg(*sums).first(), strict=True):
        between = float((fit.counts * ((fit.centres - mean) ** 2).sum(axis=1)).sum())
        same = abs(within - fit.sse) <= 1e-6 * (within + between)
        falls = last is None or fit.sse <= last * (1 + 1e-9)
        rows.append((fit.k, round(fit.sse + between, 4), same, falls, fit.converged))
        last = fit.sse
    return customers.sparkSession.createDataFrame(
        rows, "k int, sse_of_one double, sse_checked boolean, falls boolean, converged boolean"
    )


def elbow_curve(spark: SparkSession, folder: str) -> DataFrame:
    customers = _rfm(spark, folder)
    return _elbow_shown(customers, stage(features.standardize(customers), "scaled"), "standard")


def elbow_curve_minmax(spark: SparkSession, folder: str) -> DataFrame:
    customers = _rfm(spark, folder)
    return _elbow_shown(customers, stage(features.minmax(customers), "scaled"), "minmax")


def sse_k1(spark: SparkSession, folder: str) -> DataFrame:
    scaled = stage(_standardized(spark, folder), "scaled")
    return _rounded(features.squared_error_of_one_cluster(scaled), ["sse"], 4)


def _levelled(spark: SparkSession, folder: str) -> DataFrame:
    scored = segments.levels(_scored(spark, folder), 4)
    return features.standardize(scored.select(CUSTOMER, *METRICS, LEVEL))


def silhouette_euclidean(spark: SparkSession, folder: str) -> DataFrame:
    result = silhouette.silhouette_euclidean(
        _levelled(spark, folder), LEVEL, method="pairwise"
    )
    return _rounded(result.select("silhouette", "n_rows", "n_clusters"), ["silhouette"])


def silhouette_tolerance(spark: SparkSession, folder: str) -> DataFrame:
    """The exact value, and that bounds to a tolerance enclose it."""
    rows = stage(_levelled(spark, folder), "levelled")
    exact = silhouette.silhouette_euclidean(rows, LEVEL, method="pairwise")
    low, high = silhouette.silhouette_euclidean(rows, LEVEL, tolerance=0.002).first()[1:3]
    return exact.select(
        F.round("silhouette", 6).alias("silhouette"),
        "n_rows",
        F.col("silhouette").between(low - 1e-9, high + 1e-9).alias("enclosed"),
        F.lit(high - low <= 0.002).alias("within_tolerance"),
    )


def silhouette_bounded(spark: SparkSession, folder: str) -> DataFrame:
    """Bounds from the cells of a grid of half deviations."""
    steps = [F.floor(F.col(c) / CELL_STEP).cast("string") for c in features.SCALED]
    rows = _levelled(spark, folder).withColumn("cell", F.concat_ws(",", *steps))
    result = silhouette.silhouette_euclidean(rows, LEVEL, cell="cell")
    return _rounded(result, ["silhouette", "silhouette_low", "silhouette_high"])


def silhouette_squared(spark: SparkSession, folder: str) -> DataFrame:
    assembler = VectorAssembler(
        inputCols=list(features.SCALED), outputCol=kmeans.SCALED_VECTOR
    )
    assigned = assembler.transform(stage(_nearest(spark, folder), "nearest"))
    value = kmeans.silhouette_squared(assigned, "cluster")
    return assigned.agg(
        F.round(F.lit(value), 6).alias("silhouette"), F.count("*").alias("n_rows")
    )


def ward_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _in_range(hierarchy.ward_segments(_rfm(spark, folder), 4), 4)


def ward_merges(spark: SparkSession, folder: str) -> DataFrame:
    """What must hold of a merge tree: half its squared heights and the error inside
    the leaves make the error of one cluster, the share inside is no larger than wanted, heights
    rise, each node merges once."""
    found = hierarchy.ward(_rfm(spark, folder))
    heights = [merge[2] for merge in found.merges]
    nodes = [node for merge in found.merges for node in merge[:2]]
    within = found.squared_error_inside <= hierarchy.ERROR_SHARE * found.squared_error
    return found.tree.agg(
        F.max("size").alias("n_customers"),
        F.round(F.sum(F.pow("height", F.lit(2))) / 2 + found.squared_error_inside, 4).alias("sse"),
        F.lit(within).alias("share_inside_kept"),
        F.lit(heights == sorted(heights)).alias("heights_rise"),
        F.lit(len(nodes) == len(set(nodes))).alias("nodes_merge_once"),
    )


def _between(labelled: DataFrame) -> float:
    """Squared error of the clusters' means about the mean of all, on the standardised metrics."""
    values = [F.col(c) for c in features.SCALED]
    means = [F.avg(v).alias(c) for v, c in zip(values, features.SCALED, strict=True)]
    clusters = labelled.groupBy(CLUSTER).agg(F.count(F.lit(1)).alias("n"), *means)
    squares = sum((v * v for v in values), F.lit(0.0))  # the mean of all is 0
    return clusters.agg(F.sum(F.col("n") * squares)).first()[0]


def ward_profile(spark: SparkSession, folder: str) -> DataFrame:
    result = segmentation.ward_segmentation(_rfm(spark, folder), 4)
    bounded = F.lit(-1 <= result.silhouette <= 1).alias("silhouette_in_bounds")
    return _sizes(result.profile, [NUM_CLUSTERS]).select("*", bounded)


def ward_profiles(spark: SparkSession, folder: str) -> DataFrame:
    """One tree cut for every supported k: what the tree says of the clusters' error and the
    error of their means about the mean of all make that of one cluster."""
    found = hierarchy.ward(_rfm(spark, folder))
    out = None
    for k in KS:
        labelled = stage(found.segments(k), "labelled")
        sse = found.squared_error_of(k) + _between(labelled)
        profile = _sizes(kmeans.cluster_profile(labelled, k), [NUM_CLUSTERS])
        profile = profile.withColumn("sse_of_one", F.round(F.lit(sse), 4))
        out = profile if out is None else out.unionByName(profile)
    return out


def bisecting_segments(spark: SparkSession, folder: str) -> DataFrame:
    return _in_range(kmeans.bisecting_segments(_rfm(spark, folder), 4), 4)


# --- comparing


def _profiles(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    scored = _scored(spark, folder)
    four = segments.rfm_profile(scored, 4).unionByName(segments.rfm_profile(scored, 3))
    return {"RFM": four, "Nearest": cluster_profile(spark, folder)}


def combined_results(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.combined_results(_profiles(spark, folder), 4)


def comparison_for_k(spark: SparkSession, folder: str) -> DataFrame:
    return comparison.comparison_for_k(upsert_comparison(spark, folder), 3)


# --- scoring


def score_single(spark: SparkSession, folder: str) -> DataFrame:
    model = _given_model(_rfm(spark, folder))
    entered = bindings.transactions(spark, folder).drop(CUSTOMER)
    return _shown(scoring.score_single(entered, model, AS_OF, *ORDER_DAYS))


def score_batch(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "centres")
    centres.save_centres(spark, _given_model(_rfm(spark, folder)), path)
    model = centres.load_centres(spark, path)
    batch, _ = transactions_source.parse_transactions(_mixed_lines(spark, folder))
    return kmeans.cluster_profile(scoring.score(batch, model, AS_OF), 4)


def score_batch_rescaled(spark: SparkSession, folder: str) -> DataFrame:
    model = _given_model(_rfm(spark, folder))
    batch, _ = transactions_source.parse_transactions(_mixed_lines(spark, folder))
    return kmeans.cluster_profile(scoring.score(batch, model, AS_OF, rescale="batch"), 4)


# --- streaming


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    rows = bindings.event_transactions(spark, folder).repartition(4)
    path = scratch_path(spark, "events")
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 2).parquet(path)


def stream_rfm(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "totals"), scratch_path(spark, "totals-checkpoint")
    stream = _event_stream(spark, folder)
    purchases.start_totals(stream, out, checkpoint, *EVENT_DAYS).awaitTermination()
    purchases.compact_totals(spark, out)
    totals = purchases.current_totals(spark, out)
    return _shown(purchases.totals_as_of(totals, EVENT_AS_OF))


def _withdrawn() -> Column:
    """Orders taken back: a seventh of all, and half of the last months'."""
    late = F.col(DATE) >= F.lit("2000-03-01").cast("date")
    return (F.col(bindings.ORDER) % 7 == 3) | (late & (F.col(bindings.ORDER) % 2 == 1))


def rfm_corrected(spark: SparkSession, folder: str) -> DataFrame:
    """Orders of which some are withdrawn, and some moved to another day and customer, over
    two runs of a stream; for a third of the orders the withdrawals come first."""
    orders = stage(bindings.dirty_transactions(spark, folder), "orders")
    key = F.col(bindings.ORDER)
    moves = (key % 5 == 1) & ~_withdrawn()
    moved = orders.where(moves).withColumns(
        {
            CUSTOMER: F.col(CUSTOMER) + key % 2,
            DATE: F.date_sub(DATE, 40),
            VALUE: (F.col(VALUE) + F.lit(1).cast(MONEY)).cast(MONEY),
        }
    )
    later = key % 3 == 0
    taken = corrections.withdrawn(orders.where(_withdrawn()))
    runs = (
        corrections.added(orders.where(~later)).unionByName(taken),
        corrections.added(orders.where(later)).unionByName(
            corrections.changed(orders.where(moves), moved)
        ),
    )
    source, out, checkpoint = (scratch_path(spark, f"changes-{n}") for n in ("in", "out", "state"))
    for run, changes in enumerate(runs):
        # Two micro-batches, whatever the number of files; each file is a task.
        files = 2 * max(spark.sparkContext.defaultParallelism, changes.rdd.getNumPartitions())
        changes.repartition(files).write.mode("append").parquet(source)
        stream = spark.readStream.schema(changes.schema).option("maxFilesPerTrigger", files // 2)
        stream = stream.parquet(source)
        corrections.start_corrections(stream, out, checkpoint).awaitTermination()
        if run == 0:
            corrections.compact_corrections(spark, out)
    return _shown(corrections.corrected_rfm(spark, out))


def stream_levels(spark: SparkSession, folder: str) -> DataFrame:
    """Scores and levels kept through two runs of the stream, with a snapshot between them."""
    rows = bindings.event_transactions(spark, folder).repartition(4, DATE)
    source, out, checkpoint = (scratch_path(spark, f"levels-{n}") for n in ("in", "out", "state"))
    late = F.pmod(F.xxhash64(DATE, VALUE), F.lit(2)) == 1
    for run, part in enumerate((rows.where(~late), rows.where(late))):
        part.write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        live_quartiles.start_levels(
            stream, 4, out, checkpoint, EVENT_AS_OF, *EVENT_DAYS
        ).awaitTermination()
        if run == 0:
            live_quartiles.compact_levels(spark, out)
    live = live_quartiles.live_levels(spark, out, 4, EVENT_AS_OF)
    return _shown(live.select(CUSTOMER, *METRICS, "R", "F", "M", LEVEL))


def stream_scoring(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "scores"), scratch_path(spark, "scores-checkpoint")
    model = _given_model(stage(rfm.rfm_table(bindings.event_transactions(spark, folder))))
    purchases.start_scoring(
        _event_stream(spark, folder), model, out, checkpoint, EVENT_AS_OF, *EVENT_DAYS
    ).awaitTermination()
    return _shown(purchases.current_scores(spark, out))


def stream_rejects(spark: SparkSession, folder: str) -> DataFrame:
    out, checkpoint = scratch_path(spark, "rejects"), scratch_path(spark, "rejects-checkpoint")
    stream = _event_stream(spark, folder)
    purchases.start_rejects(stream, out, checkpoint, *EVENT_DAYS).awaitTermination()
    return _shown(spark.read.parquet(out))


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        load_transactions,
        parse_transactions,
        parse_transactions_four_fields,
        parse_rejects,
        load_row_count,
        tsv_roundtrip,
        results_roundtrip,
        assignments_roundtrip,
        upsert_comparison,
        model_roundtrip,
        clean_transactions,
        validate_transactions,
        sample_rows,
        head_rows,
        describe_transactions,
        daily_profile,
        null_counts,
        date_range,
        id_stats,
        rfm_table,
        rfm_table_dirty,
        rfm_table_asof,
        rfm_corrected,
        rfm_ranks,
        rfm_quartiles,
        rfm_quartiles_scaled,
        rfm_scores,
        segment_code_count,
        segment_labels,
        rfm_histogram,
        rfm_kde,
        rfm_standardized,
        rfm_minmax,
        assign_nearest,
        assign_many_centres,
        attach_clusters,
        cluster_profile,
        cluster_profile_2dp,
        kmeans_segments,
        kmeans_profile,
        kmeans_profiles,
        kmeans_minmax_profile,
        elbow_curve,
        elbow_curve_minmax,
        sse_k1,
        silhouette_euclidean,
        silhouette_bounded,
        silhouette_tolerance,
        silhouette_squared,
        ward_segments,
        ward_merges,
        ward_profile,
        ward_profiles,
        bisecting_segments,
        combined_results,
        comparison_for_k,
        score_single,
        score_batch,
        score_batch_rescaled,
        score_customers,
        select_model,
        parse_surplus_decimals,
        stream_rfm,
        stream_levels,
        stream_scoring,
        stream_rejects,
    )
}
QUERIES["rfm_profile"] = _profile(4)
for _k in KS:
    QUERIES[f"rfm_level_k{_k}"] = _level(_k)
    QUERIES[f"rfm_profile_k{_k}"] = _profile(_k)
