"""K-Means segmentation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.ml.clustering import BisectingKMeans, KMeans
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import cluster_name
from ..schema import CLUSTER, CUSTOMER, METRICS, check_k
from ..session import stage
from .centres import nearest
from .elbow import Fit, fit_all
from .features import SCALED, minmax, standardize
from .segments import segment_profile

RAW_VECTOR = "features"
SCALED_VECTOR = "scaled_features"
# Seed of the fits, rounds a fit may take unless told otherwise,
# and the largest k of an elbow curve.
SEED = 42
MAX_ITERATIONS = 300
ELBOW_MAX = 19


def _scaler(name: str):
    if name == "standard":
        # Divides by the n - 1 deviation: the common factor to the population
        # form does not change which centre is nearest.
        return StandardScaler(
            inputCol=RAW_VECTOR, outputCol=SCALED_VECTOR, withMean=True, withStd=True
        )
    if name == "minmax":
        return MinMaxScaler(inputCol=RAW_VECTOR, outputCol=SCALED_VECTOR)
    raise ValueError(f"unknown scaler {name!r}")


def feature_stages(rfm: DataFrame, scaler: str = "standard") -> PipelineModel:
    """Fitted assembler and scaler."""
    assembler = VectorAssembler(inputCols=list(METRICS), outputCol=RAW_VECTOR)
    fitted = _scaler(scaler).fit(assembler.transform(rfm))
    return PipelineModel(stages=[assembler, fitted])


def _kmeans(k: int, seed: int, max_iterations: int) -> KMeans:
    return KMeans(
        k=k,
        seed=seed,
        maxIter=max_iterations,
        featuresCol=SCALED_VECTOR,
        predictionCol=CLUSTER,
    )


def fit_kmeans(
    rfm: DataFrame,
    k: int,
    scaler: str = "standard",
    seeds: Sequence[int] = (SEED,),
    max_iterations: int = MAX_ITERATIONS,
) -> PipelineModel:
    """Assembler, scaler and the K-Means fit of lowest cost among ``seeds``.

    ``converged`` tells whether it ended before ``max_iterations``.
    """
    check_k(k)
    prepare = feature_stages(rfm, scaler)
    vectors = prepare.transform(rfm).select(SCALED_VECTOR).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        fits = [_kmeans(k, seed, max_iterations).fit(vectors) for seed in seeds]
        best = min(fits, key=lambda fit: fit.summary.trainingCost)
    finally:
        vectors.unpersist()
    return PipelineModel(stages=[*prepare.stages, best])


def converged(model: PipelineModel) -> bool:
    """Whether a model fitted in this session ended before its limit of rounds."""
    fit = model.stages[-1]
    return fit.summary.numIter < fit.getMaxIter()


def assign(model: PipelineModel, rfm: DataFrame) -> DataFrame:
    """Customers with their metrics and cluster, a projection over ``rfm``."""
    return model.transform(rfm).select(CUSTOMER, *METRICS, CLUSTER)


def attach_clusters(rfm: DataFrame, assignments: DataFrame) -> DataFrame:
    """Join cluster labels kept elsewhere to the customers' metrics."""
    return rfm.join(assignments.select(CUSTOMER, CLUSTER), CUSTOMER, "inner")


def assign_nearest(
    df: DataFrame, centroids: Sequence[tuple], columns: Sequence[str]
) -> DataFrame:
    """Add the nearest centroid's ``cluster`` and the distance to it.

    ``centroids`` are (cluster, one number per column), kept on the driver as a model's
    centres are. Ties go to the smallest cluster.
    """
    return nearest(df, [F.col(c).cast("double") for c in columns], centroids)


def cluster_profile(
    assigned: DataFrame, k: int | None = None, label: str = CLUSTER, digits: int = 0
) -> DataFrame:
    """Profile of clusters named ``'Cluster 0'``, ``'Cluster 1'``, ..."""
    named = assigned.withColumn(CLUSTER, cluster_name(label))
    return segment_profile(named, CLUSTER, k, digits)


def cluster_profile_descending(assigned: DataFrame, k: int | None = None) -> DataFrame:
    """Profile with two-digit means, cluster names in descending order."""
    return cluster_profile(assigned, k, digits=2).orderBy(F.desc(CLUSTER))


def silhouette_squared(
    df: DataFrame, label: str = CLUSTER, vector: str = SCALED_VECTOR
) -> float:
    """Mean silhouette under squared Euclidean distance, linear in the number of
    rows. ``vector`` should be the scaled one the clusters were found on, as in
    the output of ``model.transform``."""
    evaluator = ClusteringEvaluator(
        featuresCol=vector, predictionCol=label, metricName="silhouette"
    )
    return evaluator.evaluate(df)


def elbow_fits(
    rfm: DataFrame,
    ks: Sequence[int] = tuple(range(1, ELBOW_MAX + 1)),
    scaler: str = "standard",
    seed: int = SEED,
    max_iterations: int = MAX_ITERATIONS,
) -> list[Fit]:
    """The fits behind ``elbow``, on metrics scaled by the population deviation, or to 0..1."""
    if scaler not in ("standard", "minmax"):
        raise ValueError(f"unknown scaler {scaler!r}")
    scaled = standardize(rfm) if scaler == "standard" else minmax(rfm)
    points = stage(scaled.select(*SCALED), "scaled")
    return fit_all(points, SCALED, list(ks), seed, max_iterations)


def elbow(
    rfm: DataFrame,
    ks: Sequence[int] = tuple(range(1, ELBOW_MAX + 1)),
    scaler: str = "standard",
    seed: int = SEED,
    max_iterations: int = MAX_ITERATIONS,
) -> DataFrame:
    """(k, sse, converged): sum of squared distances to the nearest centre for each k, and
    whether the fit ended before ``max_iterations``.

    Every round of all fits is one aggregation over the customers, see ``elbow.fit_all``. Costs on
    standardised metrics are stated for the population deviation.
    """
    fits = elbow_fits(rfm, ks, scaler, seed, max_iterations)
    return rfm.sparkSession.createDataFrame(
        [(fit.k, fit.sse, fit.converged) for fit in fits], "k int, sse double, converged boolean"
    )


def bisecting_segments(
    rfm: DataFrame, k: int, seed: int = SEED, max_iterations: int = 20
) -> DataFrame:
    """Top-down hierarchical clusters: each split is a distributed two-means of at most
    ``max_iterations`` rounds."""
    check_k(k)
    prepared = feature_stages(rfm).transform(rfm)
    model = BisectingKMeans(
        k=k,
        seed=seed,
        maxIter=max_iterations,
        featuresCol=SCALED_VECTOR,
        predictionCol=CLUSTER,
    ).fit(prepared)
    return model.transform(prepared).select(CUSTOMER, *METRICS, CLUSTER)
