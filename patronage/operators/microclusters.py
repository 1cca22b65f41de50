"""Summarising many points by a bounded number of weighted ones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_VECTOR = "_vector"

# How many cells summarise the points, and the rounds their fit may take: more of
# either makes the summary finer, never different in kind.
MICRO_CLUSTERS = 1_000
MICRO_ROUNDS = 10


def _distinct_up_to(points: DataFrame, columns: Sequence[str], most: int) -> int:
    """The number of distinct points, or ``most`` if there are more.

    Nearly always the first rows show it; only where they do not is all counted.
    """
    some = points.select(*columns).limit(20 * most).distinct().count()
    if some >= most:
        return most
    return min(most, points.select(*columns).distinct().count())


def fit_micro_clusters(
    points: DataFrame, columns: Sequence[str], micro: int, seed: int, rounds: int = MICRO_ROUNDS
) -> tuple[VectorAssembler, KMeansModel | None]:
    """K-Means with ``micro`` centres, or as many as there are distinct points; no model
    where that is one. The vectors are kept for the fit alone."""
    micro = _distinct_up_to(points, columns, micro)
    assembler = VectorAssembler(inputCols=list(columns), outputCol=_VECTOR)
    if micro < 2:
        return assembler, None
    vectors = assembler.transform(points).select(_VECTOR)
    vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = KMeans(
            k=micro, seed=seed, maxIter=rounds, featuresCol=_VECTOR, predictionCol="micro"
        ).fit(vectors)
    finally:
        vectors.unpersist()
    return assembler, model


def with_micro(
    df: DataFrame, fitted: tuple[VectorAssembler, KMeansModel | None]
) -> DataFrame:
    """Add each row's micro-cluster number, a projection."""
    assembler, model = fitted
    if model is None:
        return df.withColumn("micro", F.lit(0))
    return model.transform(assembler.transform(df)).drop(_VECTOR)


def summarise(points: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Rows (``weight``), centroid and mean squared distance to the centroid (``spread``)
    of each group; additive sums, so they combine on the map side."""
    means = {c: F.avg(F.col(c)) for c in columns}
    squares = F.avg(sum((F.col(c) * F.col(c) for c in columns), F.lit(0.0)))
    spread = squares - sum((m * m for m in means.values()), F.lit(0.0))
    return points.groupBy(*by).agg(
        F.count(F.lit(1)).alias("weight"),
        *(m.alias(c) for c, m in means.items()),
        F.greatest(spread, F.lit(0.0)).alias("spread"),
    )
