"""Comparing the results of different models."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CLUSTER, LEVEL, MODEL, NUM_CLUSTERS, check_k
from ..session import stage


def timed(build: Callable[[], DataFrame]) -> tuple[DataFrame, float]:
    """Result of ``build`` and the seconds spent making it.

    The result is staged inside the measured time: an unevaluated DataFrame
    would take no time at all.
    """
    started = time.perf_counter()
    result = stage(build(), "timed")
    return result, time.perf_counter() - started


def comparison_for_k(comparison: DataFrame, k: int) -> DataFrame:
    """Comparison rows for ``k`` clusters, without the constant column."""
    return comparison.where(F.col(NUM_CLUSTERS) == check_k(k)).drop(NUM_CLUSTERS)


def combined_results(profiles: Mapping[str, DataFrame], k: int) -> DataFrame:
    """Profiles of several models for ``k`` clusters under one another.

    ``profiles`` maps model names to profiles; the segment column is called
    ``Cluster`` throughout.
    """
    stacked = None
    for model, profile in profiles.items():
        if LEVEL in profile.columns:
            profile = profile.withColumnRenamed(LEVEL, CLUSTER)
        profile = profile.withColumn(MODEL, F.lit(model))
        stacked = profile if stacked is None else stacked.unionByName(
            profile, allowMissingColumns=True
        )
    return stacked.where(F.col(NUM_CLUSTERS) == check_k(k)).drop(NUM_CLUSTERS)
