"""Scored customers and segment profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import segment_label
from ..functions.rules import rfm_code, rfm_level, rfm_score
from ..schema import COUNT, LEVEL, METRICS, NUM_CLUSTERS, PERCENT, PROFILE_MEANS, check_k


def scores(quartiled: DataFrame) -> DataFrame:
    """Add the segment code and the total score to customers with R, F and M."""
    return quartiled.withColumns({"RFM_Segment": rfm_code(), "RFM_score": rfm_score()})


def levels(scored: DataFrame, k: int) -> DataFrame:
    """Add the rule-based level for ``k`` segments."""
    return scored.withColumn(LEVEL, rfm_level(k))


def segment_code_count(scored: DataFrame) -> DataFrame:
    """Number of distinct segment codes in use."""
    return scored.agg(F.count_distinct("RFM_Segment").alias("n_segment_codes"))


def segment_profile(
    df: DataFrame,
    by: str,
    k: int | None = None,
    digits: int = 0,
    order: Sequence = (),
) -> DataFrame:
    """Mean metrics, size and share of each segment.

    Means are rounded half to even to ``digits``, the share to two digits. One
    partial row per segment and task is shuffled; what follows works on at most
    as many rows as there are segments. Sums stay exact until the division.
    """
    means = [
        F.bround(F.sum(metric).cast("double") / F.count("*"), digits).alias(name)
        for metric, name in zip(METRICS, PROFILE_MEANS)
    ]
    profile = df.groupBy(by).agg(*means, F.count("*").alias(COUNT))
    share = F.col(COUNT) / F.sum(COUNT).over(Window.partitionBy())
    profile = profile.withColumn(PERCENT, F.bround(share * 100, 2))
    if k is not None:
        profile = profile.withColumn(NUM_CLUSTERS, F.lit(check_k(k)))
    return profile.orderBy(*order) if order else profile


def rfm_profile(scored: DataFrame, k: int) -> DataFrame:
    """Profile of the rule-based segments, largest share first."""
    order = (F.desc(PERCENT), F.col(LEVEL))
    return segment_profile(levels(scored, k), LEVEL, k, order=order)


def rfm_profiles(scored: DataFrame, ks: Sequence[int]) -> DataFrame:
    """Profiles of the rule-based segments for several ``ks`` from one pass over the customers."""
    each = [
        F.struct(F.lit(check_k(k)).alias(NUM_CLUSTERS), rfm_level(k).alias(LEVEL)) for k in ks
    ]
    rows = scored.select(*METRICS, F.explode(F.array(*each)).alias("one")).select(
        *METRICS, F.col(f"one.{LEVEL}"), F.col(f"one.`{NUM_CLUSTERS}`")
    )
    means = [
        F.bround(F.sum(metric).cast("double") / F.count("*"), 0).alias(name)
        for metric, name in zip(METRICS, PROFILE_MEANS)
    ]
    profiles = rows.groupBy(LEVEL, NUM_CLUSTERS).agg(*means, F.count("*").alias(COUNT))
    share = F.col(COUNT) / F.sum(COUNT).over(Window.partitionBy(NUM_CLUSTERS))
    return profiles.select(
        LEVEL, *PROFILE_MEANS, COUNT, F.bround(share * 100, 2).alias(PERCENT), NUM_CLUSTERS
    )


def segment_labels(profile: DataFrame, name: str) -> DataFrame:
    """Each segment's description."""
    return profile.select(name, segment_label(name).alias("label"))
