"""Scaling the three metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import METRICS

SCALED = tuple(f"{m}_scaled" for m in METRICS)


def standardize(rfm: DataFrame) -> DataFrame:
    """Mean 0 and population standard deviation 1; 0 where a metric is constant.

    The moments are one aggregate row read as a scalar subquery: the scaling
    itself is a projection. Stage ``rfm`` first, it is scanned twice.
    """
    moments = rfm.agg(
        F.struct(
            *(
                entry
                for m in METRICS
                for entry in (
                    F.avg(F.col(m).cast("double")).alias(f"{m}_mean"),
                    F.stddev_pop(F.col(m).cast("double")).alias(f"{m}_std"),
                )
            )
        ).alias("moments")
    ).scalar()
    with_moments = rfm.select("*", moments.alias("moments"))
    return with_moments.select(
        *rfm.columns,
        *(
            F.when(
                F.col(f"moments.{m}_std") > 0,
                (F.col(m).cast("double") - F.col(f"moments.{m}_mean")) / F.col(f"moments.{m}_std"),
            )
            .otherwise(0.0)
            .alias(s)
            for m, s in zip(METRICS, SCALED)
        ),
    )


def minmax(rfm: DataFrame) -> DataFrame:
    """Scaled linearly to 0..1; 0.5 where a metric is constant."""
    bounds = rfm.agg(
        F.struct(
            *(
                entry
                for m in METRICS
                for entry in (
                    F.min(F.col(m).cast("double")).alias(f"{m}_min"),
                    F.max(F.col(m).cast("double")).alias(f"{m}_max"),
                )
            )
        ).alias("bounds")
    ).scalar()
    with_bounds = rfm.select("*", bounds.alias("bounds"))
    return with_bounds.select(
        *rfm.columns,
        *(
            F.when(
                F.col(f"bounds.{m}_max") > F.col(f"bounds.{m}_min"),
                (F.col(m).cast("double") - F.col(f"bounds.{m}_min"))
                / (F.col(f"bounds.{m}_max") - F.col(f"bounds.{m}_min")),
            )
            .otherwise(0.5)
            .alias(s)
            for m, s in zip(METRICS, SCALED)
        ),
    )


def squared_error_of_one_cluster(scaled: DataFrame) -> DataFrame:
    """Sum of squared distances to the overall mean: the elbow curve at k = 1."""
    means = scaled.agg(F.struct(*(F.avg(s).alias(s) for s in SCALED)).alias("means")).scalar()
    away = scaled.select(*SCALED, means.alias("means"))
    squares = sum((F.pow(F.col(s) - F.col(f"means.{s}"), 2) for s in SCALED), F.lit(0.0))
    return away.agg(F.sum(squares).alias("sse"))
