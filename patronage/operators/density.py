"""Distribution of the three metrics: histograms and density curves."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import metric_values

# Resolution of the histogram and of the density curve.
BINS = 30
GRID_POINTS = 200

#: Error of one value's kernel, whose height is 1.
TOLERANCE = 1e-14


def histogram(rfm: DataFrame, bins: int = BINS) -> DataFrame:
    """Counts in ``bins`` equal-width bins from minimum to maximum, per metric.

    The last bin includes the maximum; empty bins are listed. When all values
    are equal the range is widened by a half on both sides. Bins are found in
    exact decimal arithmetic. Map-side combining leaves at most ``bins`` rows
    per metric and task to shuffle. ``rfm`` is scanned twice, so stage it.
    """
    values = metric_values(rfm).select("metric", "value")
    # One row per metric: small by construction.
    bounds = values.groupBy("metric").agg(F.min("value").alias("low"), F.max("value").alias("high"))
    inner = F.expr(f"least({bins - 1}, ((value - low) * {bins}) div (high - low))")
    position = F.when(F.col("high") > F.col("low"), inner).otherwise(bins // 2).cast("int")
    counts = (
        values.join(F.broadcast(bounds), "metric")
        .groupBy("metric", position.alias("bin"))
        .agg(F.count("*").alias("count"))
    )
    flat = F.col("high") == F.col("low")
    start = F.col("low").cast("double") - F.when(flat, 0.5).otherwise(0.0)
    width = F.when(flat, 1.0).otherwise((F.col("high") - F.col("low")).cast("double")) / bins
    edges = bounds.select(
        "metric",
        start.alias("start"),
        width.alias("width"),
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"),
    )
    # Both sides have ``bins`` rows per metric.
    return edges.join(F.broadcast(counts), ["metric", "bin"], "left").select(
        "metric",
        "bin",
        (F.col("start") + F.col("width") * F.col("bin")).alias("bin_start"),
        (F.col("start") + F.col("width") * (F.col("bin") + 1)).alias("bin_end"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )


def terms_for(tolerance: float) -> int:
    """Moments a box needs so that a value's kernel is off by ``tolerance`` at most.

    The kernel of a value in a box of one bandwidth is a series of Hermite functions about the box's
    middle. By Cramer's inequality what follows the first p terms is at most
    1.09 * sum of 2^-n / sqrt(n!) over n >= p.
    """
    if not tolerance > 0:
        raise ValueError("tolerance must be positive")
    tail = [1.09 * 0.5**n / math.sqrt(math.factorial(n)) for n in range(60)]
    return next((p for p in range(1, 60) if sum(tail[p:]) <= tolerance), 60)


def _powers(base: Column, count: int) -> list[Column]:
    """base^0 to base^(count - 1) as products, each of two lower powers."""
    powers = [F.lit(1.0), base]
    for n in range(2, count):
        powers.append(powers[n // 2] * powers[n - n // 2])
    return powers[:count]


def _hermite_sum(moments: Column, t: Column) -> Column:
    """Sum of moment n times the n-th Hermite function at ``t``, by their recurrence."""
    start = F.struct(
        F.lit(0.0).alias("total"),
        F.lit(0.0).alias("before"),
        F.exp(-t * t).alias("now"),
        F.lit(0).alias("n"),
    )

    def step(state: Column, moment: Column) -> Column:
        following = 2 * t * state["now"] - 2 * state["n"] * state["before"]
        return F.struct(
            (state["total"] + moment * state["now"]).alias("total"),
            state["now"].alias("before"),
            following.alias("now"),
            (state["n"] + 1).alias("n"),
        )

    return F.aggregate(moments, start, step, lambda state: state["total"])


def box_moments(values: DataFrame, stats: DataFrame, terms: int) -> DataFrame:
    """(metric, box, moments): ``terms`` sums of powers over the values of each box.

    Boxes are one bandwidth wide, from the minimum on; empty ones have no row. ``values`` has
    (metric, value as double), ``stats`` (metric, low, bandwidth) and is small. All sums combine on
    the map side: a task shuffles its boxes, however many values are in them.
    """
    offset = (F.col("value") - F.col("low")) / F.col("bandwidth")
    placed = values.join(F.broadcast(stats), "metric").select(
        "metric", F.floor(offset).alias("box"), offset.alias("offset")
    )
    # Kernels are exp(-t * t) in units of sqrt(2) bandwidths.
    about_middle = (F.col("offset") - F.col("box") - 0.5) / math.sqrt(2)
    sums = [
        (F.sum(power) / math.factorial(n)).alias(f"m{n}")
        for n, power in enumerate(_powers(about_middle, terms))
    ]
    grouped = placed.groupBy("metric", "box").agg(*sums)
    return grouped.select("metric", "box", F.array(*(f"m{n}" for n in range(terms))).alias("moments"))


def density_curve(
    rfm: DataFrame, grid: int = GRID_POINTS, bins: int = BINS, tolerance: float = TOLERANCE
) -> DataFrame:
    """Gaussian kernel density of each metric at ``grid`` points from minimum to
    maximum, and the same curve scaled to the height of the histogram.

    Bandwidth is the sample standard deviation times n^(-1/5). A fast Gauss transform: values are
    summed up as moments of boxes, see ``box_moments``, and each box adds its Hermite series to the
    grid points in its reach. A kernel's height is 1; every value's is off by less than
    ``tolerance`` for the terms left out and for points out of reach each, so a density is off by
    2 * tolerance / (bandwidth * sqrt(2 pi)) at most, besides rounding. A metric without spread has
    no curve. ``rfm`` is scanned twice, so stage it.
    """
    terms = terms_for(tolerance)
    # Beyond this distance from its box's middle a value's kernel is below the tolerance.
    reach = math.sqrt(-2 * math.log(min(tolerance, 0.5))) + 0.5
    values = metric_values(rfm).select("metric", F.col("value").cast("double").alias("value"))
    # One row per metric: small by construction.
    stats = (
        values.groupBy("metric")
        .agg(
            F.count("*").alias("n"),
            F.min("value").alias("low"),
            F.max("value").alias("high"),
            F.stddev_samp("value").alias("std"),
        )
        .where(F.col("std") > 0)
        .select(
            "metric",
            "n",
            "low",
            "high",
            (F.col("std") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).alias("bandwidth"),
        )
    )
    boxes = box_moments(values, stats, terms).join(F.broadcast(stats), "metric")
    step = (F.col("high") - F.col("low")) / (grid - 1) / F.col("bandwidth")  # in bandwidths
    middle = F.col("box") + 0.5
    first = F.greatest(F.lit(0), F.ceil((middle - reach) / step))
    last = F.least(F.lit(grid - 1), F.floor((middle + reach) / step))
    reached = F.when(first <= last, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))
    zeros = stats.select(
        "metric", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"), F.lit(0.0).alias("total")
    )
    at = boxes.select(
        "metric", "moments", middle.alias("middle"), step.alias("step"), F.explode(reached).alias("point")
    )
    t = (F.col("point") * F.col("step") - F.col("middle")) / math.sqrt(2)
    parts = at.select(
        "metric", F.col("point").cast("int").alias("point"), _hermite_sum(F.col("moments"), t).alias("total")
    )
    sums = parts.unionByName(zeros).groupBy("metric", "point").agg(F.sum("total").alias("total"))
    x = F.col("low") + (F.col("high") - F.col("low")) * F.col("point") / (grid - 1)
    kernel = F.col("total") / (F.col("bandwidth") * math.sqrt(2 * math.pi))
    return sums.join(F.broadcast(stats), "metric").select(
        "metric",
        "point",
        x.alias("x"),
        (kernel / F.col("n")).alias("density"),
        (kernel * (F.col("high") - F.col("low")) / bins).alias("curve"),
    )
