"""Profiles of transactions kept by day, so that a new day does not reread the others.

Every batch of transactions leaves one row per day and column: counts, mean, squared error, extremes
and a quantile sketch, and a sketch of the customers. All of these merge: days, in any number of
batches, give the profile of the rows they were made from. Counts, mean, deviation and extremes are
exact; quantiles and distinct customers have the errors stated below.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CUSTOMER, DATE, QUANTITY, VALUE
from ..streaming.purchases import _BATCH, _compact, _live
from .describe import SUMMARY_PERCENTS

#: Size of quantile sketches, a few tens of kB for a full one; see ``rank_error``.
QUANTILE_SIZE = 2_000
#: Logarithm of the size of customer sketches, 16 kB for a full one; see ``distinct_error``.
DISTINCT_BITS = 14

_SUMS = "rows", "known", "mean", "squares", "low", "high", "quantiles"


def rank_error(size: int = QUANTILE_SIZE) -> float:
    """How far a quantile's exact rank may be from the one asked for, as a share of the rows.

    The published error of KLL sketches of this size at 99 % confidence, before and after merging.
    """
    return 2.296 / size**0.9723


def distinct_error(bits: int = DISTINCT_BITS) -> float:
    """Three standard errors of a merged HyperLogLog sketch, relative to the number of customers."""
    return 3 * 1.04 / math.sqrt(2**bits)


def day_rows(
    df: DataFrame,
    columns: Sequence[str] = (QUANTITY, VALUE),
    size: int = QUANTILE_SIZE,
    bits: int = DISTINCT_BITS,
) -> tuple[DataFrame, DataFrame]:
    """(values, customers): one row per day and column, and one per day.

    Each is one aggregation with partial sketches on the map side, so a day with a third of all rows sends one
    row per task. Rows without a day make a day of their own, null.
    """
    sums = []
    for i, c in enumerate(columns):
        value = F.col(f"`{c}`").cast("double")
        sums += [
            F.count(value).alias(f"known{i}"),
            F.avg(value).alias(f"mean{i}"),
            (F.var_pop(value) * F.count(value)).alias(f"squares{i}"),
            F.min(value).alias(f"low{i}"),
            F.max(value).alias(f"high{i}"),
            F.kll_sketch_agg_double(value, size).alias(f"quantiles{i}"),
        ]
    wide = df.groupBy(DATE).agg(F.count("*").alias("rows"), *sums)

    def entry(i: int, c: str) -> Column:
        rest = [F.col(f"{name}{i}").alias(name) for name in _SUMS[1:]]
        return F.struct(F.lit(c).alias("column"), F.col("rows"), *rest)

    values = wide.select(DATE, F.inline(F.array(*(entry(i, c) for i, c in enumerate(columns)))))
    customers = df.groupBy(DATE).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col(CUSTOMER).isNull()).alias("missing_ids"),
        F.hll_sketch_agg(F.col(CUSTOMER).cast("string"), bits).alias("ids"),
    )
    return values, customers


def add_days(
    df: DataFrame,
    out: str,
    number: int,
    columns: Sequence[str] = (QUANTITY, VALUE),
    size: int = QUANTILE_SIZE,
    bits: int = DISTINCT_BITS,
) -> None:
    """Add batch ``number`` of transactions to the profile below ``out``.

    A repeated batch replaces its own directories. Days may come again in later batches.
    """
    values, customers = day_rows(df, columns, size, bits)
    values.write.mode("overwrite").parquet(f"{out}/values/{_BATCH}={number}")
    customers.write.mode("overwrite").parquet(f"{out}/customers/{_BATCH}={number}")


def _merged_values(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    """Rows of the same ``by`` as one. Squared errors are taken about the merged mean, not as a
    difference of large sums."""
    known = F.sum("known").alias("known")
    mean = (F.sum(F.col("mean") * F.col("known")) / F.nullif(F.sum("known"), F.lit(0))).alias("mean")
    parts = F.collect_list(F.struct("known", "mean", "squares")).alias("parts")
    others = [F.max(c).alias(c) for c in rows.columns if c == _BATCH]
    merged = rows.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        known,
        mean,
        F.min("low").alias("low"),
        F.max("high").alias("high"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"),
        parts,
        *others,
    )
    total = F.aggregate(
        "parts",
        F.lit(0.0),
        lambda sum_, p: sum_
        + F.coalesce(
            p["squares"] + p["known"] * (p["mean"] - F.col("mean")) * (p["mean"] - F.col("mean")),
            F.lit(0.0),
        ),
    )
    return merged.withColumn("squares", total).select(*by, *_SUMS, *(c for c in [_BATCH] if others))


def _merged_customers(rows: DataFrame, by: Sequence[str]) -> DataFrame:
    others = [F.max(c).alias(c) for c in rows.columns if c == _BATCH]
    return rows.groupBy(*by).agg(
        F.sum("rows").alias("rows"),
        F.sum("missing_ids").alias("missing_ids"),
        F.hll_union_agg("ids").alias("ids"),
        *others,
    )


def compact_days(spark: SparkSession, out: str) -> None:
    """Fold finished batches into one row per day and column."""
    _compact(spark, f"{out}/values", lambda rows: _merged_values(rows, [DATE, "column"]))
    _compact(spark, f"{out}/customers", lambda rows: _merged_customers(rows, [DATE]))


def _days(spark: SparkSession, folder: str, first: str | None, last: str | None) -> DataFrame:
    rows = _live(spark, folder)
    if rows is None:
        raise ValueError(f"no batch of days below {folder}")
    if first is not None:
        rows = rows.where(F.col(DATE) >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.where(F.col(DATE) <= F.lit(last).cast("date"))
    return rows.drop(_BATCH)


def profile(
    spark: SparkSession, out: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """What ``describe`` gives, of the days from ``first`` to ``last``, with percentiles within
    ``rank_error``: values that occur, not interpolated. Also the missing values of each column.

    With a bound, rows without a day are left out. Reads a row per day, batch and column.
    """
    merged = _merged_values(_days(spark, f"{out}/values", first, last), ["column"])
    n = F.col("known")
    deviation = F.when(n > 1, F.sqrt(F.col("squares") / F.greatest(n - 1, F.lit(1))))

    def percentile(percent: int) -> Column:
        at = F.kll_sketch_get_quantile_double("quantiles", F.lit(percent / 100))
        return F.when(n > 0, at).alias(f"p{percent}")

    return merged.select(
        "column",
        n.alias("count"),
        "mean",
        deviation.alias("std"),
        F.col("low").alias("min"),
        *(percentile(p) for p in SUMMARY_PERCENTS),
        F.col("high").alias("max"),
        (F.col("rows") - n).alias("Missing_Values"),
    )


def customer_stats(
    spark: SparkSession, out: str, first: str | None = None, last: str | None = None
) -> DataFrame:
    """What ``id_stats`` gives, of the days from ``first`` to ``last``, with the number of ids within
    ``distinct_error``."""
    merged = _merged_customers(_days(spark, f"{out}/customers", first, last), [])
    missing = F.coalesce("missing_ids", F.lit(0))
    distinct = F.coalesce(F.hll_sketch_estimate("ids"), F.lit(0))
    return merged.select(
        missing.alias("missing_ids"),
        (distinct + F.when(missing > 0, 1).otherwise(0)).alias("unique_ids"),
    )
