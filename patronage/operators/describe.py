"""Exploring a transaction table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CUSTOMER, DATE, QUANTITY, TRANSACTION_COLUMNS, VALUE
from ..session import stage
from .ranking import SORTABLE_ROWS, keys_at_ranks

# The quartiles of a numeric summary.
SUMMARY_PERCENTS = (25, 50, 75)


def sample_rows(df: DataFrame, key: Sequence[str], n: int = 5, seed: int = 42) -> DataFrame:
    """Exactly ``n`` random rows (fewer only if the table has fewer).

    Rows come in the order of the digest of ``seed`` and their ``key``, which does not
    depend on how the table is partitioned. Rows with equal keys are equally likely.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *(F.col(c).cast("string") for c in key))
    return df.orderBy(F.md5(text), *key).limit(n)


def head_rows(df: DataFrame, order_by: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order."""
    return df.orderBy(*order_by).limit(n)


def _percentile_places(n: int) -> dict[int, tuple[int, int, float]]:
    """Per percent: the two ranks to interpolate between, and the weight of the upper."""
    places = {}
    for percent in SUMMARY_PERCENTS:
        hundredths = percent * (n - 1)
        low = hundredths // 100 + 1
        places[percent] = (low, min(low + 1, n), (hundredths % 100) / 100)
    return places


def describe(
    df: DataFrame,
    columns: Sequence[str] = (QUANTITY, VALUE),
    sortable_rows: int = SORTABLE_ROWS,
) -> DataFrame:
    """count, mean, std (n - 1), min, 25/50/75 % (interpolated), max per column.

    ``df`` is read once: equal values are counted on the map side and the
    staged (column, value, count) table answers everything else, the exact
    percentiles through ``keys_at_ranks``.
    """
    entries = [
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    stacked = df.select(F.explode(F.array(*entries)).alias("e")).select("e.column", "e.value")
    # Missing values are counted too, to keep columns that have no others.
    counted = stage(stacked.groupBy("column", "value").agg(F.count("*").alias("n")), "values")
    known = counted.where(F.col("value").isNotNull())
    sizes: dict[str, int] = {}

    def wanted(column: str, n: int) -> list[int]:
        sizes[column] = n
        return [rank for low, high, _ in _percentile_places(n).values() for rank in (low, high)]

    at = keys_at_ranks(
        known, "column", ["value"], wanted, weight="n", sortable_rows=sortable_rows
    )
    n_known = F.sum(F.when(F.col("value").isNotNull(), F.col("n")))
    totals = counted.groupBy("column").agg(
        F.coalesce(n_known, F.lit(0)).alias("count"),
        (F.sum(F.col("value") * F.col("n")) / n_known).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    # One row per column: small by construction.
    means = F.broadcast(totals.select("column", "mean"))
    deviation = (F.col("value") - F.col("mean")) * (F.col("value") - F.col("mean"))
    spread = counted.join(means, "column").groupBy("column").agg(
        F.sum(deviation * F.col("n")).alias("squares")
    )

    def percentile(percent: int):
        chosen = F.lit(None).cast("double")
        for column, n in sizes.items():
            low, high, share = _percentile_places(n)[percent]
            low_value, high_value = at[(column, low)][0], at[(column, high)][0]
            value = low_value + (high_value - low_value) * share
            chosen = F.when(F.col("column") == column, value).otherwise(chosen)
        return chosen

    squares = F.when(F.col("count") > 1, F.col("squares") / F.greatest(F.col("count") - 1, F.lit(1)))
    return totals.join(F.broadcast(spread), "column").select(
        "column",
        "count",
        "mean",
        F.sqrt(squares).alias("std"),
        "min",
        *(percentile(p).alias(f"p{p}") for p in SUMMARY_PERCENTS),
        "max",
    )


def null_counts(df: DataFrame, columns: Sequence[str] = TRANSACTION_COLUMNS) -> DataFrame:
    """Missing values per column, one row per column."""
    counts = df.agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in columns))
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(c).alias("Missing_Values")) for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def date_range(df: DataFrame) -> DataFrame:
    """First and last transaction day."""
    return df.agg(F.min(DATE).alias("first_date"), F.max(DATE).alias("last_date"))


def id_stats(df: DataFrame, approximate: bool = False) -> DataFrame:
    """Transactions without a customer id, and the number of distinct ids where
    "missing" counts as one id."""
    missing = F.count_if(F.col(CUSTOMER).isNull())
    distinct = (
        F.approx_count_distinct(CUSTOMER) if approximate else F.count_distinct(F.col(CUSTOMER))
    )
    return df.agg(
        missing.alias("missing_ids"),
        (distinct + F.when(missing > 0, 1).otherwise(0)).alias("unique_ids"),
    )
