"""Cleaning stored transactions and validating newly entered ones."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import (
    DATE,
    FIRST_ACCEPTED_DAY,
    LAST_ACCEPTED_DAY,
    QUANTITY,
    TRANSACTION_COLUMNS,
    VALUE,
)

REASON = "reject_reason"

# Reasons for turning a new transaction away.
BAD_DATE = "Transaction date must be between {start} and {end}."
BAD_QUANTITY = "Number of CDs should be greater than 0"
BAD_VALUE = "Transaction value should be greater than 0"


def clean_transactions(df: DataFrame) -> DataFrame:
    """Keep transactions of positive value with no missing field.

    Stated as plain null tests rather than ``na.drop`` so that the optimizer
    can push them to the scan and fold those on columns that are never null.
    """
    complete = reduce(Column.__and__, (F.col(c).isNotNull() for c in TRANSACTION_COLUMNS))
    return df.where((F.col(VALUE) > 0) & complete)


def validate_transactions(
    df: DataFrame, start: str = FIRST_ACCEPTED_DAY, end: str = LAST_ACCEPTED_DAY
) -> DataFrame:
    """Add ``reject_reason``: the first failing check, null when accepted.

    Date range first, then quantity, then value. A missing field fails its check.
    """
    in_range = F.col(DATE).between(F.lit(start).cast("date"), F.lit(end).cast("date"))

    def failed(check: Column) -> Column:
        return ~F.coalesce(check, F.lit(False))

    reason = (
        F.when(failed(in_range), BAD_DATE.format(start=start, end=end))
        .when(failed(F.col(QUANTITY) > 0), BAD_QUANTITY)
        .when(failed(F.col(VALUE) > 0), BAD_VALUE)
    )
    return df.withColumn(REASON, reason)


def accepted(df: DataFrame) -> DataFrame:
    """Validated rows without a reject reason."""
    return df.where(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    """Validated rows with a reject reason."""
    return df.where(F.col(REASON).isNotNull())
