"""One recency / frequency / monetary row per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import CUSTOMER, DATE, FREQUENCY, MONETARY, MONEY_SUM, RECENCY, VALUE
from .clean import clean_transactions

LAST_DATE = "last_date"


def customer_totals(df: DataFrame) -> DataFrame:
    """Last purchase day, number and sum of purchases per customer.

    All three aggregates combine on the map side, so a customer holding a large
    share of the rows sends one partial row per task. Sums are exact decimals:
    ranks built on them do not depend on the order of addition.
    """
    return (
        df.where(F.col(CUSTOMER).isNotNull())
        .groupBy(CUSTOMER)
        .agg(
            F.max(DATE).alias(LAST_DATE),
            F.count(VALUE).alias(FREQUENCY),
            F.coalesce(F.sum(VALUE), F.lit(0)).cast(MONEY_SUM).alias(MONETARY),
        )
    )


def rfm_table(df: DataFrame, as_of: str | None = None, clean: bool = True) -> DataFrame:
    """Recency in days, Frequency and Monetary per customer.

    ``as_of`` is the day recency is measured at; by default the latest day
    among the (cleaned) transactions. A customer who bought after ``as_of`` has
    a negative recency.
    """
    return metrics_of(customer_totals(clean_transactions(df) if clean else df), as_of)


def metrics_of(totals: DataFrame, as_of: str | None = None) -> DataFrame:
    """The RFM table of customers' totals, see ``rfm_table``."""
    if as_of is None:
        # The latest day overall is the latest of the customers' last days. The
        # struct keeps all three aggregates in the subquery, which makes its
        # shuffle identical to the main one, so Spark runs it once and reuses it.
        latest = F.max(F.struct(LAST_DATE, FREQUENCY, MONETARY))[LAST_DATE]
        day = totals.agg(latest.alias("as_of")).scalar()
    else:
        day = F.lit(as_of).cast("date")
    return totals.select(
        CUSTOMER, F.datediff(day, F.col(LAST_DATE)).alias(RECENCY), FREQUENCY, MONETARY
    )
