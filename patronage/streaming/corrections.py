"""RFM totals under purchases that are withdrawn or changed later.

A maximum cannot take a row back, so totals per customer alone are not enough. Kept are signed
sums per customer and day, and above them one partial per customer and span of days: the last
day that still has purchases, their number and sum. A batch of changes writes its differences by
day and folds anew only the customers' spans that it touches; the totals of a customer
are then a fold of few partials. Sums do not depend on the order of arrival: a withdrawal may come
before the purchase it withdraws.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import clean_transactions
from ..operators.rfm import LAST_DATE, metrics_of
from ..schema import CUSTOMER, DATE, FREQUENCY, MONETARY, MONEY_SUM, TRANSACTION_COLUMNS, VALUE
from .purchases import _ALL_AVAILABLE, _BATCH, _compact, _live

#: The column that says whether a purchase comes (1) or is taken back (-1).
SIGN = "sign"
#: Days in a span.
SPAN_DAYS = 91

_SPAN = "span"
_FOLDED = (LAST_DATE, FREQUENCY, MONETARY)


def added(df: DataFrame) -> DataFrame:
    """Transactions as changes that add them."""
    return df.select(*TRANSACTION_COLUMNS, F.lit(1).alias(SIGN))


def withdrawn(df: DataFrame) -> DataFrame:
    """Transactions, as they were added, as changes that take them back."""
    return df.select(*TRANSACTION_COLUMNS, F.lit(-1).alias(SIGN))


def changed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Transactions as they were and as they are now, customer and day included."""
    return withdrawn(before).unionByName(added(after))


def differences(changes: DataFrame) -> DataFrame:
    """(customer, span, day, number, sum): what clean changes add to and take from each day.

    Both sums combine on the map side. Rows that cleaning drops count neither when they
    come nor when they are taken back; days whose number and sum stay as they were are left out.
    """
    span = F.floor(F.unix_date(DATE) / SPAN_DAYS).cast("int")
    return (
        clean_transactions(changes)
        .groupBy(CUSTOMER, span.alias(_SPAN), DATE)
        .agg(
            F.sum(F.col(SIGN).cast("long")).alias(FREQUENCY),
            F.sum(F.col(VALUE) * F.col(SIGN)).cast(MONEY_SUM).alias(MONETARY),
        )
        .where((F.col(FREQUENCY) != 0) | (F.col(MONETARY) != 0))
    )


def _newest_days(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy(CUSTOMER, _SPAN, DATE)
        .agg(
            F.sum(FREQUENCY).alias(FREQUENCY),
            F.sum(MONETARY).cast(MONEY_SUM).alias(MONETARY),
            F.max(_BATCH).alias(_BATCH),
        )
        .where((F.col(FREQUENCY) != 0) | (F.col(MONETARY) != 0))
    )


def _newest_spans(rows: DataFrame) -> DataFrame:
    newest = F.max_by(F.struct(*_FOLDED), _BATCH).alias("newest")
    folded = rows.groupBy(CUSTOMER, _SPAN).agg(newest, F.max(_BATCH).alias(_BATCH))
    return folded.select(CUSTOMER, _SPAN, *(F.col(f"newest.{c}") for c in _FOLDED), _BATCH)


def _fold(days: DataFrame) -> DataFrame:
    """One row per customer and span of ``days``, also where nothing is left in it."""
    left = F.col(FREQUENCY) > 0

    def of_days_left(column: Column) -> Column:
        return F.when(left, column)

    nothing = F.lit(0)
    return days.groupBy(CUSTOMER, _SPAN).agg(
        F.max(of_days_left(F.col(DATE))).alias(LAST_DATE),
        F.coalesce(F.sum(of_days_left(F.col(FREQUENCY))), nothing).cast("long").alias(FREQUENCY),
        F.coalesce(F.sum(of_days_left(F.col(MONETARY))), nothing).cast(MONEY_SUM).alias(MONETARY),
    )


def apply_changes(changes: DataFrame, out: str, number: int) -> None:
    """Add batch ``number`` of changes, columns of transactions and ``sign``, to the tables below ``out``.

    Numbers rise from batch to batch. A repeated batch replaces its own directories, so it
    counts once; one that failed halfway is repeated before later ones. The fold reads the days of
    touched spans only: files are sorted by span, and the spans are part of the scan's filter.
    """
    spark = changes.sparkSession
    mine = f"{_BATCH}={number}"
    rows = differences(changes).sortWithinPartitions(_SPAN)
    rows.write.mode("overwrite").parquet(f"{out}/days/{mine}")
    new = spark.read.schema(rows.schema).parquet(f"{out}/days/{mine}")
    touched = new.select(CUSTOMER, _SPAN).distinct()
    # At most as many as the calendar has.
    spans = [r[0] for r in new.select(_SPAN).distinct().collect()]
    days = _live(spark, f"{out}/days").where(F.col(_SPAN).isin(spans))
    days = _sum_days(days.join(touched, [CUSTOMER, _SPAN], "left_semi"))
    # Pairs whose days cancel out have no day left but need a newer partial.
    emptied = touched.select(
        CUSTOMER,
        _SPAN,
        F.lit(None).cast("date").alias(DATE),
        F.lit(0).cast("long").alias(FREQUENCY),
        F.lit(0).cast(MONEY_SUM).alias(MONETARY),
    )
    folded = _fold(days.unionByName(emptied)).sortWithinPartitions(CUSTOMER)
    folded.write.mode("overwrite").parquet(f"{out}/spans/{mine}")


def _sum_days(days: DataFrame) -> DataFrame:
    return _newest_days(days).drop(_BATCH)


def start_corrections(
    stream: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Apply each micro-batch of changes; the stream itself keeps no state."""

    def write(batch: DataFrame, number: int) -> None:
        apply_changes(batch, out, number)

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or _ALL_AVAILABLE))
        .start()
    )


def compact_corrections(spark: SparkSession, out: str) -> None:
    """Fold finished batches into snapshots, for later batches and readers.

    Days first, so that a batch that is repeated after it counts once. Days on which all was
    taken back disappear from the snapshot.
    """
    _compact(spark, f"{out}/days", _newest_days)
    _compact(spark, f"{out}/spans", _newest_spans)


def corrected_totals(spark: SparkSession, out: str) -> DataFrame:
    """Last day, number and sum of the purchases left of each customer who has any."""
    spans = _live(spark, f"{out}/spans")
    if spans is None:
        raise ValueError(f"no batch of changes below {out}")
    return (
        _newest_spans(spans)
        .where(F.col(FREQUENCY) > 0)
        .groupBy(CUSTOMER)
        .agg(
            F.max(LAST_DATE).alias(LAST_DATE),
            F.sum(FREQUENCY).alias(FREQUENCY),
            F.sum(MONETARY).cast(MONEY_SUM).alias(MONETARY),
        )
    )


def corrected_rfm(spark: SparkSession, out: str, as_of: str | None = None) -> DataFrame:
    """The RFM table of the corrected transactions, see ``rfm_table``."""
    return metrics_of(corrected_totals(spark, out), as_of)


def open_withdrawals(spark: SparkSession, out: str) -> DataFrame:
    """Customers' days with more taken back than was added so far, in number or in sum.

    Days with a negative number do not count in the totals. A row here that stays names a
    withdrawal of something that was never added, or added otherwise.
    """
    days = _sum_days(_live(spark, f"{out}/days"))
    return days.where(
        (F.col(FREQUENCY) < 0)
        | (F.col(MONETARY) < 0)
        | ((F.col(FREQUENCY) == 0) != (F.col(MONETARY) == 0))
    ).drop(_SPAN)
