"""Transaction tables derived from the given order and event tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CUSTOMER, DATE, MONEY, QUANTITY, TRANSACTION_COLUMNS, VALUE

ORDER = "o_orderkey"

# The columns used of each table; stating them saves a job that would read them
# from a file footer.
_ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp_ntz"
_LINES = "l_orderkey bigint, l_quantity double"
_EVENTS = "ts timestamp_ntz, user_id bigint, value double"


def orders_as_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """One transaction per order, with the order key.

    Line quantities are summed per order before the join (on the map side
    first), so an order with very many lines is one row in it.
    """
    orders = spark.read.schema(_ORDERS).parquet(f"{folder}/orders.parquet")
    lines = spark.read.schema(_LINES).parquet(f"{folder}/lineitem.parquet")
    quantity = lines.groupBy(F.col("l_orderkey").alias(ORDER)).agg(
        F.sum("l_quantity").cast("int").alias("quantity")
    )
    return orders.join(quantity, ORDER, "left").select(
        ORDER,
        F.col("o_custkey").alias(CUSTOMER),
        F.to_date("o_orderdate").alias(DATE),
        F.coalesce("quantity", F.lit(0)).alias(QUANTITY),
        F.col("o_totalprice").cast(MONEY).alias(VALUE),
    )


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """The clean transaction table."""
    return orders_as_transactions(spark, folder).select(*TRANSACTION_COLUMNS)


def _every(n: int) -> Column:
    return F.col(ORDER) % n == 0


def dirty_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions with negative, zero and missing fields put in by order key."""
    value = (
        F.when(_every(17), -F.col(VALUE)).when(_every(19), 0).otherwise(F.col(VALUE)).cast(MONEY)
    )
    return orders_as_transactions(spark, folder).select(
        ORDER,
        F.when(~_every(13), F.col(CUSTOMER)).alias(CUSTOMER),
        DATE,
        F.when(~_every(23), F.col(QUANTITY)).alias(QUANTITY),
        value.alias(VALUE),
    )


def transaction_lines(spark: SparkSession, folder: str, mixed: bool = True) -> DataFrame:
    """Transactions as text lines (column ``value``), ids padded to ten digits.

    ``mixed`` also makes lines with a second id (five fields), lines without a
    value (three fields, to be skipped) and values that are not numbers.
    """
    shown = F.format_string("%.2f", F.col(VALUE).cast("double"))
    day = F.date_format(DATE, "yyyyMMdd")
    padded = F.format_string(" %010d", F.col(CUSTOMER))
    quantity = F.col(QUANTITY).cast("string")
    four = F.concat_ws("  ", padded, day, quantity, shown)
    line = four
    if mixed:
        second = (F.col(ORDER) % 1000).cast("string")
        line = (
            F.when(_every(11), F.concat_ws(" ", padded, day, quantity))
            .when(_every(29), F.concat_ws(" ", padded, day, quantity, F.lit("n/a")))
            .when(_every(7), F.concat_ws("   ", padded, second, day, quantity, shown))
            .otherwise(four)
        )
    return orders_as_transactions(spark, folder).select(line.alias("value"))


def unpadded_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Transactions as four-field text lines with ids as they are; every fifth amount
    has a third decimal."""
    shown = F.format_string("%.2f", F.col(VALUE).cast("double"))
    amount = F.when(_every(5), F.concat(shown, F.lit("7"))).otherwise(shown)
    day = F.date_format(DATE, "yyyyMMdd")
    return orders_as_transactions(spark, folder).select(
        F.concat_ws(" ", F.col(CUSTOMER).cast("string"), day, F.col(QUANTITY), amount).alias("value")
    )


def event_transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as transactions of one item each."""
    return spark.read.schema(_EVENTS).parquet(f"{folder}/events.parquet").select(
        F.col("user_id").alias(CUSTOMER),
        F.to_date("ts").alias(DATE),
        F.lit(1).alias(QUANTITY),
        F.col("value").cast(MONEY).alias(VALUE),
    )
