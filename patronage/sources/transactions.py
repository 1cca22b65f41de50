"""Transaction text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import CUSTOMER, DATE, MONEY, QUANTITY, TRANSACTION_COLUMNS, TRANSACTION_SCHEMA, VALUE

# Where each column stands in a line, by number of fields. A
# five-field line carries a second, unused id in position 1.
FIELD_POSITIONS = {
    4: {CUSTOMER: 0, DATE: 1, QUANTITY: 2, VALUE: 3},
    5: {CUSTOMER: 0, DATE: 2, QUANTITY: 3, VALUE: 4},
}
LAYOUTS = tuple(FIELD_POSITIONS)

REJECTED = "rejected"


def _with_fields(lines: DataFrame) -> DataFrame:
    """Add ``parts``, the whitespace-separated fields of ``value``; outer blanks
    do not count.

    Filters on the fields must not be pushed below the split, or every one of
    them would split the line again: hence the explode of a single array.
    """
    stripped = F.regexp_replace("value", r"^\s+|\s+$", "")
    return lines.select("value", F.explode(F.array(F.split(stripped, r"\s+"))).alias("parts"))


def _compact_date(text: Column) -> Column:
    """Date written as eight digits, year first; null if it is not one."""
    dashed = F.concat_ws("-", text.substr(1, 4), text.substr(5, 2), text.substr(7, 2))
    return F.when(F.length(text) == 8, dashed.try_cast("date"))


def _whole_number(text: Column) -> Column:
    """Integer, also when written with a zero fraction; null if it is not one."""
    exact = text.try_cast("decimal(20,6)")
    return F.coalesce(
        text.try_cast("int"), F.when(exact == F.floor(exact), exact).try_cast("int")
    )


def _converted(raw: dict[str, Column]) -> dict[str, Column]:
    """Typed columns; null where the text does not convert."""
    return {
        CUSTOMER: raw[CUSTOMER],
        DATE: _compact_date(raw[DATE]),
        QUANTITY: _whole_number(raw[QUANTITY]),
        VALUE: _money(raw[VALUE]),
    }


def _money(text: Column) -> Column:
    """Amount with no more decimals than money has; null if it is not one.

    A cast alone would round further decimals silently.
    """
    exact, amount = text.try_cast("decimal(38,12)"), text.try_cast(MONEY)
    return F.when(exact == amount, amount)


def _padded(customer: Column, width: int | None) -> Column:
    """Ids shorter than ``width`` filled up with zeros on the left, so that they sort as numbers."""
    if width is None:
        return customer
    return F.when(F.length(customer) < width, F.lpad(customer, width, "0")).otherwise(customer)


def typed_transactions(
    lines: DataFrame, layouts: Sequence[int] = LAYOUTS, id_width: int | None = None
) -> DataFrame:
    """Text lines (column ``value``) with their typed columns and a flag ``rejected``.

    Lines whose number of fields is not among ``layouts`` are skipped. A date or number
    that does not convert, or an amount with surplus decimals, makes the line rejected.
    """
    unknown = set(layouts) - set(FIELD_POSITIONS)
    if unknown or not layouts:
        raise ValueError(f"layouts must be some of {LAYOUTS}, got {tuple(layouts)}")

    parts = _with_fields(lines).withColumn("fields", F.size("parts"))
    parts = parts.where(F.col("fields").isin(*layouts))

    def raw(column: str) -> Column:
        choice = None
        for n in layouts:
            field = F.get("parts", F.lit(FIELD_POSITIONS[n][column]))
            here = F.col("fields") == n
            choice = F.when(here, field) if choice is None else choice.when(here, field)
        return choice

    converted = _converted({c: raw(c) for c in TRANSACTION_COLUMNS})
    converted[CUSTOMER] = _padded(converted[CUSTOMER], id_width)
    typed = parts.select("value", *(c.alias(n) for n, c in converted.items()))
    bad = F.col(DATE).isNull() | F.col(QUANTITY).isNull() | F.col(VALUE).isNull()
    return typed.withColumn(REJECTED, bad)


def write_parsed(
    lines: DataFrame, path: str, layouts: Sequence[int] = LAYOUTS, id_width: int | None = None
) -> None:
    """Write transactions and rejects in one pass over the lines, one directory each.

    Read ``rejected=false`` for the transactions, ``rejected=true`` for the rejects'
    lines: ``read_parsed`` does.
    """
    typed = typed_transactions(lines, layouts, id_width)
    line = F.when(F.col(REJECTED), F.col("value")).alias("value")  # good lines are not kept twice
    typed.select(line, *TRANSACTION_COLUMNS, REJECTED).write.partitionBy(REJECTED).parquet(path)


def read_parsed(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Transactions and rejects as ``write_parsed`` left them."""
    added = [T.StructField("value", T.StringType()), T.StructField(REJECTED, T.BooleanType())]
    both = spark.read.schema(T.StructType([*TRANSACTION_SCHEMA.fields, *added])).parquet(path)
    return (
        both.where(~F.col(REJECTED)).select(*TRANSACTION_COLUMNS),
        both.where(F.col(REJECTED)).select("value"),
    )


def parse_transactions(
    lines: DataFrame,
    layouts: Sequence[int] = LAYOUTS,
    mode: str = "permissive",
    id_width: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Transactions and rejects from text lines (column ``value``).

    As ``typed_transactions``; a line that does not convert is a reject (``permissive``)
    or fails the job (``failfast``; rejects are then empty). The two are plans
    over the same lines; to read those once for both, use ``write_parsed``.
    """
    if mode not in ("permissive", "failfast"):
        raise ValueError(f"unknown mode {mode!r}")
    typed, bad = typed_transactions(lines, layouts, id_width), F.col(REJECTED)
    if mode == "failfast":
        message = F.concat(F.lit("cannot convert transaction line: "), F.col("value"))
        good = typed.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))
        rejects = typed.where(F.lit(False))
    else:
        good, rejects = typed.where(~bad), typed.where(bad)
    return good.select(*TRANSACTION_COLUMNS), rejects.select("value")


def load_transactions(spark: SparkSession, path: str, id_width: int | None = None) -> DataFrame:
    """Transactions of a headerless four-column text file.

    Blank lines are ignored and missing trailing fields are null. A line with
    further fields, or a field that does not convert, fails the job. Ids stay
    text; ``id_width`` left-pads them with zeros so that they sort as numbers.
    """
    width = len(TRANSACTION_COLUMNS)
    parts = _with_fields(spark.read.text(path))
    parts = parts.where(F.col("parts")[0] != "")
    raw = {c: F.get("parts", F.lit(i)) for i, c in enumerate(TRANSACTION_COLUMNS)}
    typed = _converted(raw)
    bad = F.size("parts") > width
    for column, value in typed.items():
        bad = bad | (raw[column].isNotNull() & value.isNull())
    message = F.concat(F.lit("not a four-column transaction line: "), F.col("value"))
    checked = parts.where(F.when(bad, F.raise_error(message).cast("boolean")).otherwise(True))
    rows = checked.select(*(value.alias(column) for column, value in typed.items()))
    return rows.withColumn(CUSTOMER, _padded(F.col(CUSTOMER), id_width))


def row_count(df: DataFrame) -> DataFrame:
    """Number of loaded rows, as one row."""
    return df.agg(F.count("*").alias("n_transactions"))


def write_tsv(df: DataFrame, path: str) -> None:
    """Write normalised transactions as tab-separated text with a header."""
    df.select(*TRANSACTION_COLUMNS).write.option("sep", "\t").option("header", True).option(
        "dateFormat", "yyyy-MM-dd"
    ).csv(path)


def read_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Read back what ``write_tsv`` wrote."""
    return (
        spark.read.schema(TRANSACTION_SCHEMA)
        .option("sep", "\t")
        .option("header", True)
        .option("dateFormat", "yyyy-MM-dd")
        .csv(path)
    )
