"""Column expressions that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def named(name: str) -> Column:
    """The column of that name, whatever signs are in it."""
    return F.col("`" + name.replace("`", "``") + "`")


def whole_row(frame: DataFrame) -> Column:
    """All columns of ``frame`` as one struct."""
    return F.struct(*[named(name) for name in frame.columns])


def table(spark: SparkSession, folder: str, name: str, *columns: str) -> DataFrame:
    """The named columns of a given table; the scan reads no others."""
    frame = spark.read.parquet(f"{folder}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def whole_text(column: str = "text") -> Column:
    """The text, null counting as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and leave every other character alone.

    For a text of ASCII characters that is ``lower``, which is faster than
    ``translate``; both give the same.
    """
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(
        F.translate(text, string.ascii_uppercase, string.ascii_lowercase)
    )


def fold(column: str, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % n
