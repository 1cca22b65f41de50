"""The table comparing models, kept as full versions side by side."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import COMPARISON_SCHEMA, MODEL, NUM_CLUSTERS

_VERSION = "version"
_KEY = [MODEL, NUM_CLUSTERS]


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.schema(T.StructType([*COMPARISON_SCHEMA, T.StructField(_VERSION, T.IntegerType())])).parquet(path)
    except AnalysisException as missing:
        if missing.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _latest(versions: DataFrame | None) -> int:
    if versions is None:
        return 0
    return versions.agg(F.max(_VERSION)).head()[0] or 0


def read_comparison(spark: SparkSession, path: str) -> DataFrame:
    """The newest version; empty when nothing was saved yet."""
    versions = _versions(spark, path)
    if versions is None:
        return spark.createDataFrame([], COMPARISON_SCHEMA)
    return versions.where(F.col(_VERSION) == _latest(versions)).drop(_VERSION)


def upsert_comparison(spark: SparkSession, path: str, rows: DataFrame) -> DataFrame:
    """Replace the rows with the same (model, number of clusters), add the others.

    Reads version v and writes version v + 1 next to it: what is being read is
    never overwritten, and repeating a failed write replaces its own version
    only. One writer at a time.
    """
    columns = COMPARISON_SCHEMA.fieldNames()
    version = _latest(_versions(spark, path))
    fresh = rows.select(*(F.col(f.name).cast(f.dataType) for f in COMPARISON_SCHEMA))
    if version:
        kept = read_comparison(spark, path).join(fresh.select(*_KEY), _KEY, "left_anti")
        fresh = kept.select(*columns).unionByName(fresh)
    fresh.write.mode("overwrite").parquet(f"{path}/{_VERSION}={version + 1}")
    return read_comparison(spark, path)
