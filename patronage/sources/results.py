"""Saved segment profiles, customer assignments and models."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..schema import NUM_CLUSTERS, profile_schema


def save_results(df: DataFrame, path: str) -> None:
    """Write results as CSV with one directory per number of clusters.

    Saving again for the same number replaces that directory only, so results
    for different numbers of clusters live side by side.
    """
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("header", True)
        .partitionBy(NUM_CLUSTERS)
        .csv(path)
    )


def read_results(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Read saved results; ``schema`` may be the name of a profile's segment column."""
    if isinstance(schema, str):
        schema = profile_schema(schema)
    return spark.read.schema(schema).option("header", True).csv(path)


def save_model(model: PipelineModel, path: str) -> None:
    """Save a fitted model, replacing an earlier one at ``path``."""
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved model."""
    return PipelineModel.load(path)
