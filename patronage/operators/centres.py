"""A K-Means model as a small table: how to scale the metrics, and the centres.

Scoring with it is a projection of literals; nothing is loaded into Spark ML.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import MinMaxScalerModel, StandardScalerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import CLUSTER, CUSTOMER, METRICS

# The two ways of scaling.
STANDARD, MINMAX = "standard", "minmax"

_TABLE = "scaler string, part string, position int, " + ", ".join(f"{m} double" for m in METRICS)


@dataclass(frozen=True)
class CentreModel:
    """``(metric - shift) / scale`` per metric, and centres in that space by cluster number.

    A metric whose ``scale`` is 0 is constant: it scales to 0 (standard) or 0.5 (minmax).
    """

    scaler: str
    shift: tuple[float, ...]
    scale: tuple[float, ...]
    centres: tuple[tuple[float, ...], ...]

    def scaled(self) -> list[Column]:
        constant = 0.0 if self.scaler == STANDARD else 0.5
        return [
            (F.col(m).cast("double") - F.lit(shift)) / F.lit(scale) if scale else F.lit(constant)
            for m, shift, scale in zip(METRICS, self.shift, self.scale, strict=True)
        ]


def centre_model(fitted: PipelineModel) -> CentreModel:
    """The table of a fitted pipeline of assembler, scaler and K-Means."""
    scaler = next(
        s for s in fitted.stages if isinstance(s, (StandardScalerModel, MinMaxScalerModel))
    )
    kmeans = next(s for s in fitted.stages if isinstance(s, KMeansModel))
    centres = tuple(tuple(map(float, c)) for c in kmeans.clusterCenters())
    if isinstance(scaler, StandardScalerModel):
        return CentreModel(
            STANDARD, tuple(map(float, scaler.mean)), tuple(map(float, scaler.std)), centres
        )
    low, high = scaler.originalMin, scaler.originalMax
    return CentreModel(
        MINMAX,
        tuple(map(float, low)),
        tuple(float(h) - float(x) for x, h in zip(low, high, strict=True)),
        centres,
    )


def rescaled(model: CentreModel, rfm: DataFrame) -> CentreModel:
    """The same centres with the scaling of ``rfm`` (stage it: it is read again later)."""
    values = [F.col(m).cast("double") for m in METRICS]
    if model.scaler == STANDARD:
        row = rfm.agg(*(F.avg(v) for v in values), *(F.stddev_samp(v) for v in values)).first()
        shift, scale = row[:3], row[3:]
    else:
        row = rfm.agg(*(F.min(v) for v in values), *(F.max(v) for v in values)).first()
        shift = row[:3]
        scale = [None if h is None else h - x for x, h in zip(row[:3], row[3:], strict=True)]
    return replace(
        model, shift=tuple(x or 0.0 for x in shift), scale=tuple(x or 0.0 for x in scale)
    )


def nearest(df: DataFrame, values: Sequence[Column], centres: Sequence[tuple]) -> DataFrame:
    """Add the nearest centre's ``cluster`` and the ``distance`` to it.

    ``centres`` are (cluster, one number per value), literals of a projection, so rows find
    theirs without a join. Ties go to the smallest cluster.
    """
    if not centres:
        raise ValueError("at least one centre is needed")

    def ranked(cluster, *centre) -> Column:
        squares = (F.pow(v - float(c), 2) for v, c in zip(values, centre, strict=True))
        return F.struct(sum(squares, F.lit(0.0)).alias("squared"), F.lit(cluster).alias("cluster"))

    best = df.withColumn("_nearest", F.array_min(F.array(*(ranked(*c) for c in centres))))
    return best.withColumns(
        {"cluster": F.col("_nearest.cluster"), "distance": F.sqrt("_nearest.squared")}
    ).drop("_nearest")


def assign_centres(model: CentreModel, rfm: DataFrame) -> DataFrame:
    """Customers with their metrics and cluster, a projection over ``rfm``."""
    numbered = [(i, *centre) for i, centre in enumerate(model.centres)]
    return nearest(rfm, model.scaled(), numbered).select(
        CUSTOMER, *METRICS, F.col("cluster").cast("int").alias(CLUSTER)
    )


def save_centres(spark: SparkSession, model: CentreModel, path: str) -> None:
    """Save as a table of a few rows, replacing an earlier one at ``path``."""
    rows = [(model.scaler, "shift", 0, *model.shift), (model.scaler, "scale", 0, *model.scale)]
    rows += [(model.scaler, "centre", i, *c) for i, c in enumerate(model.centres)]
    spark.createDataFrame(rows, _TABLE).coalesce(1).write.mode("overwrite").parquet(path)


def load_centres(spark: SparkSession, path: str) -> CentreModel:
    """Load what ``save_centres`` saved."""
    rows = spark.read.schema(_TABLE).parquet(path).orderBy("part", "position").collect()
    of = {part: [tuple(r[3:]) for r in rows if r["part"] == part] for part in
          ("shift", "scale", "centre")}
    return CentreModel(rows[0]["scaler"], of["shift"][0], of["scale"][0], tuple(of["centre"]))
