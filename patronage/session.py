"""Where intermediate tables live."""

from __future__ import annotations

import io
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_FOLDER = "patronage"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once per application.

    Tasks of Python operators import it; with this call they can wherever they
    run, whether or not it is installed there.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    target = f"{scratch_path(spark, 'package')}.zip"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    try:
        stream.write(data.getvalue())
    finally:
        stream.close()
    context.addPyFile(target)
    _shipped.add(context.applicationId)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediates: ``spark.checkpoint.dir``.

    A session without the setting uses a folder below its warehouse, which every
    executor of a cluster reaches as well.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def _session_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/{_FOLDER}/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never reused path in this application's scratch folder."""
    return f"{_session_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as Parquet and read it back.

    Cuts the lineage, survives the loss of executors, and fixes the content of
    frames whose row numbering depends on the partition layout. Later readers
    still prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Delete what this application has staged; frames read from it end with it."""
    path = spark._jvm.org.apache.hadoop.fs.Path(_session_folder(spark))
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    system.delete(path, True)
