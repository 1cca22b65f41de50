"""Running customer totals, scoring and quarantine over a stream of transactions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import accepted, rejected, validate_transactions
from ..operators.centres import CentreModel, assign_centres, centre_model
from ..operators.rfm import LAST_DATE, customer_totals
from ..schema import (
    CLUSTER,
    CUSTOMER,
    FIRST_ACCEPTED_DAY,
    FREQUENCY,
    LAST_ACCEPTED_DAY,
    METRICS,
    MONETARY,
    RECENCY,
    SCORING_DAY,
)

_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_BATCH = "batch"
_SNAPSHOTS, _UNTIL = "_snapshots", "until"
# Unless told otherwise a query takes what has arrived, in batches, and stops.
_ALL_AVAILABLE = {"availableNow": True}


@contextmanager
def _disk_backed_state(spark: SparkSession) -> Iterator[None]:
    """State of every customer ever seen does not fit executor heaps: queries
    started inside keep it in RocksDB."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def running_totals(
    stream: DataFrame, start: str = FIRST_ACCEPTED_DAY, end: str = LAST_ACCEPTED_DAY
) -> DataFrame:
    """Last day, count and sum per customer over the valid transactions so far.

    The three aggregates do not depend on arrival order, so late rows need no
    special care; there is no watermark because a customer's totals must never
    expire.
    """
    return customer_totals(accepted(validate_transactions(stream, start, end)))


def _start(
    totals: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    trigger: dict | None,
) -> StreamingQuery:
    with _disk_backed_state(totals.sparkSession):
        return (
            totals.writeStream.outputMode("update")
            .option("checkpointLocation", checkpoint)
            .foreachBatch(write)
            .trigger(**(trigger or _ALL_AVAILABLE))
            .start()
        )


def _writer(
    out: str, result: Callable[[DataFrame], DataFrame] = lambda batch: batch
) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch to its own directory, so a repeated batch
    replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        result(batch).write.mode("overwrite").parquet(f"{out}/{_BATCH}={batch_id}")

    return write


def start_totals(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    start: str = FIRST_ACCEPTED_DAY,
    end: str = LAST_ACCEPTED_DAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the changed customers' totals after every micro-batch."""
    return _start(running_totals(stream, start, end), _writer(out), checkpoint, trigger)


def _newest_totals(rows: DataFrame) -> DataFrame:
    """Accepted values are positive, so totals only grow and the newest are the
    largest; no ordering by batch is needed."""
    newest = [F.max(c).alias(c) for c in (LAST_DATE, FREQUENCY, MONETARY)]
    return rows.groupBy(CUSTOMER).agg(*newest, F.max(_BATCH).alias(_BATCH))


def _newest_scores(rows: DataFrame) -> DataFrame:
    newest = [F.max_by(c, _BATCH).alias(c) for c in (*METRICS, CLUSTER)]
    return rows.groupBy(CUSTOMER).agg(*newest, F.max(_BATCH).alias(_BATCH))


def _numbers(spark: SparkSession, folder: str, prefix: str) -> list[int]:
    """Numbers of the finished directories ``prefix=number`` in a folder, rising."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    done = []
    for status in system.listStatus(path):
        name, _, number = status.getPath().getName().partition("=")
        finished = spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS")
        if name == prefix and system.exists(finished):
            done.append(int(number))
    return sorted(done)


def _live(spark: SparkSession, out: str) -> DataFrame | None:
    """The newest snapshot and the batches after it; None before the first batch."""
    snapshots = _numbers(spark, f"{out}{_SNAPSHOTS}", _UNTIL)
    until = snapshots[-1] if snapshots else -1
    newer = [b for b in _numbers(spark, out, _BATCH) if b > until]
    rows = None
    if newer:
        paths = [f"{out}/{_BATCH}={b}" for b in newer]
        rows = spark.read.option("basePath", out).parquet(*paths)
        rows = rows.withColumn(_BATCH, F.col(_BATCH).cast("long"))
    if snapshots:
        before = spark.read.parquet(f"{out}{_SNAPSHOTS}/{_UNTIL}={until}")
        rows = before if rows is None else before.unionByName(rows)
    return rows


def _compact(spark: SparkSession, out: str, newest: Callable[[DataFrame], DataFrame]) -> None:
    batches = _numbers(spark, out, _BATCH)
    snapshots = _numbers(spark, f"{out}{_SNAPSHOTS}", _UNTIL)
    if batches and (not snapshots or batches[-1] > snapshots[-1]):
        target = f"{out}{_SNAPSHOTS}/{_UNTIL}={batches[-1]}"
        newest(_live(spark, out)).write.mode("overwrite").parquet(target)


def compact_totals(spark: SparkSession, out: str) -> None:
    """Fold the finished batches of ``start_totals`` into a new snapshot beside the old ones.

    Readers then read that snapshot and newer batches, however many came before. Run
    it from time to time; older snapshots and folded batches may be expired.
    """
    _compact(spark, out, _newest_totals)


def compact_scores(spark: SparkSession, out: str) -> None:
    """As ``compact_totals``, for the output of ``start_scoring``."""
    _compact(spark, out, _newest_scores)


def current_totals(spark: SparkSession, out: str) -> DataFrame:
    """Newest totals per customer from the output of ``start_totals``."""
    return _newest_totals(_live(spark, out)).drop(_BATCH)


def totals_as_of(totals: DataFrame, as_of: str) -> DataFrame:
    """RFM rows from totals. Recency is worked out here and not kept in state,
    where it would go stale every day."""
    day = F.lit(as_of).cast("date")
    return totals.select(
        CUSTOMER, F.datediff(day, F.col(LAST_DATE)).alias(RECENCY), FREQUENCY, MONETARY
    )


def start_scoring(
    stream: DataFrame,
    model: CentreModel | PipelineModel,
    out: str,
    checkpoint: str,
    as_of: str = SCORING_DAY,
    start: str = FIRST_ACCEPTED_DAY,
    end: str = LAST_ACCEPTED_DAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Write the changed customers with their cluster after every micro-batch."""
    centres = centre_model(model) if isinstance(model, PipelineModel) else model

    def scored(totals: DataFrame) -> DataFrame:
        return assign_centres(centres, totals_as_of(totals, as_of))

    return _start(running_totals(stream, start, end), _writer(out, scored), checkpoint, trigger)


def current_scores(spark: SparkSession, out: str) -> DataFrame:
    """Newest metrics and cluster per customer from the output of ``start_scoring``."""
    return _newest_scores(_live(spark, out)).drop(_BATCH)


def start_rejects(
    stream: DataFrame,
    out: str,
    checkpoint: str,
    start: str = FIRST_ACCEPTED_DAY,
    end: str = LAST_ACCEPTED_DAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Append invalid transactions, with the reason, to a Parquet quarantine.

    The file sink records finished batches in its own log: each row appears once.
    """
    return (
        rejected(validate_transactions(stream, start, end))
        .writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or _ALL_AVAILABLE))
        .start()
    )
