"""Quartile scores and levels that stay exact while transactions arrive.

Every micro-batch changes the totals of some customers. For each metric a tree counts the customers
by value: a node is a value without its last bytes, and a changed customer takes one from
the nodes of the old value and adds one to those of the new. Only these differences are written. A
rank is found by walking down from the top, at most 256 counts a step; where several
customers share the value there, their ids decide, as in the batch quartiles. Cuts and
profile of a batch are written beside its totals, so a repeated batch replaces all of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.ranks import last_ranks_of_quartiles
from ..operators.ranking import keys_at_ranks
from ..operators.rfm import LAST_DATE
from ..operators.segments import levels, rfm_profile, scores
from ..schema import (
    CUSTOMER,
    FIRST_ACCEPTED_DAY,
    FREQUENCY,
    LAST_ACCEPTED_DAY,
    METRICS,
    MONETARY,
    RECENCY,
    check_k,
)
from ..session import stage
from .purchases import (
    _BATCH,
    _compact,
    _live,
    _newest_totals,
    _numbers,
    _start,
    running_totals,
)

#: Bits that a step of the tree adds, and its steps: all values have 63 bits.
STEP_BITS, STEPS = 8, 8
_LAST_DAY = 1 << 31

_CUTS = "metric string, quartile int, key long, customer string, n long"


def _keys(totals: DataFrame) -> dict[str, Column]:
    """The metrics as whole numbers from 0 up, in their order: days back from a far day, counts,
    hundredths of money. A sum beyond 63 bits of hundredths is an error."""
    return {
        RECENCY: F.lit(_LAST_DAY) - F.unix_date(LAST_DATE).cast("long"),
        FREQUENCY: F.col(FREQUENCY).cast("long"),
        MONETARY: (F.col(MONETARY) * 100).cast("long"),
    }


def _stacked(totals: DataFrame, sign: int) -> DataFrame:
    """(metric, key, customer_id, n): a row per customer and metric."""
    parts = [
        totals.select(F.lit(m).alias("metric"), key.alias("key"), CUSTOMER, F.lit(sign).alias("n"))
        for m, key in _keys(totals).items()
    ]
    return reduce(DataFrame.unionAll, parts)


def differences(before: DataFrame | None, after: DataFrame) -> DataFrame:
    """(level, metric, prefix, n): what the customers of ``after`` change in the tree.

    ``before`` holds totals from before them, of these customers and any others.
    """
    moves = _stacked(after, 1)
    if before is not None:
        moves = moves.unionAll(_stacked(before.join(after.select(CUSTOMER), CUSTOMER, "left_semi"), -1))
    leaves = moves.groupBy("metric", "key").agg(F.sum("n").alias("n")).where("n <> 0")
    steps = F.array(
        *(
            F.struct(
                F.lit(step).alias("level"),
                F.shiftright("key", STEP_BITS * (STEPS - 1 - step)).alias("prefix"),
            )
            for step in range(STEPS)
        )
    )
    nodes = leaves.select("metric", F.explode(steps).alias("node"), "n")
    return nodes.groupBy("node.level", "metric", "node.prefix").agg(F.sum("n").alias("n")).where("n <> 0")


def _newest_tree(rows: DataFrame) -> DataFrame:
    return (
        rows.groupBy("level", "metric", "prefix")
        .agg(F.sum("n").alias("n"), F.max(_BATCH).alias(_BATCH))
        .where("n <> 0")
    )


def _walk(tree: DataFrame, wanted: dict[tuple[str, int], int]) -> dict[tuple[str, int], tuple]:
    """(key, rank among the customers of that key) of each (metric, rank)."""
    at = {which: (0, rank) for which, rank in wanted.items()}
    for step in range(STEPS):
        parents = {(metric, at[metric, q][0]) for metric, q in at}
        first = 1 << STEP_BITS
        below = [
            (F.col("metric") == metric) & F.col("prefix").between(p * first, p * first + first - 1)
            for metric, p in parents
        ]
        rows = (
            tree.where((F.col("level") == step) & reduce(Column.__or__, below))
            .groupBy("metric", "prefix")
            .agg(F.sum("n").alias("n"))
            .orderBy("prefix")
            .collect()  # 256 for each wanted rank at most
        )
        for (metric, q), (parent, rank) in at.items():
            for row in rows:
                if row["metric"] != metric or row["prefix"] // first != parent:
                    continue
                if rank <= row["n"]:
                    at[metric, q] = (row["prefix"], rank)
                    break
                rank -= row["n"]
    return at


def cuts(tree: DataFrame, totals: DataFrame) -> list[tuple]:
    """(metric, quartile, key, customer, n) of the last customer in quartiles 1 to 3 of each
    metric; none for fewer than two customers."""
    counted = tree.where((F.col("level") == 0) & (F.col("metric") == FREQUENCY))
    n = counted.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    if n < 2:
        return []
    ranks = last_ranks_of_quartiles(n)
    found = _walk(tree, {(m, q + 1): rank for m in METRICS for q, rank in enumerate(ranks)})
    within: dict[str, set[int]] = {}
    for (metric, _), (key, rank) in found.items():
        within.setdefault(f"{metric}:{key}", set()).add(rank)
    group = F.concat("metric", F.lit(":"), "key")
    tied = stage(
        _stacked(totals, 1).select(group.alias("place"), CUSTOMER).where(group.isin([*within])),
        "tied",
    )
    customers = keys_at_ranks(tied, "place", [CUSTOMER], lambda place, size: sorted(within[place]))
    return [
        (metric, q, key, str(customers[f"{metric}:{key}", rank][0]), n)
        for (metric, q), (key, rank) in found.items()
    ]


def _scored(totals: DataFrame, found: list[tuple], as_of: str) -> DataFrame:
    """Customers with their metrics and quartile scores, a projection over their totals."""
    kind, keys = totals.schema[CUSTOMER].dataType, _keys(totals)

    def passed(metric: str) -> Column:
        out = F.lit(1)
        for m, _, key, customer, _ in found:
            if m == metric:
                after = F.col(CUSTOMER) > F.lit(customer).cast(kind)
                above = (keys[metric] > key) | ((keys[metric] == key) & after)
                out = out + above.cast("int")
        return out

    with_scores = totals.withColumns(
        {"R": 5 - passed(RECENCY), "F": passed(FREQUENCY), "M": passed(MONETARY)}
    )
    day = F.datediff(F.lit(as_of).cast("date"), F.col(LAST_DATE))
    return scores(
        with_scores.select(CUSTOMER, day.alias(RECENCY), FREQUENCY, MONETARY, "R", "F", "M")
    )


def start_levels(
    stream: DataFrame,
    k: int,
    out: str,
    checkpoint: str,
    as_of: str,
    start: str = FIRST_ACCEPTED_DAY,
    end: str = LAST_ACCEPTED_DAY,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Keep totals, counts, cuts and the profile of ``k`` segments up to date.

    Below ``out``, every micro-batch writes the changed customers' totals, its differences of the
    tree, the nine cuts, and the profile of all customers with recency as of ``as_of``. A batch reads
    the newest totals of all customers, from the last snapshot on, see ``compact_levels``.
    """
    check_k(k)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        mine = f"{_BATCH}={number}"
        earlier = _live(spark, f"{out}/totals")
        batch.write.mode("overwrite").parquet(f"{out}/totals/{mine}")
        changed = spark.read.schema(batch.schema).parquet(f"{out}/totals/{mine}")
        if earlier is not None:
            earlier = _newest_totals(earlier.where(F.col(_BATCH) < number)).drop(_BATCH)
        moves = differences(earlier, changed)
        moves.write.mode("overwrite").parquet(f"{out}/tree/{mine}")
        totals = _newest_totals(_live(spark, f"{out}/totals")).drop(_BATCH)
        found = cuts(_live(spark, f"{out}/tree"), totals)
        if found:
            scored = _scored(totals, found, as_of)
            rfm_profile(scored, k).write.mode("overwrite").parquet(f"{out}/profiles/{mine}")
        frame = spark.createDataFrame(found, _CUTS).coalesce(1)
        frame.write.mode("overwrite").parquet(f"{out}/cuts/{mine}")

    return _start(running_totals(stream, start, end), write, checkpoint, trigger)


def compact_levels(spark: SparkSession, out: str) -> None:
    """Fold finished batches of tree and totals into snapshots, for later batches and readers.

    Call it between runs of the stream or from its own thread; the tree comes first, so that
    a batch which is repeated after it changes nothing that counts.
    """
    _compact(spark, f"{out}/tree", _newest_tree)
    _compact(spark, f"{out}/totals", _newest_totals)


def live_scores(spark: SparkSession, out: str, as_of: str) -> DataFrame:
    """Every customer so far with metrics, quartile scores, segment code and total score.

    The same as the batch scores of all transactions that have arrived.
    """
    done = _numbers(spark, f"{out}/cuts", _BATCH)
    found = []
    if done:
        frame = spark.read.schema(_CUTS).parquet(f"{out}/cuts/{_BATCH}={done[-1]}")
        found = [tuple(row) for row in frame.collect()]  # nine rows
    if not found:
        raise ValueError("quartiles need at least two customers")
    totals = _newest_totals(_live(spark, f"{out}/totals")).drop(_BATCH)
    return _scored(totals, found, as_of)


def live_levels(spark: SparkSession, out: str, k: int, as_of: str) -> DataFrame:
    """``live_scores`` with the rule-based level for ``k`` segments."""
    return levels(live_scores(spark, out, as_of), k)
