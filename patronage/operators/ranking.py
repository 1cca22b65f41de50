"""Exact ranks, order statistics and quartiles without a global sort in one task.

Two exact methods are offered. ``first_ranks`` gives every row its rank from
one range-partitioned sort. ``keys_at_ranks`` finds just the keys standing at a
few wanted ranks by narrowing brackets around them with counting passes; it
shuffles no rows and is all that quartiles and percentiles need.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.ranks import last_ranks_of_quartiles, quartile_of_rank
from ..schema import CUSTOMER, FREQUENCY, METRICS, MONETARY, MONEY, MONEY_SUM, RECENCY
from ..session import stage

# Rows of one bracket that are sorted together in one task.
SORTABLE_ROWS = 200_000
# Rows sampled per bracket to choose the next, narrower brackets.
PIVOT_SAMPLE = 4_000

_INDEX_BITS = 33  # monotonically_increasing_id keeps the row index in the low 33 bits


def metric_values(rfm: DataFrame, value_type: T.DataType = MONEY_SUM) -> DataFrame:
    """The three metrics stacked as (metric, value, customer_id).

    A union of narrow scans and not an explode: what is asked of one metric is
    then planned for its branch alone and compiles to short code. ``rfm``
    should be staged.
    """
    first, *others = (
        rfm.select(F.lit(m).alias("metric"), F.col(m).cast(value_type).alias("value"), CUSTOMER)
        for m in METRICS
    )
    return reduce(DataFrame.unionAll, others, first)


def size_and_value_type(rfm: DataFrame) -> tuple[int, T.DataType]:
    """Number of customers, and the narrowest money type holding every sum: up
    to 18 digits Spark compares and sorts decimals as plain integers."""
    n, largest = rfm.agg(F.count("*"), F.max(F.abs(MONETARY))).head()
    fits = largest is None or largest < 10 ** (MONEY.precision - MONEY.scale)
    return n, MONEY if fits else MONEY_SUM


def first_ranks(rfm: DataFrame) -> DataFrame:
    """Rank 1..n of each customer in each metric, ties by customer id.

    The stacked metrics are sorted once across range partitions. A row's
    position is its index within its partition plus the sizes of the
    partitions before it, so no task holds more than one partition however the
    values are distributed. The sorted frame is staged because the positions
    must not be computed twice under different partition bounds.
    """
    position = F.monotonically_increasing_id()
    _, value_type = size_and_value_type(rfm)
    ordered = stage(
        metric_values(rfm, value_type).orderBy("metric", "value", CUSTOMER).select(
            "metric", CUSTOMER, position.alias("position")
        ),
        "ranks",
    )
    part = F.shiftrightunsigned("position", _INDEX_BITS)
    ordered = ordered.withColumn("part", part)
    # One row per (metric, range partition): bounded by the shuffle partitions.
    parts = ordered.groupBy("metric", "part").agg(
        F.min("position").alias("first"), F.count("*").alias("size")
    )
    before = Window.partitionBy("metric").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    parts = parts.select(
        "metric", "part", "first", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("before")
    )
    ranked = ordered.join(F.broadcast(parts), ["metric", "part"]).select(
        CUSTOMER,
        "metric",
        (F.col("before") + F.col("position") - F.col("first") + 1).alias("rank"),
    )
    return ranked.groupBy(CUSTOMER).agg(
        *(
            F.max(F.when(F.col("metric") == m, F.col("rank"))).alias(f"{m}_rank")
            for m in METRICS
        )
    )


@dataclass
class _Bracket:
    """Rows of ``group`` with ``low <= key < high`` (None: open), and the wanted
    ranks that fall among them."""

    group: str
    low: tuple | None
    high: tuple | None
    below: int  # weight of the group's rows under ``low``
    rows: int
    weight: int
    ranks: list[int]


def keys_at_ranks(
    values: DataFrame,
    group: str,
    keys: Sequence[str],
    ranks_of: Callable[[str, int], list[int]],
    weight: str | None = None,
    sizes: dict[str, int] | None = None,
    sortable_rows: int = SORTABLE_ROWS,
    pivot_sample: int = PIVOT_SAMPLE,
) -> dict[tuple[str, int], tuple]:
    """The key tuple at each wanted 1-based rank of each group, exactly.

    ``values`` must be cheap to scan again (staged or persisted), and ``keys``
    unique and not null within a group; a row counts ``weight`` times.
    ``ranks_of(group, n)`` names the wanted ranks once the size is known;
    ``sizes`` gives the rows of each group where the caller knows them.

    While a bracket is too large to sort, a sample proposes pivots, the weights
    between pivots are counted over all rows, and the bracket shrinks to the
    interval that provably holds the rank. The sample only decides how fast the
    brackets shrink, never the result.
    """
    w = F.col(weight) if weight else F.lit(1)
    types = {field.name: field.dataType for field in values.schema}
    keys = list(keys)

    def reaches(key: tuple) -> Column:
        """Whether a row's keys are at or after ``key``. Plain comparisons of
        columns: comparing structs would build one per row and pivot."""
        (last, value), *earlier = reversed(list(zip(keys, key)))
        test = F.col(last) >= F.lit(value).cast(types[last])
        for column, value in earlier:
            at = F.lit(value).cast(types[column])
            test = (F.col(column) > at) | ((F.col(column) == at) & test)
        return test

    def inside(b: _Bracket) -> Column:
        test = F.col(group) == b.group
        if b.low is not None:
            test = test & reaches(b.low)
        if b.high is not None:
            test = test & ~reaches(b.high)
        return test

    def numbered(brackets: list[_Bracket]) -> DataFrame:
        number = F.when(inside(brackets[0]), 0)
        for i, b in enumerate(brackets[1:], 1):
            number = number.when(inside(b), i)
        rows = values.select(group, *keys, w.cast("bigint").alias("_w"), number.alias("_b"))
        return rows.where(F.col("_b").isNotNull())

    if sizes is None or weight:
        totals = values.groupBy(group).agg(F.count("*"), F.sum(w))
        found_sizes = {row[0]: (row[1], row[2]) for row in totals.collect()}  # a row per group
    else:
        found_sizes = {name: (n, n) for name, n in sizes.items()}
    brackets = []
    for name, (rows, total) in found_sizes.items():
        wanted = sorted(set(ranks_of(name, total)))
        if wanted:
            brackets.append(_Bracket(name, None, None, 0, rows, total, wanted))

    seed = 0
    while any(b.rows > sortable_rows for b in brackets):
        seed += 1
        brackets = _narrow(
            brackets, numbered(brackets), keys, reaches, sortable_rows, pivot_sample, seed
        )
    if not brackets:
        return {}

    up_to = Window.partitionBy("_b").orderBy(*keys).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    running = numbered(brackets).withColumn("_upto", F.sum("_w").over(up_to))
    hit = F.lit(False)
    for i, b in enumerate(brackets):
        for rank in b.ranks:
            at = rank - b.below
            hit = hit | (
                (F.col("_b") == i) & (F.col("_upto") >= at) & (F.col("_upto") - F.col("_w") < at)
            )
    found = {}
    for row in running.where(hit).collect():  # at most one row per wanted rank
        b = brackets[row["_b"]]
        for rank in b.ranks:
            if row["_upto"] - row["_w"] < rank - b.below <= row["_upto"]:
                found[(b.group, rank)] = tuple(row[c] for c in keys)
    return found


def _narrow(
    brackets: list[_Bracket],
    rows: DataFrame,
    keys: list[str],
    reaches: Callable[[tuple], Column],
    sortable_rows: int,
    pivot_sample: int,
    seed: int,
) -> list[_Bracket]:
    """Split every oversized bracket at sampled pivots and keep the intervals
    that hold wanted ranks."""
    big = [i for i, b in enumerate(brackets) if b.rows > sortable_rows]
    fraction = F.lit(0.0)
    for i in big:
        share = min(1.0, pivot_sample / brackets[i].rows)
        fraction = F.when(F.col("_b") == i, share).otherwise(fraction)
    # About ``pivot_sample`` rows per oversized bracket reach the driver.
    sampled: dict[int, list[tuple]] = {i: [] for i in big}
    for row in rows.where(F.rand(seed) < fraction).select("_b", *keys, "_w").collect():
        sampled[row["_b"]].append((tuple(row[c] for c in keys), row["_w"]))

    pivots = {i: _pivots(brackets[i], sorted(sampled[i])) for i in big}
    zone = F.lit(0)
    for i in big:
        passed = sum((reaches(p).cast("int") for p in pivots[i]), F.lit(0))
        zone = F.when(F.col("_b") == i, passed).otherwise(zone)
    counted: dict[tuple[int, int], tuple[int, int]] = {
        (row["_b"], row["_z"]): (row["n"], row["w"])
        for row in rows.groupBy("_b", zone.alias("_z"))
        .agg(F.count("*").alias("n"), F.sum("_w").alias("w"))
        .collect()  # one row per interval between pivots
    }

    narrowed = []
    for i, b in enumerate(brackets):
        if i not in pivots:
            narrowed.append(b)
            continue
        edges = [b.low, *pivots[i], b.high]
        below = b.below
        for z in range(len(edges) - 1):
            n, weight = counted.get((i, z), (0, 0))
            held = [r for r in b.ranks if below < r <= below + weight]
            if held:
                narrowed.append(_Bracket(b.group, edges[z], edges[z + 1], below, n, weight, held))
            below += weight
    return narrowed


def _pivots(b: _Bracket, sample: list[tuple[tuple, int]]) -> list[tuple]:
    """Sampled keys closely around the estimated place of each wanted rank, and
    evenly spaced ones in case the estimate is poor."""
    size = len(sample)
    if size == 0:
        return []
    places = {size * i // 4 for i in range(1, 4)}
    seen, reached = sum(w for _, w in sample), 0
    # Three standard deviations of the place of a median in a sample.
    spread = math.ceil(1.5 * math.sqrt(size))
    targets = [((rank - b.below) / b.weight * seen) for rank in b.ranks]
    for place, (_, w) in enumerate(sample):
        for target in targets:
            if reached < target <= reached + w:
                places.update((place - spread, place + spread))
        reached += w
    return sorted({sample[p][0] for p in places if 0 <= p < size} - {b.low})


def quartiles(rfm: DataFrame, sortable_rows: int = SORTABLE_ROWS) -> DataFrame:
    """Add quartile scores R (4 = most recent), F and M (4 = largest), 1..4.

    Ties are ordered by customer id, as for ``first_ranks``. Three cut keys per
    metric decide every score, so the scores are a projection over ``rfm``:
    nothing is sorted or shuffled in full. ``rfm`` should be staged, it is
    scanned more than once. At least two customers are needed.
    """
    n, value_type = size_and_value_type(rfm)
    if n < 2:
        raise ValueError("quartiles need at least two customers")
    ranks = last_ranks_of_quartiles(n)
    cuts = keys_at_ranks(
        metric_values(rfm, value_type),
        "metric",
        ["value", CUSTOMER],
        lambda metric, size: ranks,
        sizes=dict.fromkeys(METRICS, n),
        sortable_rows=sortable_rows,
    )
    types = {field.name: field.dataType for field in rfm.schema}

    def quartile(metric: str) -> Column:
        passed = F.lit(1)
        for rank in ranks:
            value, customer = cuts[(metric, rank)]
            at = F.lit(value).cast(types[metric])
            above = (F.col(metric) > at) | (
                (F.col(metric) == at) & (F.col(CUSTOMER) > F.lit(customer).cast(types[CUSTOMER]))
            )
            passed = passed + above.cast("int")
        return passed

    return rfm.withColumns(
        {"R": 5 - quartile(RECENCY), "F": quartile(FREQUENCY), "M": quartile(MONETARY)}
    )


def quartiles_from_ranks(ranked: DataFrame) -> DataFrame:
    """Scores R, F, M of the output of ``first_ranks``."""
    n = ranked.agg(F.count("*")).scalar()
    return ranked.select(
        CUSTOMER,
        (5 - quartile_of_rank(F.col(f"{RECENCY}_rank"), n)).alias("R"),
        quartile_of_rank(F.col(f"{FREQUENCY}_rank"), n).alias("F"),
        quartile_of_rank(F.col(f"{MONETARY}_rank"), n).alias("M"),
    )
