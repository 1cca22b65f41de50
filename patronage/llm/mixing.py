"""Mixing sources to target weights by the cube method.

A source that must give ``r`` times its words gives every document ``floor(r)``
times and one time more with probability ``r - floor(r)``. Which documents get
the extra copy is drawn by the cube method: probabilities move along directions that
keep both the words taken and the documents taken at their totals, until only a
few in a source are still fractional; landing decides those.

The flight runs in buckets of bounded size in parallel. At most two documents of a bucket are
still fractional; they meet those of other buckets in the next level's flight.
"""

from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.columns import whole_row, whole_text
from patronage.session import stage

#: Documents of one flight.
BUCKET = 1_000
#: A source stops at this many times its size.
MOST_REPEATS = 3
#: Sources up to this number are broadcast to the documents.
BROADCAST_SOURCES = 50_000

#: Largest documents of a flight that move against all others.
LARGEST = 100

_EDGE = 1e-9


def word_count(text: Column) -> Column:
    """The number of words ``[^\\x20\\x09-\\x0D]+``."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """``sizes`` (source, source_size, lots; one row per source) with each source's target.

    Sources in code point order, null last, weigh 1, 2, 3, 1, 2, 3 and so on,
    and share the sum of all sizes; a source stops at three times its size, the excess
    being shared again by weight until none is above. The driver sees sums only.
    """
    spark = sizes.sparkSession
    ordered = stage(
        sizes.repartitionByRange(F.col("source").asc_nulls_last())
        .sortWithinPartitions(F.col("source").asc_nulls_last())
        .withColumn("place", F.monotonically_increasing_id())
    )
    part = F.shiftright("place", 33)
    counts = ordered.groupBy(part.alias("part")).count().orderBy("part").collect()
    offsets, total = [], 0
    for row in counts:
        offsets.append((row["part"], total))
        total += row["count"]
    before = spark.createDataFrame(offsets or [(0, 0)], "part long, before long")
    weighed = stage(
        ordered.join(F.broadcast(before), part == before["part"]).select(
            "source",
            "source_size",
            "lots",
            (
                (F.col("before") + F.col("place") - F.shiftleft(F.col("part"), 33)) % 3 + 1
            ).alias("weight"),
        )
    )
    size, weight = F.col("source_size").cast("double"), F.col("weight")
    everything = weighed.agg(F.sum("source_size")).first()[0] or 0
    level = 0.0
    stopped = F.lit(MOST_REPEATS) * size < 0
    while True:
        rest, weights = weighed.agg(
            F.lit(float(everything))
            - F.coalesce(F.sum(F.when(stopped, MOST_REPEATS * size)), F.lit(0.0)),
            F.coalesce(F.sum(F.when(~stopped, weight)), F.lit(0)),
        ).first()
        if not weights:
            break
        raised = rest / weights
        if raised <= level * (1 + 1e-12):
            break
        level = raised
        stopped = MOST_REPEATS * size < F.lit(level) * weight
    target = F.least(MOST_REPEATS * size, F.lit(level) * weight)
    return weighed.select("source", "source_size", "lots", target.alias("target"))


def _reach(chances: np.ndarray, u: np.ndarray) -> tuple[float, float]:
    """How far the chances can move along ``u``, forward and back, within 0 and 1."""
    with np.errstate(divide="ignore", invalid="ignore"):
        up = np.where(u > 0, (1 - chances) / u, np.where(u < 0, -chances / u, np.inf))
        down = np.where(u > 0, chances / u, np.where(u < 0, (chances - 1) / u, np.inf))
    return float(up.min()), float(down.min())


def _step(chances: np.ndarray, u: np.ndarray, draw: random.Random) -> np.ndarray:
    """Move as far as possible along ``u`` or against it, so that chances stay unbiased."""
    forward, back = _reach(chances, u)
    moved = chances + (forward if draw.random() * (forward + back) < back else -back) * u
    moved[moved <= _EDGE] = 0.0
    moved[moved >= 1 - _EDGE] = 1.0
    return moved


def flight(sizes: list[int], chances: list[float], draw: random.Random) -> list[float]:
    """Move ``chances`` until at most two are neither 0 nor 1.

    No move changes the sum of chances or their sum weighted by size. The largest documents
    move first, each against all the others at once: against a few small ones a
    large document would hardly move and be left for the landing. The rest move
    in threes along the one direction that the two sums leave open.
    """
    size = np.array(sizes, np.float64)
    p = np.array(chances, np.float64)
    p[p <= _EDGE], p[p >= 1 - _EDGE] = 0.0, 1.0
    for i in np.argsort(-size, kind="stable")[:LARGEST]:
        while 0 < p[i] < 1:
            others = np.flatnonzero((p > 0) & (p < 1))
            others = others[others != i]
            if len(others) < 8:
                break
            s = size[others]
            moments = np.array([[len(s), s.sum()], [s.sum(), (s * s).sum()]])
            if np.linalg.matrix_rank(moments) < 2:
                break
            level, slope = np.linalg.solve(moments, [-1.0, -size[i]])
            open_ = np.append(others, i)
            p[open_] = _step(p[open_], np.append(level + slope * s, 1.0), draw)
    active: list[int] = []
    for i in range(len(p)):
        if 0 < p[i] < 1:
            active.append(i)
        if len(active) == 3:
            a, b, c = size[active]
            u = np.array([b - c, c - a, a - b])
            p[active] = _step(p[active], u if u.any() else np.array([1.0, -1.0, 0.0]), draw)
            active = [k for k in active if 0 < p[k] < 1]
    return p.tolist()


def landing(sizes: list[int], chances: list[float], draw: random.Random) -> list[float]:
    """Decide the few documents left, keeping the words' total until one is left."""
    p = np.array(chances, np.float64)
    while len(open_ := np.flatnonzero((p > 0) & (p < 1))) > 1:
        a, b = (float(sizes[i]) for i in open_[:2])
        p[open_[:2]] = _step(p[open_[:2]], np.array([b, -a] if a or b else [1.0, -1.0]), draw)
    for i in open_:
        p[i] = 1.0 if draw.random() < p[i] else 0.0
    return p.tolist()


_FLOWN = "source_key long, buckets long, uid long, id long, size long, chance double"


def _flights(frame: DataFrame, seed: int) -> DataFrame:
    """One flight in each (source, bucket); where a source has one bucket, also the landing."""

    def fly(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["uid", "id"], ignore_index=True)
        name = f"{seed},{group.source_key[0]},{group.bucket[0]}"
        draw = random.Random(zlib.crc32(name.encode()))
        order = [*range(len(group))]
        draw.shuffle(order)
        # Large documents first: one that stays fractional then meets others of nearly
        # its size, and those left for the landing are small.
        order.sort(key=lambda i: -group["size"][i])
        sizes = [int(group["size"][i]) for i in order]
        chances = flight(sizes, [float(group["chance"][i]) for i in order], draw)
        if group.buckets[0] == 1:
            chances = landing(sizes, chances, draw)
        out = group.drop(columns="bucket")
        out.loc[order, "chance"] = chances
        return out

    bucket = F.pmod(F.xxhash64(F.lit(seed), "uid"), F.col("buckets"))
    return (
        frame.withColumn("bucket", bucket)
        .groupBy("source_key", "bucket")
        .applyInPandas(fly, _FLOWN)
    )


def draw_balanced(documents: DataFrame, most_buckets: int, seed: int = 0) -> DataFrame:
    """uid, id, chosen: documents drawn with their chances, balanced within each source.

    ``documents`` has the columns of ``_FLOWN``; ``buckets`` is the source's number of
    flights, ``most_buckets`` the largest. At most two documents per bucket go on to
    the next level, until each source has one bucket left, which lands.
    """
    decided: list[DataFrame] = []
    current, level = documents, 0
    while True:
        flown = stage(_flights(current, seed + level))
        if most_buckets <= 1:
            decided.append(flown)
            break
        done = (F.col("chance") == 0) | (F.col("chance") == 1)
        decided.append(flown.where(done))
        current = flown.where(~done).withColumn(
            "buckets", F.ceil(2 * F.col("buckets") / F.lit(BUCKET))
        )
        most_buckets, level = math.ceil(2 * most_buckets / BUCKET), level + 1
    out = decided[0]
    for frame in decided[1:]:
        out = out.union(frame)
    return out.select("uid", "id", (F.col("chance") == 1).alias("chosen"))


def _sized(docs: DataFrame, id_column: str, text_column: str, source_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(whole_text(text_column)).alias("size"),
    )


def mix(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 0,
) -> DataFrame:
    """One row per distinct (doc_id, source, size): those, n, source_size, target, copies, taken.

    Rows alike in id, source and size (repeated rows) are one lot of ``n`` rows, mostly 1.
    ``copies`` is how often the lot's rows are taken together, the floor or the ceiling of n times
    target over source size, so one row is what the draw decides on; ``taken`` is the size times
    the copies. Of a lot's rows the first take one copy more than the others where the
    copies do not divide evenly. The draw depends
    on ids, sources and sizes only, never on the layout, so reruns agree. Null texts
    have size 0; a source without words has target 0 and no copies. An empty
    table gives no rows.
    """
    lots = stage(
        _sized(docs, id_column, text_column, source_column)
        .groupBy("doc_id", "source", "size")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("uid", F.xxhash64("doc_id", F.coalesce("source", F.lit("\0")), "size"))
        .withColumn("id", F.coalesce("doc_id", F.lit(0).cast("long")))
    )
    per_source = stage(
        lots.groupBy("source").agg(
            F.sum(F.col("size") * F.col("n")).alias("source_size"), F.count(F.lit(1)).alias("lots")
        )
    )
    number, largest = per_source.agg(F.count(F.lit(1)), F.max("lots")).first()
    targets = stage(source_targets(per_source))
    small = F.broadcast(targets) if number <= BROADCAST_SOURCES else targets
    repeats = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(
        0.0
    )
    rows = (
        lots.join(small, lots["source"].eqNullSafe(targets["source"]))
        .drop(targets["source"])
        .withColumn("wanted", repeats * F.col("n"))
        .withColumn("base", F.floor(F.col("wanted") + F.lit(_EDGE)))
        .withColumn("chance", F.greatest(F.col("wanted") - F.col("base"), F.lit(0.0)))
    )
    chosen = draw_balanced(
        rows.select(
            F.xxhash64(F.coalesce("source", F.lit("\0"))).alias("source_key"),
            F.ceil(F.col("lots") / F.lit(BUCKET)).alias("buckets"),
            "uid",
            "id",
            "size",
            "chance",
        ),
        math.ceil((largest or 0) / BUCKET),
        seed,
    )
    return (
        rows.join(chosen, ["uid", "id"])
        .withColumn("copies", F.col("base") + F.col("chosen").cast("long"))
        .select(
            "doc_id",
            "source",
            "size",
            "n",
            "source_size",
            "target",
            "copies",
            (F.col("size") * F.col("copies")).alias("taken"),
        )
    )


def taken_words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per input row: doc_id, size, source_size, target, taken."""
    return (
        mix(docs, seed=seed)
        .withColumn("place", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
        .withColumn("taken", F.col("size") * _copies_of("place"))
        .select("doc_id", "size", "source_size", "target", "taken")
    )


def _copies_of(place: str) -> Column:
    """Copies of the row at a place of its lot, counted from 0."""
    more = (F.col(place) < F.col("copies") % F.col("n")).cast("long")
    return F.floor(F.col("copies") / F.col("n")) + more


def _placed(rows: DataFrame) -> DataFrame:
    """Rows of lots with their ``place`` in the lot. A lot's rows are numbered in parts, as
    one lot may hold any share of the rows."""
    held = stage(rows.withColumn("part", F.pmod(F.monotonically_increasing_id(), F.lit(1024))), "lots")
    sizes = held.groupBy("lot", "part").agg(F.count(F.lit(1)).alias("size_of_part"))
    before = Window.partitionBy("lot").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.withColumn("offset", F.coalesce(F.sum("size_of_part").over(before), F.lit(0)))
    in_part = F.row_number().over(Window.partitionBy("lot", "part").orderBy(F.lit(0)))
    return (
        held.withColumn("in_part", in_part)
        .join(offsets, ["lot", "part"])
        .withColumn("place", F.col("in_part") - 1 + F.col("offset"))
    )


def mixed_documents(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
    seed: int = 0,
) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as the draw takes it, all columns kept."""
    drawn = mix(docs, id_column, text_column, source_column, seed).select(
        F.col("doc_id").alias("drawn_id"),
        F.col("source").alias("drawn_source"),
        F.col("size").alias("drawn_size"),
        "n",
        "copies",
    )
    packed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(source_column).cast("string").alias("source"),
        word_count(whole_text(text_column)).alias("size"),
        whole_row(docs).alias("row"),
    )
    joined = packed.join(
        drawn.where("copies > 0"),
        F.col("doc_id").eqNullSafe(F.col("drawn_id"))
        & F.col("source").eqNullSafe(F.col("drawn_source"))
        & (F.col("size") == F.col("drawn_size")),
    )
    single = joined.where("n = 1").select("row", "copies")
    repeated = joined.where("n > 1").select(
        F.struct("drawn_id", "drawn_source", "drawn_size").alias("lot"), "n", "copies", "row"
    )
    several = _placed(repeated).select("row", _copies_of("place").alias("copies"))
    return (
        single.union(several.where("copies > 0"))
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
        .select("row.*")
    )
