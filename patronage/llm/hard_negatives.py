"""Hard negatives for anchors, by exact integer inner products from subset-sum tables.

Vectors are integers. For each anchor and each eight of its components a table holds the
sums of all 256 subsets. A candidate is packed once: bit plane b of eight components is one byte,
which is the place of that plane's partial sum in the table. A score is the sum over planes of the
looked-up values, each plane shifted to its weight and the sign plane subtracted, so scores are
exact. Anchors' tables lie side by side, so that one byte looks up a whole block of anchors.

Anchors meet candidates in blocks: candidates are cut into groups that a task holds, anchors stream
past them, and only each group's best rows of an anchor are shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from patronage.session import stage

#: Candidates that a task holds at once.
HELD = 8_000
#: Anchors of a block whose tables are built at once, and the table entries of a block at most.
ANCHORS = 128
ENTRIES = 1 << 21
#: Candidates scored at once.
SCORED = 1_000

_SUBSETS = (np.arange(256)[:, None] >> np.arange(8) & 1).astype(np.int64)
_LEAST = np.iinfo(np.int64).min


def planes_needed(largest: int) -> int:
    """Bits of two's complement that hold every component between -largest and largest."""
    return min(int(largest).bit_length() + 1, 64)


def pack(x: np.ndarray, planes: int) -> np.ndarray:
    """Bit planes of integer vectors in bytes: (vector, plane, group of eight components)."""
    n, width = x.shape
    groups = -(-width // 8)
    eight = np.pad(x, ((0, 0), (0, groups * 8 - width))).reshape(n, groups, 8)
    weights = (1 << np.arange(8)).astype(np.uint8)
    out = np.empty((n, planes, groups), np.uint8)
    for b in range(planes):
        out[:, b] = ((eight >> b & 1).astype(np.uint8) * weights).sum(axis=2, dtype=np.uint8)
    return out


def tables(anchors: np.ndarray) -> np.ndarray:
    """Subset sums: (group of eight components, subset, anchor)."""
    n, width = anchors.shape
    groups = -(-width // 8)
    eight = np.pad(anchors, ((0, 0), (0, groups * 8 - width))).reshape(n, groups, 8)
    sums = np.einsum("agi,mi->gma", eight, _SUBSETS)
    small = groups and np.abs(eight).max(initial=0) < 1 << 23
    return sums.astype(np.int32) if small else sums


def scores(table: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """Exact inner products (vector, anchor) of packed vectors with the tables' anchors.

    They are sums of longs: exact while they fit 64 bits, wrapping around beyond.
    """
    n, planes, groups = packed.shape
    total = np.zeros((n, table.shape[2]), np.int64)
    for b in range(planes - 1, -1, -1):  # from the sign plane down, doubling on the way
        plane = np.zeros((n, table.shape[2]), np.int64)
        for g in range(groups):
            plane += table[g].take(packed[:, b, g], axis=0)
        total += total
        if b == planes - 1:
            total -= plane
        else:
            total += plane
    return total


def best(values: np.ndarray, allowed: np.ndarray, n: int) -> list[np.ndarray]:
    """For each row of ``values``: places of the ``n`` largest allowed ones, larger first, ties
    by smaller place."""
    out = []
    for row, mask in zip(values, allowed, strict=True):
        place = np.flatnonzero(mask)
        some = row[place]
        if len(some) > n:
            least = np.partition(some, len(some) - n)[len(some) - n]
            above = np.flatnonzero(some > least)
            equal = np.flatnonzero(some == least)[: n - len(above)]
            chosen = np.concatenate([above, equal])
            place, some = place[chosen], some[chosen]
        out.append(place[np.lexsort((place, -some.astype(object) if _wide(some) else -some))])
    return out


def _wide(values: np.ndarray) -> bool:
    return bool((values == _LEAST).any())


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return x.reshape(len(batch), len(x) // max(len(batch), 1)).astype(np.int64)


def _blocked(
    candidates: DataFrame,
    anchors: DataFrame,
    keys: list[str],
    found: Callable,
    schema: str,
    planes: int,
) -> DataFrame:
    """``found`` over all anchors and candidates with equal ``keys``.

    ``candidates`` (*keys, uid, vec_id, label, x) and ``anchors`` (*keys, uid, label, x, and what
    ``found`` reads). Candidates of a key are cut into groups of ``HELD`` by a hash; anchors
    go to every group of their key.
    """
    sized = candidates.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    groups = sized.select(*keys, F.ceil(F.col("size") / HELD).cast("int").alias("groups"))
    asking = [c for c in anchors.columns if c not in candidates.columns]
    held = candidates.join(groups, keys).select(
        *keys,
        F.pmod(F.xxhash64("uid"), F.col("groups")).cast("int").alias("part"),
        F.lit(0).alias("role"),
        *[c for c in candidates.columns if c not in keys],
    )
    streamed = anchors.join(groups, keys).select(
        *keys,
        F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("part"),
        F.lit(1).alias("role"),
        *[c for c in anchors.columns if c not in keys],
    )
    schema_of = dict(anchors.dtypes)
    for c in asking:
        held = held.withColumn(c, F.lit(None).cast(schema_of[c]))
    both = (
        held.unionByName(streamed, allowMissingColumns=True)
        .withColumn("block", F.xxhash64(*keys, "part"))
        .repartition("block")
        .sortWithinPartitions("block", *keys, "part", "role", "vec_id", "uid")
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, waiting, packed, group = None, [], None, None
        for batch in batches:
            if not len(batch):
                continue
            places = list(
                zip(*(batch.column(c).to_pylist() for c in [*keys, "part", "role"]), strict=True)
            )
            cuts = [i for i in range(1, len(batch)) if places[i] != places[i - 1]]
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                *now, role = places[lo]
                part = batch.slice(lo, hi - lo)
                if now != key:
                    key, waiting, packed, group = now, [], None, None
                if role == 0:
                    waiting.append(part)
                    continue
                if packed is None:
                    group = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
                    waiting = []
                    packed = pack(_matrix(group), planes)
                width = max(packed.shape[2], 1)
                step = max(1, min(ANCHORS, ENTRIES // (256 * width)))
                for at in range(0, len(part), step):
                    some = part.slice(at, step)
                    table = tables(_matrix(some))
                    values = [
                        scores(table, packed[i : i + SCORED])
                        for i in range(0, len(packed), SCORED)
                    ]
                    yield found(some, group, np.concatenate(values).T)

    return both.mapInArrow(tasks, schema)


def _batch(columns: dict[str, list], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    arrays = [
        pa.array(np.concatenate(values) if values else [], kinds[name])
        for name, values in columns.items()
    ]
    return pa.RecordBatch.from_arrays(arrays, list(columns))


def _positives(n: int) -> Callable:
    def found(anchors: pa.RecordBatch, group: pa.RecordBatch, values: np.ndarray) -> pa.RecordBatch:
        own, uids = anchors.column("uid").to_numpy(), group.column("uid").to_numpy()
        ids = group.column("vec_id").to_numpy()
        out = {c: [] for c in ("anchor", "uid", "id", "score")}
        for i, chosen in enumerate(best(values, uids != own[:, None], n)):
            out["anchor"].append(np.full(len(chosen), own[i]))
            out["uid"].append(uids[chosen])
            out["id"].append(ids[chosen])
            out["score"].append(values[i, chosen])
        return _batch(out, dict.fromkeys(out, pa.int64()))

    return found


def _negatives(n: int, low: int, high: int) -> Callable:
    def found(anchors: pa.RecordBatch, group: pa.RecordBatch, values: np.ndarray) -> pa.RecordBatch:
        own, ids = anchors.column("uid").to_numpy(), group.column("vec_id").to_numpy()
        uids = group.column("uid").to_numpy()
        other = group.column("label").to_numpy() != anchors.column("label").to_numpy()[:, None]
        out = {c: [] for c in ("anchor", "positive", "id", "uid", "score")}
        for i, positives in enumerate(anchors.column("positives").to_pylist()):
            place = np.flatnonzero(other[i])
            row = values[i, place]
            for positive in positives:
                # Whole bounds of the score, in Python's unbounded integers.
                least, most = -(-low * positive["score"] // 100), high * positive["score"] // 100
                if least > most:
                    continue
                allowed = (row >= max(least, _LEAST)) & (row <= min(most, -(_LEAST + 1)))
                chosen = place[best(row[None], allowed[None], n)[0]]
                out["anchor"].append(np.full(len(chosen), own[i]))
                out["positive"].append(np.full(len(chosen), positive["uid"]))
                out["id"].append(ids[chosen])
                out["uid"].append(uids[chosen])
                out["score"].append(values[i, chosen])
        return _batch(out, dict.fromkeys(out, pa.int64()))

    return found


def _first(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    """The first ``n`` rows of each key by larger score, then smaller id, numbered from 1."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id", "uid")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def whole_components(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component in double precision; null if the vector or any
    component is null or not finite. Beyond 64 bits they are the nearest long."""
    x = F.transform(vector, lambda v: v.cast("double"))
    finite = F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    )
    return F.when(F.coalesce(finite, F.lit(False)), F.transform(x, lambda v: F.floor(v * scale)))


def hard_negatives(
    vectors: DataFrame,
    every: int = 100,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose id is divisible by ``every``; an anchor's positives are its
    ``positives`` best other rows of the same label, and for each of them the ``negatives`` best rows of
    another label whose score is between ``low`` and ``high`` percent of the positive's. Scores
    are inner products of the components' floor(256 * x); larger ones come first, ties by
    smaller id.

    Rows with a null id, label or vector, or a null or non-finite component take no part. A repeated row
    is a row of its own: it may be the positive of its copy, and each copy of an anchor is an anchor.
    Only vectors of one length are compared; empty ones score 0. Scores are longs, exact
    while they fit 64 bits. An empty table gives no rows; other columns are not read.
    """
    x = whole_components(F.col(vector_column))
    used = stage(
        vectors.select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.col(label_column).cast("long").alias("label"),
            x.alias("x"),
        )
        .where("vec_id IS NOT NULL AND label IS NOT NULL AND x IS NOT NULL")
        .withColumns({"uid": F.monotonically_increasing_id(), "width": F.size("x")}),
        "vectors",
    )
    edges = used.agg(
        F.min(F.array_min("x")).alias("least"), F.max(F.array_max("x")).alias("most")
    ).first()
    planes = planes_needed(max(-(edges.least or 0), edges.most or 0))
    anchors = used.where(F.col("vec_id") % every == 0)
    near = _blocked(
        used,
        anchors,
        ["width", "label"],
        _positives(positives),
        "anchor long, uid long, id long, score long",
        planes,
    )
    chosen = stage(
        _first(near, ["anchor"], positives).drop("rank"), "positives"
    )  # at most ``positives`` rows an anchor
    asking = anchors.join(
        chosen.groupBy(F.col("anchor").alias("uid")).agg(
            F.collect_list(F.struct("uid", "score")).alias("positives")
        ),
        "uid",
    )
    hard = _blocked(
        used,
        asking,
        ["width"],
        _negatives(negatives, low, high),
        "anchor long, positive long, id long, uid long, score long",
        planes,
    )
    ranked = stage(_first(hard, ["anchor", "positive"], negatives), "negatives")
    ids = anchors.select(F.col("uid").alias("anchor"), F.col("vec_id").alias("anchor_id"))
    named = chosen.select(
        "anchor",
        F.col("uid").alias("positive"),
        F.col("id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        ranked.withColumnsRenamed({"id": "negative_id", "score": "negative_score"})
        .join(named, ["anchor", "positive"])
        .join(ids, "anchor")
        .select(
            "anchor_id",
            "positive_id",
            F.col("rank").cast("int").alias("rank"),
            "negative_id",
            "positive_score",
            "negative_score",
        )
    )
