"""SimHash near-deduplication by the generalised pigeonhole principle.

If bits are partitioned and the partitions' thresholds sum to ``radius - partitions
+ 1``, two fingerprints within ``radius`` are within its threshold in at least
one partition (a threshold of -1 switches a partition off). Correlated bits share a
partition, as bits that say the same thing twice make values less selective when
spread. The thresholds that promise the fewest candidates are found by dynamic
programming over candidate counts estimated on the data.

Distinct fingerprints probe the partitions, meet those with an equal value within the
task of a bucket, and are verified on all bits. A bucket that holds more than
``BUCKET`` is not compared pair by pair: within it, fingerprints that differ in at
most two bits have a common neighbour at one bit or less, and a grouping
by all 65 neighbours of each finds exactly those, in linear work.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.columns import whole_row
from patronage.llm.components import components, star
from patronage.llm.scan import blocks
from patronage.session import stage

BITS = 64
#: Partitions of the bits.
PARTITIONS = 3
#: Distinct fingerprints of a bucket that are compared pair by pair.
BUCKET = 1_000
#: Fingerprints whose candidates are counted, over all others, to estimate costs.
PROBES = 256
#: Candidates that cost as much as one probe: a probe is a row that is shuffled and
#: sorted, a candidate one step of a vectorised comparison.
PROBE_COST = 100
#: Rows of a partition compared at once.
ROWS_AT_ONCE = 200_000
#: Overfull buckets up to this number are broadcast.
BROADCAST_BUCKETS = 100_000

_SIGN = 1 << 63


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= _SIGN else value


def fingerprints_of(texts: list[str | None], shingle: int = 3, seed: int = 42) -> np.ndarray:
    """The fingerprint of each text as an unsigned 64-bit number.

    A-Z is lower-cased, words are ``[^\\x20\\x09-\\x0D]+``, shingles are joined by one
    space and count as often as they occur; a text of fewer words is one shingle, one without
    words has fingerprint 0. A bit is set if it is set in more than half the hashes.
    """
    out = np.zeros(len(texts), np.uint64)
    digest = xxhash.xxh64_intdigest
    for i, text in enumerate(texts):
        parts = text.encode().lower().split() if text else []
        if not parts:
            continue
        whole = b" ".join(parts)
        sizes = np.fromiter(map(len, parts), np.int64, len(parts))
        begin = np.cumsum(sizes + 1) - sizes - 1
        n = max(len(parts) - shingle + 1, 1)
        last = min(shingle, len(parts)) - 1
        starts = begin[:n].tolist()
        ends = (begin + sizes)[last : last + n].tolist()
        count = np.zeros(BITS, np.int64)
        for at in range(0, n, 50_000):
            hashes = np.array(
                [
                    digest(whole[a:b], seed)
                    for a, b in zip(starts[at : at + 50_000], ends[at : at + 50_000], strict=True)
                ],
                np.uint64,
            )
            bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            count += bits.sum(axis=0, dtype=np.int64)
        out[i] = np.packbits(2 * count > n, bitorder="little").view(np.uint64)[0]
    return out


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """(doc_id, fp) of every row, ``fp`` the fingerprint's bits as a signed long."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text"):
                found = fingerprints_of(block.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"]
                )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return rows.mapInArrow(tasks, "doc_id long, fp long")


def _column(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def correlations(fps: DataFrame) -> np.ndarray:
    """The absolute correlation of each two bits over all fingerprints."""

    def tasks(batches):
        total = np.zeros((BITS + 1, BITS + 1), np.int64)
        for batch in batches:
            some = np.ascontiguousarray(_column(batch, "fp")).view(np.uint8).reshape(-1, 8)
            bits = np.ones((len(some), BITS + 1), np.float64)
            bits[:, :BITS] = np.unpackbits(some, axis=1, bitorder="little")
            total += (bits.T @ bits).astype(np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())],
            ["cell", "value"],
        )

    cells = fps.select("fp").mapInArrow(tasks, "cell int, value long").groupBy("cell")
    both = np.zeros((BITS + 1) ** 2)
    for row in cells.agg(F.sum("value").alias("value")).collect():
        both[row.cell] = row.value
    both = both.reshape(BITS + 1, BITS + 1)
    n = max(both[BITS, BITS], 1)
    mean = both[BITS, :BITS] / n
    spread = np.sqrt(np.maximum(mean * (1 - mean), 1e-12))
    out = np.abs((both[:BITS, :BITS] / n - np.outer(mean, mean)) / np.outer(spread, spread))
    np.fill_diagonal(out, 0)
    return out


def partition_bits(correlation: np.ndarray, partitions: int) -> list[list[int]]:
    """Groups of nearly equal size, each grown from the bit most correlated with the rest."""
    free, groups = set(range(BITS)), []
    for g in range(partitions):
        size = -(-len(free) // (partitions - g))
        rest = sorted(free)
        group = [rest[int(np.argmax(correlation[np.ix_(rest, rest)].sum(axis=1)))]]
        free.discard(group[0])
        while len(group) < size:
            rest = sorted(free)
            group.append(rest[int(np.argmax(correlation[np.ix_(rest, group)].sum(axis=1)))])
            free.discard(group[-1])
        groups.append(sorted(group))
    return groups


def _mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def candidate_counts(fps: DataFrame, groups: list[list[int]], radius: int) -> np.ndarray:
    """Estimated candidates by partition and threshold: counted over all for some probes.

    The probes are the ``PROBES`` fingerprints with the smallest hashes.
    """
    probes = [
        row.fp
        for row in fps.select("fp").orderBy(F.xxhash64(F.lit(1), "fp"), "fp").limit(PROBES).collect()
    ]
    masks = [_mask(g) for g in groups]
    cells = len(groups) * (radius + 1)

    def tasks(batches):
        total, asked = np.zeros(cells, np.int64), np.array(probes, np.int64).view(np.uint64)
        for batch in batches:
            held = np.ascontiguousarray(_column(batch, "fp")).view(np.uint64)
            for at in range(0, len(held), 5_000):
                apart = held[at : at + 5_000, None] ^ asked[None, :]
                for g, mask in enumerate(masks):
                    distance = np.bitwise_count(apart & np.uint64(mask))
                    for e in range(radius + 1):
                        total[g * (radius + 1) + e] += np.count_nonzero(distance <= e)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(cells, dtype=np.int32)), pa.array(total)], ["cell", "value"]
        )

    out = np.zeros(cells)
    counted = fps.select("fp").mapInArrow(tasks, "cell int, value long").groupBy("cell")
    for row in counted.agg(F.sum("value").alias("value")).collect():
        out[row.cell] = row.value
    return out.reshape(len(groups), radius + 1) / max(len(probes), 1)


def variants(bits: list[int], threshold: int) -> list[int]:
    """All changes of at most ``threshold`` of the bits, as masks."""
    return [
        _signed(_mask(list(some)))
        for k in range(threshold + 1)
        for some in combinations(bits, k)
    ]


def allocate(groups: list[list[int]], candidates: np.ndarray, radius: int) -> list[int]:
    """Thresholds of least cost that sum to ``radius - partitions + 1``, each -1 at least.

    The cost of a partition is its number of candidates per fingerprint and, ``PROBE_COST`` each,
    of probes; -1 costs nothing. Solved partition by partition, by the sum so far.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for bits, counts in zip(groups, candidates, strict=True):
        longer: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for e in range(-1, radius + 1):
                more = 0.0 if e < 0 else PROBE_COST * len(variants(bits, e)) + float(counts[e])
                found = (cost + more, [*chosen, e])
                if total + e not in longer or found < longer[total + e]:
                    longer[total + e] = found
        best = longer
    return best[radius - len(groups) + 1][1]


def verified(radius: int):
    """For rows (bucket, fp) sorted by bucket: links within ``radius``, at most one per value."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0

        def linked(bucket: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            ends = np.append(np.flatnonzero(np.diff(bucket)) + 1, len(bucket))
            end = np.repeat(ends, np.diff(ends, prepend=0)) if len(ends) else ends
            at, step = np.arange(len(bucket)), 1
            a, b = [], []
            while True:
                at = at[at + step < end[at]]
                if not len(at):
                    break
                near = at[np.bitwise_count(fp[at] ^ fp[at + step]) <= radius]
                a.append(near)
                b.append(near + step)
                step += 1
            none = np.zeros(0, np.int64)
            nodes, roots = star(
                fp.view(np.int64), np.concatenate([*a, none]), np.concatenate([*b, none])
            )
            return pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(roots)], ["a", "b"])

        def work(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal held, rows
            table = pa.Table.from_batches(held).combine_chunks()
            bucket = table.column("bucket").to_numpy()
            cut = len(bucket) if last else int(np.searchsorted(bucket, bucket[-1]))
            fp = np.ascontiguousarray(table.column("fp").to_numpy()).view(np.uint64)
            if cut:
                yield linked(bucket[:cut], fp[:cut])
            rest = table.slice(cut)
            held, rows = rest.to_batches(), len(rest)

        for batch in batches:
            if len(batch):
                held.append(batch)
                rows += len(batch)
                if rows > ROWS_AT_ONCE:
                    yield from work(False)
        if rows:
            yield from work(True)

    return tasks


def links(fps: DataFrame, radius: int = 2, partitions: int = PARTITIONS) -> DataFrame:
    """Links (a, b) that connect exactly the fingerprints connected by steps within ``radius``.

    ``fps`` is a staged frame of distinct ``fp``. Not every close pair has a link of its
    own: within a task, linked values are reduced to one link each.
    """
    if not 0 <= radius <= 2:
        raise ValueError("the way for overfull buckets is exact up to two differing bits")
    groups = partition_bits(correlations(fps), partitions)
    thresholds = allocate(groups, candidate_counts(fps, groups, radius), radius)
    probes = None
    for g, (bits, threshold) in enumerate(zip(groups, thresholds, strict=True)):
        if threshold < 0:
            continue
        value = F.col("fp").bitwiseAND(F.lit(_signed(_mask(bits))))
        changes = F.array(*[F.lit(v) for v in variants(bits, threshold)])
        rows = fps.select("fp", value.alias("value"), F.explode(changes).alias("change")).select(
            F.lit(g).alias("part"), F.col("value").bitwiseXOR(F.col("change")).alias("key"), "fp"
        )
        probes = rows if probes is None else probes.union(rows)
    counted = stage(
        probes.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets"
    )
    overfull = counted.where(F.col("n") > BUCKET).select("part", "key")
    number = overfull.count()
    compared = counted.where(F.col("n") <= BUCKET).select(
        "part", "key", F.monotonically_increasing_id().alias("bucket")
    )
    pairs = (
        probes.join(compared, ["part", "key"])
        .select("bucket", "fp")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(verified(radius), "a long, b long")
    )
    if not number:
        return pairs
    small = F.broadcast(overfull) if number <= BROADCAST_BUCKETS else overfull
    crowded = probes.join(small, ["part", "key"], "left_semi").select("fp").distinct()
    around = F.array(*[F.lit(v) for v in variants([*range(BITS)], 1)])
    shared = (
        crowded.select("fp", F.explode(around).alias("change"))
        .groupBy(F.col("fp").bitwiseXOR(F.col("change")).alias("around"))
        .agg(F.collect_list("fp").alias("fps"))  # of distinct values, 65 at most
        .where(F.size("fps") > 1)
        .select(F.explode("fps").alias("a"), F.array_min("fps").alias("b"))
        .where("a <> b")
    )
    return pairs.union(shared.distinct())


def near_groups(
    docs: DataFrame, radius: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hexadecimal digits), component_id.

    ``component_id`` is the smallest id reachable over links between fingerprints of at
    most ``radius`` differing bits. Null and empty texts have fingerprint 0 and link
    like any other. Repeated rows share a fingerprint; null ids are never the
    smallest unless alone. An empty table gives no rows.
    """
    marked = stage(fingerprints(docs, id_column, text_column), "fingerprints")
    fps = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct")
    found = stage(components(links(fps, radius)), "components")
    placed = stage(
        fps.join(found, fps["fp"] == found["node"], "left").select(
            "fp", "first_id", F.coalesce("component", "fp").alias("component")
        ),
        "placed",
    )
    smallest = stage(
        placed.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest"
    )
    named = stage(placed.join(smallest, "component").select("fp", "component_id"), "named")
    return marked.join(named, "fp").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def deduplicate(
    docs: DataFrame, radius: int = 2, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its group, all columns kept.

    Rows that repeat that id all stay; a group of null ids alone stays whole.
    """
    kept = near_groups(docs, radius, id_column, text_column).where(
        F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
    names = kept.select(F.col("doc_id").alias("kept_id")).distinct()
    packed = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        whole_row(docs).alias("row"),
    )
    return packed.join(
        names, F.col("doc_id").eqNullSafe(F.col("kept_id")), "left_semi"
    ).select("row.*")
