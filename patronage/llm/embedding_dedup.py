"""Near-duplicate vectors by product quantisation.

Vectors go to inverted lists by their nearest coarse centroid, and each one's
residual is coded subspace by subspace. A vector probes every list that can hold a
vector it links with: a list's vectors are nearer to its centroid than to the
vector's own, so the list is out of reach only if the plane between the two centroids is.
A vector's distances to the subspaces' codewords are tabulated once per list, and sums
of table entries estimate its distance to every vector of the list. An estimate is off
by no more than the coded vector's quantisation error, which is stored with it, so no
pair is lost to the estimate either; what passes is compared exactly.

Centroids and codewords are fitted to a bounded sample without its near copies; every vector is indexed. Equal
vectors are indexed once. Neighbouring lists are bundled, so that a vector is sent once to
a bundle whatever number of its lists it probes; bundles and their probes are
cut into blocks of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.components import components, star
from patronage.session import stage

#: Vectors that centroids and codewords are fitted to: those with the smallest hashes.
SAMPLE = 20_000
#: Vectors per list, as far as ``MOST_LISTS`` allows.
LIST_SIZE = 200
MOST_LISTS = 4_096
#: Nearest lists that the registered query probes.
PROBES = 8
#: Subspaces and codewords of each.
SUBSPACES = 8
CODEWORDS = 64
#: Indexed vectors and probing vectors that meet in one block.
BLOCK_INDEXED = 2_000
BLOCK_PROBING = 4_000

#: Components of vectors gathered at once to be compared exactly.
GATHERED = 4_000_000

_EXTRA = 1e-6


@dataclass(frozen=True)
class Quantiser:
    """Coarse centroids and, per subspace, codewords of residuals."""

    centroids: np.ndarray
    codewords: np.ndarray  # (subspace, codeword, dimension of the subspace)

    def lists(self, x: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` nearest lists of each vector, nearest first."""
        near = (self.centroids**2).sum(axis=1) - 2 * (x @ self.centroids.T)
        n = min(n, len(self.centroids))
        if n == len(self.centroids):
            return np.argsort(near, axis=1, kind="stable")
        some = np.argpartition(near, n - 1, axis=1)[:, :n]
        order = np.argsort(np.take_along_axis(near, some, axis=1), axis=1, kind="stable")
        return np.take_along_axis(some, order, axis=1)

    def probed(self, x: np.ndarray, reach: float, probes: int | None = None) -> np.ndarray:
        """Which lists (columns) each vector probes: all that hold a vector within ``reach``,
        or with ``probes`` so many of the nearest."""
        if probes is not None:
            out = np.zeros((len(x), len(self.centroids)), bool)
            np.put_along_axis(out, self.lists(x, probes), True, axis=1)
            return out
        squares = (self.centroids**2).sum(axis=1)
        near = squares - 2 * (x @ self.centroids.T)
        own = near.argmin(axis=1)
        between = squares[own][:, None] + squares - 2 * (self.centroids[own] @ self.centroids.T)
        beyond = near - near[np.arange(len(x)), own][:, None]
        return beyond <= 2 * (reach + _EXTRA) * np.sqrt(np.maximum(between, 0)) + _EXTRA

    def parts(self, x: np.ndarray) -> np.ndarray:
        """Vectors cut into subspaces, the last filled up with zeros: (n, subspace, dimension)."""
        spaces, _, width = self.codewords.shape
        return np.pad(x, ((0, 0), (0, spaces * width - x.shape[1]))).reshape(len(x), spaces, width)

    def tables(self, residuals: np.ndarray) -> np.ndarray:
        """Squared distances of each residual's parts to the codewords: (n, subspace, codeword)."""
        parts = self.parts(residuals)
        cross = np.einsum("nsd,scd->nsc", parts, self.codewords)
        own = (parts**2).sum(axis=2)[:, :, None]
        return own + (self.codewords**2).sum(axis=2)[None] - 2 * cross

    def encode(self, residuals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the quantisation error (a distance) of each."""
        tables = self.tables(residuals)
        codes = tables.argmin(axis=2)
        error = np.take_along_axis(tables, codes[:, :, None], axis=2).sum(axis=(1, 2))
        return codes.astype(np.uint8), np.sqrt(np.maximum(error, 0))


def _kmeans(x: np.ndarray, k: int, rounds: int, seed: int) -> np.ndarray:
    draw = np.random.default_rng(seed)
    centres = x[draw.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.empty(len(x), np.int64)
        for at in range(0, len(x), 4_000):
            some = x[at : at + 4_000]
            nearest[at : at + 4_000] = (
                (centres**2).sum(axis=1) - 2 * (some @ centres.T)
            ).argmin(axis=1)
        counts = np.bincount(nearest, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, x)
        full = counts > 0
        centres[full] = sums[full] / counts[full, None]
    return centres


def thinned(sample: np.ndarray, cosine: float) -> np.ndarray:
    """The vectors of a sample, without those within ``cosine`` of an earlier one that is kept.

    A dense group of near copies thus counts as a few vectors and gets few centroids, whatever
    share of the sample it holds.
    """
    kept = np.zeros((0, sample.shape[1]))
    for at in range(0, len(sample), 500):
        some = sample[at : at + 500]
        some = some[~(some @ kept.T >= cosine).any(axis=1)] if len(kept) else some
        near = np.tril(some @ some.T >= cosine, -1)
        alone = np.ones(len(some), bool)
        for i in np.flatnonzero(near.any(axis=1)):
            alone[i] = not (near[i] & alone).any()
        kept = np.concatenate([kept, some[alone]])
    return kept


def fit(sample: np.ndarray, lists: int, seed: int = 0) -> Quantiser:
    """A quantiser of unit vectors."""
    centroids = _kmeans(sample, lists, 8, seed)
    near = Quantiser(centroids, np.zeros((1, 1, sample.shape[1]))).lists(sample, 1)[:, 0]
    residuals = sample - centroids[near]
    spaces = min(SUBSPACES, sample.shape[1])
    width = -(-sample.shape[1] // spaces)
    shaped = Quantiser(centroids, np.zeros((spaces, 1, width))).parts(residuals)
    words = min(CODEWORDS, len(sample))
    return Quantiser(
        centroids, np.stack([_kmeans(shaped[:, s], words, 8, seed + s) for s in range(spaces)])
    )


def _vectors(batch: pa.RecordBatch, name: str) -> np.ndarray:
    """Raw little-endian doubles of a binary column as a matrix."""
    return np.stack([np.frombuffer(value.as_py(), "<f8") for value in batch.column(name)])


def _raw(x: np.ndarray) -> pa.Array:
    return pa.array([row.tobytes() for row in np.ascontiguousarray(x)], pa.binary())


def distinct_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> tuple:
    """Rows (vec_id, k1, k2) and their distinct comparable vectors (k1, k2, first_id, weight, unit).

    ``k1`` and ``k2`` are two 64-bit hashes of the components, which stand for the vector;
    null where it is null, empty, zero, or has a null or non-finite component.
    """
    x = F.transform(F.col(vector_column), lambda v: v.cast("double"))
    finite = F.forall(
        x, lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))
    )
    usable = F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))
    rows = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.when(usable, x).alias("x")
    ).withColumns(
        {
            "k1": F.when(F.col("x").isNotNull(), F.xxhash64("x")),
            "k2": F.when(F.col("x").isNotNull(), F.xxhash64(F.lit(1), "x")),
        }
    )
    grouped = (
        rows.where("k1 IS NOT NULL")
        .groupBy("k1", "k2")
        .agg(
            F.min("vec_id").alias("first_id"),
            F.count(F.lit(1)).alias("weight"),
            F.any_value("x").alias("x"),
        )
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for value in batch.column("x"):
                v = np.array(value.as_py(), np.float64)
                v = v / np.abs(v).max()
                units.append((v / np.sqrt((v * v).sum())).astype("<f8").tobytes())
            yield batch.drop_columns("x").append_column("unit", pa.array(units, pa.binary()))

    kind = "k1 long, k2 long, first_id long, weight long, unit binary"
    named = grouped.mapInArrow(tasks, kind).withColumn("uid", F.monotonically_increasing_id())
    return rows.select("vec_id", "k1", "k2"), stage(named, "vectors")


def _index(vectors: DataFrame, quantiser: Quantiser) -> DataFrame:
    """Each vector with its own list, codes and their error."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                x = _vectors(batch, "unit")
                own = quantiser.lists(x, 1)[:, 0]
                codes, error = quantiser.encode(x - quantiser.centroids[own])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own.astype(np.int32)),
                        *batch.columns,
                        pa.array([c.tobytes() for c in codes], pa.binary()),
                        pa.array(error),
                    ],
                    names=["list", *batch.schema.names, "codes", "error"],
                )

    return vectors.select("uid", "weight", "unit").mapInArrow(
        tasks, "list int, uid long, weight long, unit binary, codes binary, error double"
    )


def bundles(centroids: np.ndarray, sizes: np.ndarray, limit: int) -> list[list[int]]:
    """Lists that hold vectors, bundled along a chain of near centroids.

    A bundle has ``limit`` vectors at most, or is a single list.
    """
    left, out, room = np.flatnonzero(sizes), [], -1
    at = centroids[left].mean(axis=0) if len(left) else None
    while len(left):
        i = int(((centroids[left] - at) ** 2).sum(axis=1).argmin())
        number = int(left[i])
        left, at = np.delete(left, i), centroids[number]
        if sizes[number] > room:
            out.append([])
            room = limit
        out[-1].append(number)
        room -= sizes[number]
    return out


def _probes(
    vectors: DataFrame, quantiser: Quantiser, bundled: list[list[int]], reach: float, probes
) -> tuple[DataFrame, DataFrame]:
    """One row per vector and bundle that it probes, with the probed lists; and their
    numbers (bundle, n), one row per batch."""
    lists = np.array([n for some in bundled for n in some], np.int32)
    bundle = np.repeat(np.arange(len(bundled)), [len(some) for some in bundled])

    def pieces(batches: Iterator[pa.RecordBatch]):
        for whole in batches:
            for at in range(0, len(whole), 500):
                batch = whole.slice(at, 500)
                probed = quantiser.probed(_vectors(batch, "unit"), reach, probes)
                row, place = np.nonzero(probed[:, lists])
                cuts = np.flatnonzero((np.diff(row) != 0) | (np.diff(bundle[place]) != 0)) + 1
                yield batch, row, place, np.append(0, cuts) if len(row) else cuts

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, row, place, starts in pieces(batches):
            ends = np.append(starts[1:], len(row))
            taken = pa.array(row[starts])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(bundle[place[starts]].astype(np.int32)),
                    batch.column("uid").take(taken),
                    batch.column("unit").take(taken),
                    pa.array(
                        [
                            lists[place[i:j]].tobytes()
                            for i, j in zip(starts.tolist(), ends.tolist(), strict=True)
                        ],
                        pa.binary(),
                    ),
                ],
                names=["bundle", "uid", "unit", "lists"],
            )

    def counting(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(bundled), np.int64)
        for _, _, place, starts in pieces(batches):
            total += np.bincount(bundle[place[starts]], minlength=len(bundled))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(bundled), dtype=np.int32)), pa.array(total)], ["bundle", "n"]
        )

    own = vectors.select("uid", "unit")
    return (
        own.mapInArrow(tasks, "bundle int, uid long, unit binary, lists binary"),
        own.mapInArrow(counting, "bundle int, n long"),
    )


def _compare(quantiser: Quantiser, cosine: float, reach: float):
    """Over rows sorted by block and role: (uid, other, n), the weight of the vectors that ``uid``
    links with, and in rows with ``n`` null a link that keeps components together."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held, index = None, [], None

        def linked(x: np.ndarray, number: int, units, codes, errors) -> tuple:
            """Places (in x, in the list) of linked vectors."""
            tables = quantiser.tables(x - quantiser.centroids[number])
            estimate = np.zeros((len(x), len(units)))
            for s in range(codes.shape[1]):
                estimate += tables[:, s][:, codes[:, s]]
            i, j = np.nonzero(np.sqrt(np.maximum(estimate, 0)) <= reach + errors + _EXTRA)
            step = max(1, GATHERED // x.shape[1])
            good = [
                np.einsum("nd,nd->n", x[i[k : k + step]], units[j[k : k + step]]) >= cosine
                for k in range(0, len(i), step)
            ]
            good = np.concatenate([*good, np.zeros(0, bool)])
            return i[good], j[good]

        def against(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            uids, weights, units, codes, errors, numbers, starts = index
            for at in range(0, len(rows), 500):
                some = rows.slice(at, 500)
                x = _vectors(some, "unit")
                lists = [np.frombuffer(v.as_py(), np.int32) for v in some.column("lists")]
                row = np.repeat(np.arange(len(x)), [*map(len, lists)])
                lists = np.concatenate(lists)
                own = some.column("uid").to_numpy()
                counts = np.zeros(len(x))
                first, second = [], []
                for number, lo, hi in zip(numbers, starts[:-1], starts[1:], strict=True):
                    asking = row[lists == number]
                    step = max(1, 400_000 // (hi - lo))
                    for k in range(0, len(asking), step):
                        part = asking[k : k + step]
                        i, j = linked(x[part], number, units[lo:hi], codes[lo:hi], errors[lo:hi])
                        i, j = part[i], lo + j
                        counts += np.bincount(i, weights[j], len(x))
                        value, root = star(np.concatenate([own, uids]), i, len(own) + j)
                        first.append(value)
                        second.append(root)
                none = np.zeros(0, np.int64)
                a, b = np.concatenate([*first, none]), np.concatenate([*second, none])
                if len(first) > 1:
                    a, b = star(np.concatenate([a, b]), np.arange(len(a)), len(a) + np.arange(len(a)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.concatenate([own, a])),
                        pa.array(np.concatenate([own, b])),
                        pa.array([*counts.astype(np.int64).tolist(), *[None] * len(a)], pa.int64()),
                    ],
                    ["uid", "other", "n"],
                )

        def built() -> tuple:
            table = pa.Table.from_batches(held).sort_by("list").combine_chunks().to_batches()[0]
            codes = np.stack([np.frombuffer(c.as_py(), np.uint8) for c in table.column("codes")])
            lists = table.column("list").to_numpy()
            starts = np.flatnonzero(np.diff(lists, prepend=-1))
            return (
                table.column("uid").to_numpy(),
                table.column("weight").to_numpy(),
                _vectors(table, "unit"),
                codes,
                table.column("error").to_numpy(),
                lists[starts].tolist(),
                [*starts.tolist(), len(lists)],
            )

        for batch in batches:
            blocks = batch.column("block").to_numpy()
            roles = batch.column("role").to_numpy()
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(roles) != 0)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(batch)], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(int(lo), int(hi - lo))
                if blocks[lo] != block:
                    block, held, index = blocks[lo], [], None
                if roles[lo] == 0:
                    held.append(part)
                elif held:
                    index = index or built()
                    yield from against(part)

    return tasks


def near_vectors(
    vectors: DataFrame,
    cosine: float = 0.95,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    probes: int | None = None,
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors link at a cosine of ``cosine`` or more, in double precision. ``n_links`` counts the
    other rows linked directly, repeated and equal ones included; ``component_id`` is the smallest
    id reachable; ``kept`` says whether it is the row's own. A vector that is
    null, empty, zero, or has a null or non-finite component links with nothing.
    Only vectors of one length are comparable; each length has its own
    index. Every pair is found, unless ``probes`` asks for so many of
    the nearest lists only.
    """
    rows, named = distinct_vectors(vectors, id_column, vector_column)
    lengths = [
        row[0] for row in named.select(F.octet_length("unit")).distinct().collect()
    ]  # one per dimension of the data
    reach = math.sqrt(max(2 - 2 * cosine, 0))
    counted, linked = None, None
    for length in sorted(lengths):
        own = named.where(F.octet_length("unit") == length)
        number = own.count()
        chosen = (
            own.select("k1", "k2").orderBy("k1", "k2").limit(sample).agg(F.max("k1")).first()[0]
        )
        drawn = own.where(F.col("k1") <= chosen).orderBy("k1", "k2").select("unit").limit(sample)
        x = np.stack([np.frombuffer(bytes(row.unit), "<f8") for row in drawn.collect()])
        x = thinned(x, cosine)
        lists = max(1, min(MOST_LISTS, number // LIST_SIZE, len(x)))
        quantiser = fit(x, lists)
        indexed = stage(_index(own, quantiser), "index")
        held = np.zeros(len(quantiser.centroids), np.int64)
        for row in indexed.groupBy("list").count().collect():  # MOST_LISTS at most
            held[row["list"]] = row["count"]
        bundled = bundles(quantiser.centroids, held, BLOCK_INDEXED)
        probing, numbers = _probes(indexed, quantiser, bundled, reach, probes)
        asked = {r.bundle: r.n for r in numbers.groupBy("bundle").agg(F.sum("n").alias("n")).collect()}
        placing = vectors.sparkSession.createDataFrame(
            [
                (
                    n,
                    b,
                    -(-int(sum(held[some])) // BLOCK_INDEXED),
                    -(-asked[b] // BLOCK_PROBING),
                )
                for b, some in enumerate(bundled)
                for n in some
            ],
            "list int, bundle int, across long, down long",
        )
        sizes = F.broadcast(placing.where("down > 0"))
        spread = lambda n: F.sequence(F.lit(0).cast("long"), F.col(n) - 1)
        mine = lambda n: F.array(F.pmod(F.xxhash64("uid"), F.col(n)))
        to_index = (
            indexed.join(sizes, "list")
            .withColumns({"role": F.lit(0), "lists": F.lit(None).cast("binary")})
            .withColumn("i", F.explode(mine("across")))
            .withColumn("j", F.explode(spread("down")))
        )
        of_bundle = F.broadcast(placing.select("bundle", "across", "down").distinct())
        to_probe = (
            probing.join(of_bundle, "bundle")
            .withColumns(
                {
                    "role": F.lit(1),
                    "list": F.lit(-1),
                    "weight": F.lit(0).cast("long"),
                    "codes": F.lit(None).cast("binary"),
                    "error": F.lit(0.0),
                }
            )
            .withColumn("i", F.explode(spread("across")))
            .withColumn("j", F.explode(mine("down")))
        )
        placed = (
            to_index.unionByName(to_probe)
            .withColumn("block", F.expr("bundle * 1099511627776 + i * 1048576 + j"))
            .select("block", "list", "role", "uid", "weight", "unit", "codes", "error", "lists")
            .repartition("block")
            .sortWithinPartitions("block", "role")
        )
        compared = stage(
            placed.mapInArrow(_compare(quantiser, cosine, reach), "uid long, other long, n long"),
            "links",
        )
        counts = compared.where("n IS NOT NULL").groupBy("uid").agg(F.sum("n").alias("n"))
        pairs = compared.where("n IS NULL").select(
            F.col("uid").alias("a"), F.col("other").alias("b")
        )
        counted = counts if counted is None else counted.union(counts)
        linked = pairs if linked is None else linked.union(pairs)
    if counted is None:
        return rows.select(
            "vec_id",
            F.lit(0).cast("long").alias("n_links"),
            F.col("vec_id").alias("component_id"),
            F.lit(True).alias("kept"),
        )
    found = stage(components(linked.distinct()), "components")
    members = stage(
        named.select("uid", "k1", "k2", "first_id")
        .join(found, F.col("uid") == F.col("node"), "left")
        .join(counted, "uid", "left")
        .select("k1", "k2", "first_id", "n", F.coalesce("component", "uid").alias("component")),
        "members",
    )
    smallest = stage(
        members.groupBy("component").agg(F.min("first_id").alias("component_id")), "smallest"
    )
    of_vector = stage(members.join(smallest, "component").drop("component", "first_id"), "named")
    alone = rows.where("k1 IS NULL").select(
        "vec_id",
        F.lit(0).cast("long").alias("n_links"),
        F.col("vec_id").alias("component_id"),
    )
    out = (
        rows.where("k1 IS NOT NULL")
        .join(of_vector, ["k1", "k2"])
        .select("vec_id", (F.col("n") - 1).alias("n_links"), "component_id")
        .union(alone)
    )
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
