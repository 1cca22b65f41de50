"""Quality scores by Bradley-Terry pairwise ranking.

A document of quality 1 is preferred to one of quality 0. The probability of a
preference is the logistic function of the difference of two scores, a score is linear in
a document's features, and the logistic loss over preference pairs gives the weights.
The cut is a quantile of the training scores: the share of quality 0.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.columns import fold, table, whole_row
from patronage.llm.scan import blocks, text_bytes, words

#: Labelled rows that training uses at most: those whose ids have the smallest hashes.
LABELLED_ROWS = 20_000
#: Preference pairs drawn from them.
PAIRS = 60_000
#: The score at the cut.
CUT_SCORE = 0.3
#: Bytes of text handled at once.
BLOCK_BYTES = 2 << 20

_CLASSES = ("lower", "upper", "digit", "space", "line", "stop", "bar", "bang", "symbol", "other")
_CLASS = np.full(256, 9, np.uint8)
for _name, _members in (
    ("lower", range(97, 123)),
    ("upper", range(65, 91)),
    ("digit", range(48, 58)),
    ("space", (32, 9, 11, 12, 13)),
    ("line", (10,)),
    ("stop", b".,;:?'\"()-"),
    ("bar", b"|"),
    ("bang", b"!"),
    ("symbol", b"#$%&*+/<=>@[\\]^_`{}~"),
):
    _CLASS[list(_members)] = _CLASSES.index(_name)


def _sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of ``values`` between consecutive ``first``; empty ranges give 0."""
    return np.diff(np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])[first])


def features(texts: pa.Array) -> np.ndarray:
    """One row of features per text; all are 0 for a null or empty text."""
    data, bounds = text_bytes(texts)
    n = len(bounds) - 1
    sizes = np.diff(bounds)
    owner = np.repeat(np.arange(n), sizes)
    kinds = np.bincount(
        owner * len(_CLASSES) + _CLASS[data], minlength=n * len(_CLASSES)
    ).reshape(n, -1)
    share = kinds / np.maximum(sizes, 1)[:, None]
    found = words(data, bounds, lower=False)
    first = found.first
    count = np.diff(first)
    safe = np.maximum(count, 1)
    hashes = found.hashes()
    length = (found.end - found.start).astype(np.float64)
    mine = np.repeat(np.arange(n), count)
    same = np.zeros(len(hashes))
    same[1:] = (hashes[1:] == hashes[:-1]) & (mine[1:] == mine[:-1])
    order = np.lexsort((hashes, mine))
    h, m = hashes[order], mine[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (m[1:] != m[:-1])
    starts = np.flatnonzero(new)
    repeats = np.diff(np.append(starts, len(h)))
    distinct = np.bincount(m[starts], minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, m[starts], repeats)
    begin, end = _CLASS[found.data[found.start]], _CLASS[found.data[found.end - 1]]
    letters = np.isin(begin, (0, 1, 9))
    mean = _sums(length, first) / safe
    spread = np.sqrt(np.maximum(_sums(length**2, first) / safe - mean**2, 0))
    columns = [
        share,
        np.sqrt(share[:, [1, 6, 7, 8]]),
        (share[:, 1] / np.maximum(share[:, 0] + share[:, 1], 1e-9))[:, None],
    ]
    single = [
        np.log1p(count),
        mean,
        spread,
        _sums(same, first) / safe,
        distinct / safe,
        most / safe,
        _sums(begin == 1, first) / safe,
        _sums(~letters, first) / safe,
        _sums(end == 5, first) / safe,
        _sums(end == 8, first) / safe,
        _sums(end == 7, first) / safe,
        _sums(length <= 3, first) / safe,
        _sums(length >= 15, first) / safe,
        kinds[:, 4] / safe,
    ]
    return np.column_stack([*columns, *(s[:, None] for s in single)])


@dataclass(frozen=True)
class Ranker:
    """A trained scorer; ``weights`` is None if there was nothing to compare."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None
    cut: float
    width: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """Between 0 and 1, ``CUT_SCORE`` at the cut; 0.5 where nothing was learnt."""
        if self.weights is None:
            return np.full(len(x), 0.5)
        z = (self.raw(x) - self.cut) / self.width + np.log(CUT_SCORE / (1 - CUT_SCORE))
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def fit(x: np.ndarray, good: np.ndarray, seed: int = 0) -> Ranker:
    """Weights that minimise the logistic loss over preference pairs (Newton's method)."""
    mean, scale = x.mean(axis=0) if len(x) else 0.0, np.maximum(x.std(axis=0), 1e-6) if len(x) else 1.0
    better, worse = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(better) or not len(worse):
        return Ranker(mean, scale, None, 0.0, 1.0)
    z = np.clip((x - mean) / scale, -8, 8)
    draw = np.random.default_rng(seed)
    apart = z[draw.choice(better, PAIRS)] - z[draw.choice(worse, PAIRS)]
    weights = np.zeros(x.shape[1])
    penalty = 1e-3 * np.eye(len(weights))
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(apart @ weights, -30, 30)))
        slope = apart.T @ (p - 1) / PAIRS + penalty @ weights
        curve = (apart * (p * (1 - p))[:, None]).T @ apart / PAIRS + penalty
        step = np.linalg.solve(curve, slope)
        weights -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    raw = z @ weights
    cut = float(np.quantile(raw, len(worse) / len(x)))
    return Ranker(mean, scale, weights, cut, max(float(np.std(raw)), 1e-6))


_FEATURES = "doc_id long, features array<double>"


def _featured(docs: DataFrame) -> DataFrame:
    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", BLOCK_BYTES):
                x = features(block.column("text"))
                lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1])
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), lists.cast(pa.list_(pa.float64()))],
                    ["doc_id", "features"],
                )

    return docs.select("doc_id", "text").mapInArrow(tasks, _FEATURES)


def train(docs: DataFrame, labels: DataFrame) -> Ranker:
    """Learn from labelled rows whose id's crc32 modulo 5 is not 0.

    ``docs`` (doc_id, text) and ``labels`` (doc_id, quality; other values than 0 and 1 are no
    labels) are read whole; ``LABELLED_ROWS`` bounds what trains, and what reaches the driver.
    A document with several labels trains with each; of several rows with one id
    the one of the smallest text hash trains.
    """
    chosen = (
        labels.where(F.col("quality").isin(0, 1) & (fold("doc_id", 5) != 0))
        .select(F.col("doc_id").cast("long").alias("doc_id"), "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality")
        .limit(LABELLED_ROWS)
    )
    labelled: dict[int, list[int]] = {}
    for row in chosen.collect():
        labelled.setdefault(row.doc_id, []).append(row.quality)
    spark = docs.sparkSession
    ids = spark.createDataFrame([(i,) for i in labelled], "doc_id long")
    hashed = F.struct(F.xxhash64("text").alias("hash"), "text")
    one_each = (
        docs.join(F.broadcast(ids), "doc_id", "left_semi")
        .groupBy("doc_id")
        .agg(F.min(hashed).alias("least"))
        .select("doc_id", "least.text")
    )
    rows = _featured(one_each).collect()
    rows.sort(key=lambda row: (row.doc_id, row.features))
    x = [row.features for row in rows for _ in labelled[row.doc_id]]
    good = [quality == 1 for row in rows for quality in labelled[row.doc_id]]
    return fit(np.array(x), np.array(good, bool))


def score(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """One row per input row: doc_id, score, predicted (1 where score >= ``CUT_SCORE``).

    Null and empty texts are scored like any other, by features that are all 0.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", BLOCK_BYTES):
                found = ranker.score(features(block.column("text")))
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(found)], ["doc_id", "score"]
                )

    return (
        docs.select("doc_id", "text")
        .mapInArrow(tasks, "doc_id long, score double")
        .withColumn("predicted", (F.col("score") >= CUT_SCORE).cast("int"))
    )


def _plain(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    return docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )


def held_out_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out (crc32 of the id modulo 5 is 0), score, predicted.

    A null id counts as empty text and is held out. Only the text decides a score, so
    repeated rows agree and other columns are not read.
    """
    plain = _plain(docs, "doc_id", "text")
    return score(plain, train(plain, labels)).select(
        "doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted"
    )


def keep_good(
    docs: DataFrame, ranker: Ranker, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """The rows of ``docs`` whose text is predicted to be good, all columns kept.

    Null and empty texts are scored by features that are all 0, so they are kept or go together.
    Repeated rows agree. Columns may have any names; an empty table gives no rows.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch, "text", BLOCK_BYTES):
                good = ranker.score(features(block.column("text"))) >= CUT_SCORE
                yield block.select(["row"]).filter(pa.array(good))

    packed = docs.select(
        whole_row(docs).alias("row"),
        F.col(text_column).alias("text"),
    )
    kind = T.StructType([packed.schema["row"]])
    return packed.mapInArrow(tasks, kind).select("row.*")


def filter_good(docs: DataFrame, folder: str) -> DataFrame:
    """``keep_good`` by a ranker trained on ``docs`` and the labels in ``folder``.

    Without labelled rows every text scores 0.5 and is kept.
    """
    labels = table(docs.sparkSession, folder, "labels", "doc_id", "quality")
    return keep_good(docs, train(_plain(docs, "doc_id", "text"), labels))
