"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a word's bytes in both directions and gives every byte a
distribution over languages. It is trained in numpy by backpropagation through
time on words of a bounded sample of labelled documents. A document's probabilities
pool the log-probabilities of all its bytes.

The recurrence starts anew at each word (longer ones are cut), so equal
words have equal labels wherever they stand; a worker labels each once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from patronage.llm.columns import fold
from patronage.llm.scan import blocks

#: Documents that training samples at most: those whose ids have the smallest hashes.
SAMPLE_DOCUMENTS = 4_000
#: Words drawn from anywhere in each sampled document.
SAMPLE_WORDS = 40
#: Units of each direction.
HIDDEN = 12
#: Bytes after which a word is cut and the recurrence starts anew.
LONGEST = 32
#: How much the mean log-probability of a byte counts in a document's distribution.
SHARPNESS = 12.0
#: Words whose labels a worker keeps; beyond, it forgets them and starts anew.
KEPT_WORDS = 600_000
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


@dataclass
class Network:
    """Weights by name. Each direction has input rows per byte ``w``, recurrent ``u`` and ``b``
    for its update, reset and candidate; ``v`` and ``c`` label a position."""

    weights: dict[str, np.ndarray]

    @classmethod
    def new(cls, labels: int, seed: int = 0) -> Network:
        draw = np.random.default_rng(seed)
        weights = {}
        for d in "fb":
            weights[f"w{d}"] = draw.normal(0, 0.3, (256, 3 * HIDDEN))
            weights[f"u{d}"] = draw.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN))
            weights[f"b{d}"] = np.zeros(3 * HIDDEN)
        weights["v"] = draw.normal(0, 0.3, (2 * HIDDEN, labels))
        weights["c"] = np.zeros(labels)
        return cls({k: x.astype(np.float32) for k, x in weights.items()})

    def _run(self, codes: np.ndarray, d: str, keep: list | None) -> np.ndarray:
        """States (time, word, unit) of one direction over words of one length."""
        n, times = codes.shape
        w, u, b = (self.weights[f"{k}{d}"] for k in "wub")
        H = HIDDEN
        h = np.zeros((n, H), np.float32)
        states = np.empty((times, n, H), np.float32)
        for t in range(times):
            x = w[codes[:, t]] + b
            g = h @ u
            z, r = _sigmoid(x[:, :H] + g[:, :H]), _sigmoid(x[:, H : 2 * H] + g[:, H : 2 * H])
            c = np.tanh(x[:, 2 * H :] + r * g[:, 2 * H :])
            if keep is not None:
                keep.append((h, z, r, c, g[:, 2 * H :]))
            h = c + z * (h - c)
            states[t] = h
        return states

    def _back(self, codes: np.ndarray, d: str, kept: list, up: np.ndarray, grads: dict) -> None:
        """Add one direction's gradients; ``up`` (time, word, unit) comes from the labels."""
        u, H = self.weights[f"u{d}"], HIDDEN
        later = np.zeros_like(up[0])
        for t in range(len(kept) - 1, -1, -1):
            h, z, r, c, g = kept[t]
            dh = up[t] + later
            dc = dh * (1 - z) * (1 - c * c)
            dz = dh * (h - c) * z * (1 - z)
            dr = dc * g * r * (1 - r)
            dx = np.concatenate([dz, dr, dc], axis=1)
            dg = np.concatenate([dz, dr, dc * r], axis=1)
            np.add.at(grads[f"w{d}"], codes[:, t], dx)
            grads[f"b{d}"] += dx.sum(axis=0)
            grads[f"u{d}"] += h.T @ dg
            later = dh * z + dg @ u.T

    def labels(self, codes: np.ndarray) -> np.ndarray:
        """Log-probabilities (time, word, label) of every position."""
        forward = self._run(codes, "f", None)
        backward = self._run(codes[:, ::-1], "b", None)[::-1]
        both = np.concatenate([forward, backward], axis=2)
        return _log_softmax(both @ self.weights["v"] + self.weights["c"])

    def gradients(self, codes: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> dict:
        """Gradients of the mean cross-entropy of all positions."""
        grads = {k: np.zeros_like(x) for k, x in self.weights.items()}
        kept_f: list = []
        kept_b: list = []
        forward = self._run(codes, "f", kept_f)
        backward = self._run(codes[:, ::-1], "b", kept_b)[::-1]
        both = np.concatenate([forward, backward], axis=2)
        wrong = np.exp(_log_softmax(both @ self.weights["v"] + self.weights["c"]))
        wrong[:, np.arange(len(truth)), truth] -= 1
        wrong *= (weight / (weight.sum() * codes.shape[1]))[None, :, None]
        wrong = wrong.astype(np.float32)
        flat, up = wrong.reshape(-1, wrong.shape[2]), wrong @ self.weights["v"].T
        grads["v"] = both.reshape(len(flat), -1).T @ flat
        grads["c"] = flat.sum(axis=0)
        self._back(codes, "f", kept_f, up[:, :, :HIDDEN], grads)
        self._back(codes[:, ::-1], "b", kept_b, up[::-1, :, HIDDEN:], grads)
        return grads


def _pieces(word: bytes) -> list[bytes]:
    return [word[i : i + LONGEST] for i in range(0, len(word), LONGEST)]


def _codes(some: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(some), np.uint8).reshape(len(some), -1)


def fit(
    examples: list[tuple[bytes, int]], labels: int, steps: int = 900, batch: int = 256, seed: int = 0
) -> Network:
    """Train on (word, label) by Adam, labels weighing alike; batches hold words of one length."""
    network, draw = Network.new(labels, seed), np.random.default_rng(seed)
    by_length: dict[int, list[tuple[bytes, int]]] = {}
    for word, label in examples:
        for piece in _pieces(word):
            by_length.setdefault(len(piece), []).append((piece, label))
    counts = np.bincount([label for _, label in examples], minlength=labels)
    weight_of = (len(examples) / np.maximum(counts, 1) / labels).astype(np.float32)
    lengths = sorted(by_length)
    mass = np.array([n * len(by_length[n]) for n in lengths], float)
    groups = {
        n: (_codes([w for w, _ in by_length[n]]), np.array([y for _, y in by_length[n]]))
        for n in lengths
    }
    first = {k: np.zeros_like(x) for k, x in network.weights.items()}
    second = {k: np.zeros_like(x) for k, x in network.weights.items()}
    for step in range(1, steps + 1):
        codes, truth = groups[lengths[draw.choice(len(lengths), p=mass / mass.sum())]]
        pick = draw.integers(0, len(truth), batch)
        grads = network.gradients(codes[pick], truth[pick], weight_of[truth[pick]])
        rate = 0.015 * min(1.0, 2 * (1 - (step - 1) / steps))
        for k, g in grads.items():
            first[k] += 0.1 * (g - first[k])
            second[k] += 0.01 * (g * g - second[k])
            change = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)
            network.weights[k] -= (rate * change).astype(np.float32)
    return network


class Identifier:
    """Labels texts by a network, each distinct word once."""

    def __init__(self, network: Network, languages: list[str]) -> None:
        self.network, self.languages = network, languages
        self.reset()

    def reset(self) -> None:
        self.codes: dict[bytes, int] = {}
        self.sums = np.zeros((1 << 12, len(self.languages) + 1))

    def _learn(self, fresh: list[bytes]) -> None:
        first, last = len(self.codes) - len(fresh), len(self.codes)
        while len(self.sums) < last:
            self.sums = np.concatenate([self.sums, np.zeros_like(self.sums)])
        by_length: dict[int, list[tuple[int, bytes]]] = {}
        for i, word in enumerate(fresh):
            for piece in _pieces(word):
                by_length.setdefault(len(piece), []).append((first + i, piece))
        for length, some in by_length.items():
            for at in range(0, len(some), 4096):
                part = some[at : at + 4096]
                found = self.network.labels(_codes([piece for _, piece in part])).sum(axis=0)
                numbers = np.array([i for i, _ in part])
                np.add.at(self.sums[:, :-1], numbers, found)
                np.add.at(self.sums[:, -1], numbers, length)

    def probabilities(self, texts: list[str | None]) -> np.ndarray:
        """A distribution per text, from the log-probabilities of all its bytes."""
        if len(self.codes) > KEPT_WORDS:
            self.reset()
        known, fresh, numbers, sizes = self.codes, [], [], []
        for text in texts:
            parts = text.encode().split() if text else []
            found = list(map(known.get, parts))
            if None in found:
                for i, number in enumerate(found):
                    if number is None:
                        number = known.get(parts[i])
                        if number is None:
                            number = known[parts[i]] = len(known)
                            fresh.append(parts[i])
                        found[i] = number
            numbers.extend(found)
            sizes.append(len(found))
        if fresh:
            self._learn(fresh)
        bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        sums = np.concatenate(
            [np.zeros((1, self.sums.shape[1])), np.cumsum(self.sums[numbers], axis=0)]
            if numbers
            else [np.zeros((1, self.sums.shape[1]))]
        )
        total = np.diff(sums[bounds], axis=0)
        pooled = total[:, :-1] / np.maximum(total[:, -1:], 1) * SHARPNESS
        return np.exp(_log_softmax(pooled))


def sample(docs: DataFrame, seed: int = 0) -> list[tuple[bytes, str]]:
    """(word, language) of at most ``SAMPLE_DOCUMENTS`` times ``SAMPLE_WORDS`` words.

    ``docs`` (doc_id, text, lang) holds what may train. Every language gives the same number of
    documents, as far as it has them, those of the smallest hash of their id; of several rows
    with one id one trains.
    """
    spark = docs.sparkSession
    # One row per id: that of the smallest text hash.
    one_each = (
        docs.where("doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "lang")).alias("least"))
        .select("doc_id", "least.*", F.xxhash64(F.lit(seed), "doc_id").alias("order"))
    )
    languages = one_each.agg(F.count_distinct("lang")).first()[0]
    each = max(1, SAMPLE_DOCUMENTS // max(languages, 1))
    # The first of each language, cut within parts of a language before the whole of it.
    ordered = one_each.withColumn("part", F.pmod(F.xxhash64("order"), F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        first = F.row_number().over(Window.partitionBy(*keys).orderBy("order", "doc_id"))
        ordered = ordered.withColumn("first", first).where(F.col("first") <= each)
    ids = ordered.orderBy("first", "order", "doc_id").limit(SAMPLE_DOCUMENTS).collect()
    chosen = spark.createDataFrame(
        [(row.doc_id, row.hash) for row in ids], "doc_id long, hash long"
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[bytes, str]] = []
            for doc_id, text, lang in zip(*(batch.column(i) for i in range(3)), strict=True):
                parts = (text.as_py() or "").encode().split()
                draw = np.random.default_rng([seed, doc_id.as_py() & 0xFFFFFFFF, len(parts)])
                for i in draw.choice(len(parts), min(SAMPLE_WORDS, len(parts)), replace=False):
                    out.append((parts[i], lang.as_py()))
            yield pa.RecordBatch.from_arrays(
                [pa.array([w for w, _ in out], pa.binary()), pa.array([x for _, x in out], pa.string())],
                ["word", "lang"],
            )

    rows = (
        docs.withColumn("hash", F.xxhash64("text"))
        .join(F.broadcast(chosen), ["doc_id", "hash"], "left_semi")
        .groupBy("doc_id")
        .agg(F.min(F.struct("lang", "text")).alias("row"))
        .select("doc_id", "row.text", "row.lang")
        .mapInArrow(tasks, "word binary, lang string")
        .collect()
    )
    return sorted((bytes(row.word), row.lang) for row in rows)


def identify(docs: DataFrame, network: Network | None, languages: list[str]) -> DataFrame:
    """One row per input row (doc_id, text): doc_id, lang_pred, score.

    A text that is null or has no letter is ``und`` with score 0, as is any text if
    no language was learnt. Rows are independent of each other.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identifier = Identifier(network, languages) if network else None
        for batch in batches:
            for block in blocks(batch, "text", 4 << 20):
                texts = block.column("text").to_pylist()
                predicted, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if identifier:
                    found = identifier.probabilities(texts)
                    best = found.argmax(axis=1)
                    for i, text in enumerate(texts):
                        if text and _LETTER.search(text):
                            predicted[i], scores[i] = languages[best[i]], found[i, best[i]]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(predicted), pa.array(scores)],
                    ["doc_id", "lang_pred", "score"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        tasks, "doc_id long, lang_pred string, score double"
    )


def train(docs: DataFrame) -> tuple[Network | None, list[str]]:
    """A network and its languages, learnt from ``docs`` (doc_id, text, lang) with a language."""
    examples = sample(docs.where("lang IS NOT NULL"))
    languages = sorted({lang for _, lang in examples})
    if not languages:
        return None, []
    place = {lang: i for i, lang in enumerate(languages)}
    return fit([(word, place[lang]) for word, lang in examples], len(languages)), languages


def held_out_predictions(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, held_out (crc32 of the id modulo 3 is 1), lang_pred, score.

    Learns from rows with a language that are not held out; a null id counts as empty
    text, is not held out, and does not train. Predictions read the text alone, so repeated
    rows agree; long texts are read whole; an empty table gives no rows.
    """
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    network, languages = train(plain.where(fold("doc_id", 3) != 1))
    return identify(plain, network, languages).select(
        "doc_id", (fold("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score"
    )
