"""Interpolated modified Kneser-Ney bigram model, counted in Spark and scored from mapped arrays.

Training takes three jobs. Every one combines counts inside its tasks and sends packed
arrays of them to shards, so no word, however frequent, makes a large group, and shards
grow in number with the text. With more than 4,096 shards (64 GB of text) the arrays go by
levels, each of which tells at most 4,096 groups apart and merges what came, so the number of
arrays a task makes for a million counts is bounded whatever the number of shards:

1. words: hash -> count, in shards by the hash's top bits. A word's number is its
   place in the concatenated sorted shards.
2. bigrams: (number of the context, number of the word) -> count, in shards by the
   top bits of a bijective mix of the pair, which also spreads a frequent context.
   The shard's task also sums what each context and each word needs.
3. words' statistics: for each range of numbers, the context totals, the contexts'
   followers by count (1, 2, 3 and more), and the words' numbers of distinct predecessors.

All results are sorted arrays in the shared folder, one file per shard, which the
scoring workers memory-map: a lookup is a binary search and touches few pages.
"""

from __future__ import annotations

import math
from collections import OrderedDict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.columns import fold
from patronage.llm.scan import blocks, mix, text_bytes, unmix, words
from patronage.llm.store import map_array, write_array
from patronage.session import scratch_path

#: Hash of the end of a text, a token that no word's hash is likely to equal.
END = np.uint64(0x51ED270B7F4A7C15)
#: Bytes of training text per shard of counts.
SHARD_BYTES = 16 << 20
#: Bits of a shard's number that one exchange tells apart.
FAN_BITS = 12
#: Arrays of a model that a worker keeps mapped, and bytes of those it had to read whole.
MOST_MAPPED, MOST_READ = 4_096, 256 << 20
#: Word numbers per file of word statistics, at least.
LEAST_RANGE = 1 << 12
#: Bytes of text handled at once.
BLOCK_BYTES = 2 << 20
#: The context at the beginning of a text, above every word's number.
BEGIN = (1 << 32) - 1

_PACKED = "place int, keys binary, counts binary"
_SUMS = "place int, left binary, sums binary, right binary, before binary, of array<long>"


def _shifts(bits: int, fan_bits: int) -> list[int]:
    """The low bits of a shard's number that each exchange leaves open; the last leaves none."""
    steps = max(1, math.ceil(bits / fan_bits))
    return [bits - math.ceil(bits * (i + 1) / steps) for i in range(steps)]


def _place(group: np.ndarray, shift: int) -> pa.Array:
    """The partitions that a task's packed rows go to: a group has ``2 ** shift``, dealt to tasks
    by their number, so a task that runs again sends every key to the same one."""
    place = (group.astype(np.int64) << shift) + TaskContext.get().partitionId() % (1 << shift)
    return pa.array(place.astype(np.int32))


def _exchange(
    rows: DataFrame, bits: int, shifts: list[int], merge: Callable, none: DataFrame | None = None
) -> DataFrame:
    """Bring packed rows to partitions that hold one shard each, level by level.

    ``rows`` were packed for the first of ``shifts``; ``merge(shift)`` is a function of a
    partition's batches that packs their sums for the next.
    """
    for shift in shifts[1:]:
        rows = rows.repartitionById(1 << bits, "place").mapInArrow(merge(shift), rows.schema)
    if none is not None:
        rows = rows.union(none)
    return rows.repartitionById(1 << bits, "place")


def _sum_by_key(keys: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted distinct keys and the sums of their values."""
    if not len(keys):
        return (keys, *values)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return (keys[first], *(np.add.reduceat(v[order], first) for v in values))


def _top_bits(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)) if bits else np.zeros(len(keys), np.uint64)


class _Counter:
    """Counts of keys met by a task, merged whenever many have piled up."""

    def __init__(self, limit: int = 1 << 20) -> None:
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held, self.limit = 0, limit

    def add(self, keys: np.ndarray) -> None:
        found, counts = np.unique(keys, return_counts=True)
        self.parts.append((found, counts.astype(np.int64)))
        self.held += len(found)

    def add_counted(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.parts.append((keys, counts))
        self.held += len(keys)

    def full(self) -> bool:
        return self.held > self.limit

    def packed(self, bits: int, shift: int) -> pa.RecordBatch:
        """One row per group of ``2 ** shift`` shards that has keys: where it goes, its sorted
        keys, their counts."""
        keys = np.concatenate([p[0] for p in self.parts]) if self.parts else np.zeros(0, np.uint64)
        counts = np.concatenate([p[1] for p in self.parts]) if self.parts else np.zeros(0, np.int64)
        self.parts, self.held = [], 0
        keys, counts = _sum_by_key(keys, counts)
        narrow = np.uint64 if counts.max(initial=0) >> 32 else np.uint32
        groups, begins = np.unique(_top_bits(keys, bits - shift), return_index=True)
        spans = [*zip(begins, [*begins[1:], len(keys)], strict=True)] if len(keys) else []
        return pa.RecordBatch.from_arrays(
            [
                _place(groups, shift),
                pa.array([keys[i:j].tobytes() for i, j in spans], pa.binary()),
                pa.array([counts[i:j].astype(narrow).tobytes() for i, j in spans], pa.binary()),
            ],
            names=["place", "keys", "counts"],
        )


def _recounted(bits: int, shift: int) -> Callable:
    """Packed counts of a group, summed and packed for the next level."""

    def tasks(batches):
        counter = _Counter()
        for _, rows in _by_place(batches, "keys", "counts"):
            for keys, counts in rows:
                counter.add_counted(*_unpack(keys, counts))
                if counter.full():
                    yield counter.packed(bits, shift)
        yield counter.packed(bits, shift)

    return tasks


class _WordSums:
    """What pairs say about their words, by number: of a context its total and its followers
    met once, twice and more, of a follower its distinct predecessors, and of all pairs how many
    occur 1 to 4 times. Ranges of ``range_words`` numbers follow one another; BEGIN's is the last."""

    def __init__(self, range_words: int, last: int, limit: int = 1 << 20) -> None:
        self.range_words, self.last, self.limit = range_words, last, limit
        self.left: list[tuple] = []
        self.right: list[tuple] = []
        self.of = np.zeros(4, np.int64)
        self.held = 0

    def add(self, left: tuple, right: tuple, of: np.ndarray) -> None:
        self.left.append(left)
        self.right.append(right)
        self.of += of
        self.held += len(left[0]) + len(right[0])

    def add_packed(self, left: bytes, sums: bytes, right: bytes, before: bytes, of: list) -> None:
        at, other = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
        parts = _wide(sums, 4 * len(at)).reshape(4, -1).astype(np.int64)
        self.add((at, *parts), (other, _wide(before, len(other)).astype(np.int64)), of)

    def full(self) -> bool:
        return self.held > self.limit

    def _groups(self, numbers: np.ndarray, shift: int) -> np.ndarray:
        ranges = numbers.astype(np.int64) // self.range_words
        return np.where(numbers == BEGIN, self.last, ranges) >> shift

    def packed(self, shift: int) -> Iterator[pa.RecordBatch]:
        """One row per group of ``2 ** shift`` ranges that has numbers."""
        if not self.held:
            return
        left = _sum_by_key(*map(np.concatenate, zip(*self.left, strict=True)))
        right = _sum_by_key(*map(np.concatenate, zip(*self.right, strict=True)))
        of = self.of.tolist()
        self.__init__(self.range_words, self.last, self.limit)
        of_left, of_right = self._groups(left[0], shift), self._groups(right[0], shift)
        for group in np.union1d(of_left, of_right):
            a = slice(*np.searchsorted(of_left, [group, group + 1]))
            b = slice(*np.searchsorted(of_right, [group, group + 1]))
            yield pa.RecordBatch.from_arrays(
                [
                    _place(np.array([group]), shift),
                    pa.array([left[0][a].tobytes()], pa.binary()),
                    pa.array([_narrow(np.stack([v[a] for v in left[1:]]))], pa.binary()),
                    pa.array([right[0][b].tobytes()], pa.binary()),
                    pa.array([_narrow(right[1][b])], pa.binary()),
                    pa.array([of], pa.list_(pa.int64())),
                ],
                names=["place", "left", "sums", "right", "before", "of"],
            )
            of = [0, 0, 0, 0]


def _resummed(range_words: int, last: int, shift: int) -> Callable:
    """Packed sums of a group of ranges, added up and packed for the next level."""

    def tasks(batches):
        sums = _WordSums(range_words, last)
        for _, rows in _by_place(batches, "left", "sums", "right", "before", "of"):
            for row in rows:
                sums.add_packed(*row)
                if sums.full():
                    yield from sums.packed(shift)
        yield from sums.packed(shift)

    return tasks


def _unpack(keys: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    found = np.frombuffer(keys, np.uint64)
    kind = np.uint32 if len(counts) == 4 * len(found) else np.uint64
    return found, np.frombuffer(counts, kind).astype(np.int64)


def _by_place(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[int, Iterator]]:
    """The place and packed rows of a partition, which holds those of one place.

    Rows are handed on one by one, so no more than a batch of them is held.
    """

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("place", *columns)), strict=True):
                yield tuple(value.as_py() for value in row)

    for place, own in groupby(rows(), key=itemgetter(0)):
        yield place, (row[1:] for row in own)


def _merged(rows: Iterator[tuple]) -> tuple[np.ndarray, np.ndarray]:
    """Sum packed rows, folding as they accumulate so that memory follows the distinct keys."""
    done: list[tuple[np.ndarray, np.ndarray]] = []
    for keys, counts in rows:
        done.append(_unpack(keys, counts))
        if len(done) > 1 and sum(len(k) for k, _ in done[1:]) > max(1 << 19, len(done[0][0])):
            done = [_sum_by_key(*map(np.concatenate, zip(*done, strict=True)))]
    return _sum_by_key(*map(np.concatenate, zip(*done, strict=True)))


def _narrow(values: np.ndarray) -> bytes:
    return values.astype(np.int64 if values.max(initial=0) >> 31 else np.int32).tobytes()


def _wide(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, np.int32 if len(data) == 4 * n else np.int64)


def token_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all tokens, each text's words and then one end; bounds of the texts' tokens."""
    found = words(data, bounds)
    first = found.first + np.arange(len(bounds))
    hashes = np.empty(first[-1], np.uint64)
    is_end = np.zeros(first[-1], bool)
    is_end[first[1:] - 1] = True
    hashes[is_end] = END
    hashes[~is_end] = found.hashes()
    return hashes, first


@dataclass(frozen=True)
class Model:
    """Where a trained model's arrays are, and its few numbers."""

    folder: str
    word_bits: int
    offsets: tuple[int, ...]
    pair_bits: int
    #: Word numbers per file of word statistics.
    range_words: int
    n_tokens: int
    n_words: int
    n_pairs: int
    pair_discounts: tuple[float, float, float]
    word_discounts: tuple[float, float, float]
    #: Probability mass left to the uniform distribution by the words' discounts.
    uniform_mass: float


class MappedModel:
    """A model's arrays as a worker sees them, the least recently used ones let go."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._arrays: OrderedDict[str, np.ndarray] = OrderedDict()
        self._read = 0

    def array(self, name: str) -> np.ndarray:
        if name in self._arrays:
            self._arrays.move_to_end(name)
            return self._arrays[name]
        values = self._arrays[name] = map_array(f"{self.model.folder}/{name}.npy")
        self._read += self._bytes(values)
        while len(self._arrays) > 1 and (
            len(self._arrays) > MOST_MAPPED or self._read > MOST_READ
        ):
            self._read -= self._bytes(self._arrays.popitem(last=False)[1])
        return values

    @staticmethod
    def _bytes(values: np.ndarray) -> int:
        return 0 if isinstance(values, np.memmap) else values.nbytes

    def _search(self, kind: str, bits: int, keys: np.ndarray) -> Iterator[tuple]:
        """Of sorted keys: slices that one shard holds, places there, and which are found."""
        shards = _top_bits(keys, bits)
        for shard in np.unique(shards):
            lo, hi = np.searchsorted(shards, [shard, shard + np.uint64(1)])
            held = self.array(f"{kind}-{int(shard)}-keys")
            some = keys[lo:hi]
            place = np.searchsorted(held, some)
            inside = np.minimum(place, max(len(held) - 1, 0))
            found = held[inside] == some if len(held) else np.zeros(len(some), bool)
            yield int(shard), slice(lo, hi), inside, found

    def numbers(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of words given by sorted hashes."""
        out, counts = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        for shard, at, place, found in self._search("word", self.model.word_bits, hashes):
            if found.any():
                out[at] = np.where(found, place + self.model.offsets[shard], -1)
                held = self.array(f"word-{shard}-counts")
                counts[at] = np.where(found, held[place], 0)
        return out, counts

    def pair_counts(self, mixed: np.ndarray) -> np.ndarray:
        """Counts of pairs given by sorted mixed keys."""
        out = np.zeros(len(mixed), np.int64)
        for shard, at, place, found in self._search("pair", self.model.pair_bits, mixed):
            if found.any():
                out[at] = np.where(found, self.array(f"pair-{shard}-counts")[place], 0)
        return out

    def statistics(self, numbers: np.ndarray) -> np.ndarray:
        """Rows (total, ones, twos, more, predecessors) of sorted numbers; BEGIN has its own."""
        out = np.zeros((len(numbers), 5), np.int64)
        ranges = np.where(numbers == BEGIN, -1, numbers // self.model.range_words)
        for r in np.unique(ranges):
            at = ranges == r
            if r < 0:
                out[at] = self.array("stats-begin")
            else:
                out[at] = self.array(f"stats-{int(r)}")[
                    numbers[at] % self.model.range_words
                ]
        return out

    def score(self, hashes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, ...]:
        """Per text: n_known, base score, score."""
        m = self.model
        distinct, which = np.unique(hashes, return_inverse=True)
        numbers, counts = self.numbers(distinct)
        known = numbers >= 0
        base = np.log10((counts + 0.1) / (m.n_tokens + 0.1 * (m.n_words + 1)))
        uniform = m.uniform_mass / (m.n_words + 1)
        ordered = np.argsort(numbers, kind="stable")
        stats = np.zeros((len(distinct) + 1, 5), np.int64)
        ordered = ordered[numbers[ordered] >= 0]
        stats[ordered] = self.statistics(numbers[ordered])
        stats[-1] = self.statistics(np.array([BEGIN]))[0] if m.n_pairs else 0
        before = stats[:-1, 4]
        discount = np.array([0.0, *m.word_discounts])
        lower = uniform + np.where(
            before > 0, before - discount[np.minimum(before, 3)], 0.0
        ) / max(m.n_pairs, 1)
        context = np.empty(len(hashes), np.int64)
        context[1:] = which[:-1]
        context[first[:-1]] = len(distinct)
        ids = np.append(numbers, BEGIN)
        both = (ids[context] >= 0) & known[which]
        keys = mix(
            ids[context][both].astype(np.uint64) << np.uint64(32)
            | numbers[which][both].astype(np.uint64)
        )
        pairs, at = np.unique(keys, return_inverse=True)
        seen = np.zeros(len(hashes), np.int64)
        seen[both] = self.pair_counts(pairs)[at]
        total = stats[context, 0].astype(float)
        discount = np.array([0.0, *m.pair_discounts])
        mass = stats[:, 1:4] @ discount[1:]
        followed = total > 0
        safe = np.where(followed, total, 1.0)
        p = np.where(
            followed,
            np.maximum(seen - discount[np.minimum(seen, 3)], 0.0) / safe
            + mass[context] / safe * lower[which],
            lower[which],
        )
        starts = first[:-1]
        return (
            np.add.reduceat(known[which].astype(np.int64), starts),
            np.add.reduceat(base[which], starts),
            np.add.reduceat(np.log10(p), starts),
        )


def _discounts(n: list[int]) -> tuple[float, float, float]:
    """Modified Kneser-Ney discounts from the numbers of items that occur 1, 2, 3, 4 times.

    A small corpus may leave a number at zero or push a discount out of its range;
    such a discount is 0.5, 1 or 1.5, the middle of what it may be.
    """
    out = []
    y = n[0] / (n[0] + 2 * n[1]) if n[0] else 0.0
    for k in (1, 2, 3):
        d = k - (k + 1) * y * n[k] / n[k - 1] if n[k - 1] and n[k] and y else k / 2
        out.append(d if 0 < d <= k else k / 2)
    return tuple(out)


def _bits(n: int) -> int:
    return max(0, math.ceil(math.log2(max(n, 1))))


def train(docs: DataFrame, text_column: str = "text") -> Model:
    """Count a model from all texts of ``docs``; null counts as empty.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased; a text is its words
    and one end. Words are told apart by 64-bit hashes. No row at all gives a
    model that knows nothing and spreads its mass evenly. A corpus of more than about
    2^32 distinct words is refused, as two words' numbers make one 64-bit key.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "kneser-ney")
    texts = docs.select(F.col(text_column).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    bits = _bits(math.ceil(size / SHARD_BYTES))
    shards, fan_bits = 1 << bits, FAN_BITS
    shifts = _shifts(bits, fan_bits)

    # Every shard gets a row, so that each writes its files, be they empty.
    none = spark.range(shards).select(
        F.col("id").cast("int").alias("place"), *(F.lit(b"").alias(c) for c in ("keys", "counts"))
    )

    def word_tasks(batches):
        counter = _Counter()
        for batch in batches:
            for block in blocks(batch, "text", BLOCK_BYTES):
                counter.add(token_hashes(*text_bytes(block.column("text")))[0])
            if counter.full():
                yield counter.packed(bits, shifts[0])
        yield counter.packed(bits, shifts[0])

    def write_words(batches):
        for shard, rows in _by_place(batches, "keys", "counts"):
            keys, counts = _merged(rows)
            write_array(f"{folder}/word-{shard}-keys.npy", keys)
            write_array(f"{folder}/word-{shard}-counts.npy", counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([shard], pa.int32()),
                    pa.array([len(keys)], pa.int64()),
                    pa.array([int(counts.sum())], pa.int64()),
                ],
                names=["shard", "size", "total"],
            )

    def recounted(shift):
        return _recounted(bits, shift)

    words_found = texts.mapInArrow(word_tasks, _PACKED)
    found = (
        _exchange(words_found, bits, shifts, recounted, none)
        .mapInArrow(write_words, "shard int, size long, total long")
        .collect()
    )
    sizes = {row.shard: row.size for row in found}
    offsets = tuple(np.cumsum([0, *(sizes.get(s, 0) for s in range(shards))]).tolist())
    # As many ranges as shards: what all shards know of a range's words is then of
    # one size, however much text there is.
    range_words = max(LEAST_RANGE, math.ceil(offsets[-1] / shards))
    if offsets[-1] > BEGIN - range_words:
        raise ValueError("too many distinct words for 32-bit numbers")
    last = offsets[-1] // range_words + 1
    range_bits = _bits(last + 1)
    range_shifts = _shifts(range_bits, fan_bits)
    counted = Model(
        folder, bits, offsets, bits, range_words, sum(row.total for row in found), offsets[-1], 0,
        (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), 1.0,
    )

    def pair_tasks(batches):
        mapped, counter = MappedModel(counted), _Counter()
        for batch in batches:
            for block in blocks(batch, "text", BLOCK_BYTES):
                hashes, first = token_hashes(*text_bytes(block.column("text")))
                distinct, which = np.unique(hashes, return_inverse=True)
                ids = mapped.numbers(distinct)[0][which].astype(np.uint64)
                context = np.empty_like(ids)
                context[1:] = ids[:-1]
                context[first[:-1]] = BEGIN
                counter.add(mix(context << np.uint64(32) | ids))
            if counter.full():
                yield counter.packed(bits, shifts[0])
        yield counter.packed(bits, shifts[0])

    def write_pairs(batches):
        for shard, rows in _by_place(batches, "keys", "counts"):
            keys, counts = _merged(rows)
            write_array(f"{folder}/pair-{shard}-keys.npy", keys)
            write_array(
                f"{folder}/pair-{shard}-counts.npy",
                counts if counts.max(initial=0) >> 32 else counts.astype(np.uint32),
            )
            pairs = unmix(keys)
            context = pairs >> np.uint64(32)
            ones, twos = (counts == 1).astype(np.int64), (counts == 2).astype(np.int64)
            more = (counts > 2).astype(np.int64)
            sums = _WordSums(range_words, last)
            sums.add(
                (context, counts, ones, twos, more),
                (pairs & np.uint64(BEGIN), np.ones_like(counts)),
                np.bincount(np.minimum(counts, 5), minlength=6)[1:5],
            )
            yield from sums.packed(range_shifts[0])

    def write_statistics(batches):
        columns = ("left", "sums", "right", "before", "of")
        for r, rows in _by_place(batches, *columns):
            is_begin = r == last
            low = BEGIN if is_begin else r * range_words
            size = range_words if not is_begin else 1
            stats, of_pairs = np.zeros((size, 5), np.int64), np.zeros(4, np.int64)
            for left, sums, right, before, of in rows:
                at = np.frombuffer(left, np.uint64).astype(np.int64) - low
                stats[at, :4] += _wide(sums, 4 * len(at)).reshape(4, -1).T
                at = np.frombuffer(right, np.uint64).astype(np.int64) - low
                stats[at, 4] += _wide(before, len(at))
                of_pairs += of
            write_array(f"{folder}/stats-{'begin' if is_begin else r}.npy", stats)
            of_words = np.bincount(np.minimum(stats[:, 4], 5), minlength=6)
            yield pa.RecordBatch.from_pydict(
                {
                    "pairs": [of_pairs.tolist()],
                    "words": [of_words[1:].tolist()],
                    "n_pairs": [int(stats[:, 4].sum())],
                }
            )

    def resummed(shift):
        return _resummed(range_words, last, shift)

    pairs_found = texts.mapInArrow(pair_tasks, _PACKED)
    sums_found = _exchange(pairs_found, bits, shifts, recounted, none).mapInArrow(
        write_pairs, _SUMS
    )
    found = (
        _exchange(sums_found, range_bits, range_shifts, resummed)
        .mapInArrow(write_statistics, "pairs array<long>, words array<long>, n_pairs long")
        .collect()
    )
    of_pairs = np.sum([row.pairs for row in found] or [[0] * 4], axis=0).tolist()
    of_words = np.sum([row.words for row in found] or [[0] * 5], axis=0).tolist()
    n_pairs = sum(row.n_pairs for row in found)
    # The last class of of_words holds five and more; the discounts need "four" alone.
    word_discounts = _discounts(of_words[:4])
    more = of_words[2] + of_words[3] + of_words[4]
    kept_back = np.dot(word_discounts, [of_words[0], of_words[1], more])
    return Model(
        folder, bits, offsets, bits, range_words, counted.n_tokens, counted.n_words, n_pairs,
        _discounts(of_pairs), word_discounts,
        float(kept_back / n_pairs) if n_pairs else 1.0,
    )


def score(
    docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, n_known, train_tokens, base_score, score.

    ``score`` is the log10 probability of the whole text, ``base_score`` that of
    the smoothed unigram model; perplexity is ``10 ** (-score / n_tokens)``. A null or
    empty text is its end alone. Rows are independent, so repeated rows and other
    columns change nothing.
    """

    def tasks(batches):
        mapped = MappedModel(model)
        for batch in batches:
            for block in blocks(batch, "text", BLOCK_BYTES):
                hashes, first = token_hashes(*text_bytes(block.column("text")))
                known, base, scores = mapped.score(hashes, first)
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"),
                        pa.array(np.diff(first)),
                        pa.array(known),
                        pa.array(base),
                        pa.array(scores),
                    ],
                    names=["doc_id", "n_tokens", "n_known", "base_score", "score"],
                )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    kind = "doc_id long, n_tokens long, n_known long, base_score double, score double"
    return rows.mapInArrow(tasks, kind).withColumn(
        "train_tokens", F.lit(model.n_tokens).cast("long")
    )


def held_out_scores(docs: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Train on the rows whose id's crc32 modulo 10 is not 0, score every row.

    A null id counts as empty text, whose remainder is 0, so it is held out.
    """
    model = train(docs.where(fold(id_column, 10) != 0))
    folded = docs.select(F.col(id_column).cast("long").alias("doc_id"), "text")
    return score(folded, model).select(
        "doc_id",
        (fold("doc_id", 10) == 0).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )
