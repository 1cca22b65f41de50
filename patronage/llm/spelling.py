"""Spelling variants: words one edit apart, found with k-d trees over letter counts.

One inserted letter raises one letter count by one, a deleted one lowers it, a replaced one does both, so
the counts of near words differ by two at most in all. A word's counts are kept as a
thermometer code: a letter's k-th bit says that it occurs at least k times. The box of a set of
words is then the bits that all of them have and the bits that any has, and a word's distance to
the box is a count of bits: how many letters it lacks and how many it has too many.

A first tree over lengths and counts, fitted to a sample of the words, cuts all words into
cells. A word is indexed in its own cell and searched in every cell whose box is in reach. Within a
cell each length has a k-d tree of its own, searched for each pair of lengths with the reach
of that pair, and words in reach are compared letter by letter.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patronage.llm.columns import ascii_lower
from patronage.session import stage

#: Words of a cell, as far as the sample tells, and sampled words per cell.
CELL = 50_000
SAMPLED = 200
#: Words in a leaf of a cell's trees.
LEAF = 24
#: Words searched at once, and pairs of them compared at once.
SEARCHED = 4_000
COMPARED = 1 << 21
#: Bytes of words compared at once.
COMPARED_BYTES = 1 << 24

LETTERS = r"A-Za-zÀ-ÿ"
#: Bits of a-z (so many for each), then those shared by all other letters.
_PER_LETTER = 3
_SHARED = 128 - 26 * _PER_LETTER
_BITS = 128


def _code_bits(letters: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """Thermometer codes of ``n`` words as bits, from the Latin-1 codes of all their letters.

    Letters other than a-z share bits: those of one remainder count together, with one bit for
    at least one occurrence. A shared bit differs only if a count does.
    """
    counts = np.bincount(row * 256 + letters, minlength=n * 256).reshape(n, 256)
    bits = np.zeros((n, _BITS), np.uint8)
    plain = counts[:, 97:123]
    for k in range(_PER_LETTER):
        bits[:, k * 26 : k * 26 + 26] = plain > k
    others = np.delete(np.arange(256), np.arange(97, 123))
    shared = np.zeros((n, _SHARED), np.int64)
    for code in others[counts[:, others].any(axis=0)]:
        shared[:, code % _SHARED] += counts[:, code]
    bits[:, 26 * _PER_LETTER :] = shared > 0
    return bits


def _letters(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    flat = np.frombuffer(b"".join(words), np.uint8)
    return flat, np.repeat(np.arange(len(words)), lengths), lengths


def codes_of(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes (word, two 64-bit numbers) and lengths of Latin-1 words."""
    out, lengths = [np.zeros((0, 2), np.uint64)], [np.zeros(0, np.int64)]
    for at in range(0, len(words), 2_000):
        some = words[at : at + 2_000]
        flat, row, length = _letters(some)
        bits = _code_bits(flat.astype(np.int64), row, len(some))
        out.append(np.packbits(bits, axis=1, bitorder="little").view("<u8"))
        lengths.append(length)
    return np.concatenate(out), np.concatenate(lengths)


def _unpacked(codes: np.ndarray) -> np.ndarray:
    return np.unpackbits(
        np.ascontiguousarray(codes).view(np.uint8), axis=1, bitorder="little"
    )


@dataclass(frozen=True)
class Cells:
    """The first tree. Inner nodes ask for a bit, or with bit -1 for a length above ``above``;
    leaves have bit -2 and their cell's number in ``left``."""

    bit: np.ndarray
    above: np.ndarray
    left: np.ndarray
    right: np.ndarray
    count: int

    def _has(self, codes: np.ndarray, rows: np.ndarray, bit: np.ndarray) -> np.ndarray:
        bit = np.maximum(bit, 0)
        return (codes[rows, bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)

    def own(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The cell of each word."""
        node = np.zeros(len(codes), np.int64)
        rows = np.arange(len(codes))
        while (inner := self.bit[node] > -2).any():
            bit = self.bit[node]
            right = np.where(bit >= 0, self._has(codes, rows, bit), lengths > self.above[node])
            node = np.where(inner, np.where(right, self.right[node], self.left[node]), node)
        return self.left[node]

    def reached(self, codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that may hold a word one edit away from the row's."""
        row, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        lacks = np.zeros((2, len(codes)), np.int8)  # letters to gain, letters to lose
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        while len(row):
            bit = self.bit[node]
            leaf = bit == -2
            found.append((row[leaf], self.left[node[leaf]]))
            row, node, bit, lacks = row[~leaf], node[~leaf], bit[~leaf], lacks[:, ~leaf]
            by_bit, has = bit >= 0, self._has(codes, row, bit)
            length, above = lengths[row], self.above[node]
            right, left = lacks.copy(), lacks.copy()
            right[0] += by_bit & ~has
            left[1] += by_bit & has
            go_right = np.where(by_bit, (right <= 1).all(axis=0), length + 1 > above)
            go_left = np.where(by_bit, (left <= 1).all(axis=0), length - 1 <= above)
            row = np.concatenate([row[go_left], row[go_right]])
            node = np.concatenate([self.left[node[go_left]], self.right[node[go_right]]])
            lacks = np.concatenate([left[:, go_left], right[:, go_right]], axis=1)
        return tuple(map(np.concatenate, zip(*found, strict=True)))


def fit_cells(codes: np.ndarray, lengths: np.ndarray, size: int) -> Cells:
    """Cells of ``size`` sampled words at most, split at the most even question."""
    bits = _unpacked(codes) if len(codes) else np.zeros((0, _BITS), np.uint8)
    nodes, cells = [], 0
    waiting = [np.arange(len(codes))]
    while len(nodes) < len(waiting):
        rows = waiting[len(nodes)]
        share = bits[rows].mean(axis=0) if len(rows) else np.zeros(_BITS)
        bit = int(np.abs(share - 0.5).argmin())
        above = int(np.sort(lengths[rows])[(len(rows) - 1) // 2]) if len(rows) else 0
        longer = (lengths[rows] > above).mean() if len(rows) else 0
        if len(rows) <= size or (share[bit] in (0, 1) and longer == 0):
            nodes.append((-2, 0, cells, 0))
            cells += 1
            continue
        if abs(longer - 0.5) <= abs(share[bit] - 0.5):
            bit, right = -1, lengths[rows] > above
        else:
            right = bits[rows, bit] == 1
        nodes.append((bit, above, len(waiting), len(waiting) + 1))
        waiting += [rows[~right], rows[right]]
    columns = np.array(nodes, np.int64).T
    return Cells(*columns, cells)


class Tree:
    """A k-d tree over the codes of words of one length."""

    def __init__(self, words: np.ndarray, codes: np.ndarray) -> None:
        self.words = words
        bits = _unpacked(codes)
        order, bounds, children = [], [], []
        every, some = [], []
        waiting = [np.arange(len(codes))]
        placed = 0
        while len(children) < len(waiting):
            rows = waiting[len(children)]
            every.append(np.bitwise_and.reduce(codes[rows], axis=0))
            some.append(np.bitwise_or.reduce(codes[rows], axis=0))
            share = np.abs(bits[rows].mean(axis=0) - 0.5) if len(rows) > LEAF else np.full(1, 0.5)
            bit = int(share.argmin())
            if share[bit] >= 0.5:
                children.append((-1, -1))
                bounds.append((placed, placed + len(rows)))
                placed += len(rows)
                order.append(rows)
                continue
            right = bits[rows, bit] == 1
            children.append((len(waiting), len(waiting) + 1))
            bounds.append((0, 0))
            waiting += [rows[~right], rows[right]]
        self.order = np.concatenate(order)
        self.codes = np.ascontiguousarray(codes[self.order])
        self.every, self.some = np.array(every), np.array(some)
        self.children, self.bounds = np.array(children), np.array(bounds)

    def near(self, codes: np.ndarray, gain: int, lose: int) -> Iterator[tuple]:
        """(row of ``codes``, place in the tree's words) of those within reach: by counts, no
        more than ``gain`` letters to gain and ``lose`` letters to lose."""
        row, node = np.arange(len(codes)), np.zeros(len(codes), np.int64)
        rows, leaves = [], []
        while len(row):
            own = codes[row]
            gains = np.bitwise_count(self.every[node] & ~own).sum(axis=1)
            loses = np.bitwise_count(own & ~self.some[node]).sum(axis=1)
            fits = (gains <= gain) & (loses <= lose)
            row, node = row[fits], node[fits]
            leaf = self.children[node, 0] < 0
            rows.append(row[leaf])
            leaves.append(node[leaf])
            row, node = np.repeat(row[~leaf], 2), self.children[node[~leaf]].reshape(-1)
        row, leaf = np.concatenate(rows), np.concatenate(leaves)
        sizes = self.bounds[leaf, 1] - self.bounds[leaf, 0]
        ends = np.cumsum(sizes)
        at = 0
        while at < len(row):
            base = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, base + COMPARED, "right")))
            asking = np.repeat(row[at:to], sizes[at:to])
            offset = self.bounds[leaf[at:to], 0] - (ends[at:to] - sizes[at:to] - base)
            place = np.repeat(offset, sizes[at:to]) + np.arange(len(asking))
            own, other = codes[asking], self.codes[place]
            fits = np.bitwise_count(other & ~own).sum(axis=1) <= gain
            fits &= np.bitwise_count(own & ~other).sum(axis=1) <= lose
            yield asking[fits], self.order[place[fits]]
            at = to


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of two matrices of letters differ by exactly one edit; ``b`` is as wide, or wider
    by one letter."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    apart = a != b[:, :-1]
    first = np.where(apart.any(axis=1), apart.argmax(axis=1), a.shape[1])
    apart = (a != b[:, 1:])[:, ::-1]
    last = np.where(apart.any(axis=1), a.shape[1] - 1 - apart.argmax(axis=1), -1)
    return last < first


def _matrix(words: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(words), np.uint8).reshape(len(words), -1)


class Index:
    """The words of a cell, a tree per length."""

    def __init__(self, words: list[bytes], counts: np.ndarray) -> None:
        self.trees, self.of = {}, {}
        codes, lengths = codes_of(words)
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            # In order of larger count, then letters: a smaller place is a better form.
            rows = np.array(sorted(rows.tolist(), key=lambda i: (-counts[i], words[i])))
            held = _matrix([words[i] for i in rows])
            self.trees[length] = Tree(held, codes[rows])
            self.of[length] = counts[rows]

    def search(self, words: list[bytes]) -> tuple[np.ndarray, list]:
        """How many near words each word has here, and (count, word) of its best or None."""
        total = np.zeros(len(words), np.int64)
        best: list = [None] * len(words)
        codes, lengths = codes_of(words)
        for length in np.unique(lengths).tolist():
            rows = np.flatnonzero(lengths == length)
            asking = _matrix([words[i] for i in rows])
            for other, gain, lose in (
                (length - 1, 0, 1),
                (length, 1, 1),
                (length + 1, 1, 0),
            ):
                if other in self.trees:
                    self._pairs(rows, asking, codes[rows], other, gain, lose, total, best)
        return total, best

    def _pairs(self, rows, asking, codes, other, gain, lose, total, best) -> None:
        tree, counts = self.trees[other], self.of[other]
        step = max(1, COMPARED_BYTES // (2 * other))
        for i, j in tree.near(codes, gain, lose):
            good = []
            for k in range(0, len(i), step):
                a, b = asking[i[k : k + step]], tree.words[j[k : k + step]]
                good.append(one_edit(a, b) if gain else one_edit(b, a))
            good = np.concatenate([*good, np.zeros(0, bool)])
            i, j = i[good], j[good]
            if not len(i):
                continue
            total += np.bincount(rows[i], minlength=len(total))
            order = np.lexsort((j, i))
            firsts = order[np.flatnonzero(np.diff(i[order], prepend=-1))]
            for row, place in zip(rows[i[firsts]].tolist(), j[firsts].tolist(), strict=True):
                found = (-int(counts[place]), tree.words[place].tobytes())
                if best[row] is None or found < best[row]:
                    best[row] = found


def word_counts(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    every: int = 31,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """(word, n) of the distinct words: runs of letters with A-Z lower-cased, and of those whose
    crc32 of ``<id>:<run>`` is divisible by ``every`` one letter deleted.

    ``every`` 0 deletes none. A null text has no words, a null id is an empty text.
    """
    lower = ascii_lower(F.coalesce(F.col(text_column), F.lit("")))
    runs = F.regexp_extract_all(lower, F.lit(f"([{LETTERS}]{{{least_length},}})"), F.lit(1))
    frame = docs.select(
        F.coalesce(F.col(id_column).cast("string"), F.lit("")).alias("name"),
        F.explode(runs).alias("run"),
    )
    word: Column = F.col("run")
    if every:
        frame = frame.withColumn("h", F.crc32(F.concat("name", F.lit(":"), "run").cast("binary")))
        place = (F.col("h") % F.length("run")).cast("int")
        shorter = F.concat(
            F.substring(F.col("run"), F.lit(1), place),
            F.substring(F.col("run"), place + 2, F.length("run")),
        )
        word = F.when(F.col("h") % every == 0, shorter).otherwise(F.col("run"))
    return (
        frame.select(word.alias("word"))
        .where(F.length("word") >= least_length)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") >= least_count)
    )


def _latin(batch: pa.RecordBatch) -> list[bytes]:
    return [word.encode("latin-1") for word in batch.column("word").to_pylist()]


def _near(words: DataFrame) -> DataFrame:
    """(word, n_near, form_n, form) from every cell that has near words of a word."""
    spark = words.sparkSession
    number = words.count()
    rate = max(number // (SAMPLED * max(1, -(-number // CELL))), 1)
    sample = words.select("word").where(F.pmod(F.xxhash64("word"), F.lit(rate)) == 0)
    # SAMPLED words for every CELL words: a cell's share of the driver is some 10 KB.
    codes, lengths = codes_of([row.word.encode("latin-1") for row in sample.collect()])
    cells = fit_cells(codes, lengths, max(SAMPLED, 1))

    def own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("cell", pa.array(cells.own(*codes_of(_latin(batch)))))

    placed = stage(words.select("word", "n").mapInArrow(own, "word string, n long, cell long"), "words")
    sizes = {
        row["cell"]: -(-row["count"] // (2 * CELL))
        for row in placed.groupBy("cell").count().collect()  # one row per cell
    }
    across = np.array([sizes.get(cell, 1) for cell in range(cells.count)], np.int64)
    parts = spark.createDataFrame(list(enumerate(across.tolist())), "cell long, parts long")

    def asked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, len(whole), 2_000):
                batch = whole.slice(at, 2_000)
                row, cell = cells.reached(*codes_of(_latin(batch)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("word").take(pa.array(row)), pa.array(cell)], ["word", "cell"]
                )

    index = placed.join(F.broadcast(parts), "cell").select(
        "cell",
        F.pmod(F.xxhash64("word", F.lit(7)), F.col("parts")).alias("part"),
        F.lit(0).alias("role"),
        "word",
        "n",
    )
    asking = (
        placed.select("word")
        .mapInArrow(asked, "word string, cell long")
        .join(F.broadcast(parts), "cell")
        .select(
            "cell",
            F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"),
            F.lit(1).alias("role"),
            "word",
            F.lit(0).cast("long").alias("n"),
        )
    )
    met = (
        index.union(asking)
        .withColumn("block", F.col("cell") * (1 << 24) + F.col("part"))
        .select("block", "role", "word", "n")
        .repartition("block")
        .sortWithinPartitions("block", "role")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, counts, index = None, [], [], None
        for batch in batches:
            blocks, roles = (batch.column(c).to_numpy() for c in ("block", "role"))
            cuts = np.flatnonzero((np.diff(blocks) != 0) | (np.diff(roles) != 0)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)], strict=True):
                if lo == hi:
                    continue
                part = batch.slice(lo, hi - lo)
                if blocks[lo] != block:
                    block, words, counts, index = blocks[lo], [], [], None
                if roles[lo] == 0:
                    words += _latin(part)
                    counts.append(part.column("n").to_numpy())
                    continue
                if not words and index is None:
                    continue
                if index is None:
                    index, words = Index(words, np.concatenate(counts)), []
                for at in range(0, len(part), SEARCHED):
                    some = part.slice(at, SEARCHED)
                    total, best = index.search(_latin(some))
                    met = np.flatnonzero(total)
                    yield pa.RecordBatch.from_arrays(
                        [
                            some.column("word").take(pa.array(met)),
                            pa.array(total[met]),
                            pa.array([-best[i][0] for i in met.tolist()], pa.int64()),
                            pa.array(
                                [best[i][1].decode("latin-1") for i in met.tolist()], pa.string()
                            ),
                        ],
                        ["word", "near", "best_n", "best"],
                    )

    return (
        met.mapInArrow(search, "word string, near long, best_n long, best string")
        .groupBy("word")
        .agg(
            F.sum("near").alias("n_near"),
            F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("best"),
        )
        .select("word", "n_near", (-F.col("best.less")).alias("form_n"), F.col("best.best").alias("form"))
    )


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for links (word, form) without cycles: the end of each word's chain of forms.

    Every round doubles the steps taken, so rounds grow with the logarithm of the longest chain.
    """
    current = stage(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = stage(current.join(onward, "root", "left"), "roots-onward")
        if not moved.where("next IS NOT NULL").limit(1).count():
            return current
        current = stage(moved.select("word", F.coalesce("next", "root").alias("root")), "roots")


def variants(words: DataFrame, ratio: int = 10) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of distinct ``words`` (word, n).

    ``n_near`` counts the words that differ by one inserted, deleted or replaced letter; ``form``
    is the one of largest ``n`` among them (ties: smallest in code-point order) if that is at least
    ``ratio`` times the word's own, with ``form_n``; ``root`` is the end of the chain of forms, the word
    itself if it has none. Words are of letters below U+0100. An empty table gives no rows. A
    cell that the tree cannot cut, as its words have the same letters, is cut by a hash; the words searched
    there go to each part.
    """
    words = stage(words.select("word", "n"), "distinct")
    near = stage(_near(words), "near")
    formed = stage(
        words.join(near, "word", "left").select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(F.col("form_n") >= F.col("n") * ratio, F.col("form_n")).alias("form_n"),
            F.when(F.col("form_n") >= F.col("n") * ratio, F.col("form")).alias("form"),
        ),
        "forms",
    )
    ends = roots(formed.where("form IS NOT NULL"))
    return formed.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


def spelling_variants(docs: DataFrame, ratio: int = 10, **words: object) -> DataFrame:
    """``variants`` of the words of ``docs``, see ``word_counts`` for its parameters.

    Repeated rows count as often as they occur; other columns are not read.
    """
    return variants(word_counts(docs, **words), ratio)
