"""Byte-level BPE encoding and decoding with DuckDB inside each task.

Encoding is a recursive query over token positions: every round joins a word's
adjacent tokens to the merge table, contracts the leftmost pair of minimum
rank, and stops when no pair has a rank. Each distinct word of a task
goes through it once. Decoding joins token ids to their bytes and aggregates
them in order of position.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from patronage.llm.scan import blocks
from patronage.llm.segments import Segments, literal, once_per_worker
from patronage.llm.token_count import merged

#: Bytes of the longest word that the recursive query takes, as its positions fit in eight
#: bits; a longer word would need a round per merge over all its positions, so the heap
#: of ``token_count`` merges it.
LONGEST_WORD = 255
#: Ids that one query decodes.
DECODED = 500_000
#: Words encoded by one recursive query.
WORDS_AT_ONCE = 30_000
#: Rows that one recursive query may make, as it keeps every round: a word of n bytes
#: has n rounds at most, of one row less each. DuckDB holds so many within its memory.
ROWS_AT_ONCE = 2_000_000
#: Bytes of text handled at once.
BLOCK_BYTES = 2 << 20

_ENCODE = """
WITH RECURSIVE walk(step, w, p, q, a, b, r) AS (
    SELECT 0, s.w, s.p, s.q, s.a, s.b, m.r
    FROM symbols s LEFT JOIN merges m ON m.ab = s.a * 1048576 + s.b
    UNION ALL
    SELECT n.step, n.w, n.p, n.q, n.a, n.b, m.r
    FROM (
        SELECT t.step + 1 AS step, t.w,
               CASE WHEN t.p = c.best & 255 THEN ((c.best >> 8) & 255)::INTEGER ELSE t.p END AS p,
               t.q,
               CASE WHEN t.p = c.best & 255 THEN c.best >> 16 ELSE t.a END AS a,
               CASE WHEN t.q = (c.best >> 8) & 255 THEN c.best >> 16 ELSE t.b END AS b
        FROM walk t
        JOIN (
            SELECT w, min(r * 65536 + p * 256 + q) AS best FROM walk WHERE r IS NOT NULL GROUP BY w
        ) c ON c.w = t.w
        WHERE t.p <> (c.best >> 8) & 255
    ) n LEFT JOIN merges m ON m.ab = n.a * 1048576 + n.b
)
SELECT w.w, w.a
FROM walk w JOIN (SELECT w, max(step) AS step FROM walk GROUP BY w) last
  ON last.w = w.w AND last.step = w.step
ORDER BY w.w, w.p
"""

_DECODE = """
SELECT t.doc, string_agg(v.bytes, '' ORDER BY t.pos) AS bytes
FROM tokens t JOIN vocabulary v ON v.id = t.id
GROUP BY t.doc
"""


def read_ranks(path: str) -> dict[bytes, int]:
    """A vocabulary file of lines "base64 rank"."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


def portions(sizes: list[int]) -> Iterator[slice]:
    """Runs of words for one recursive query each, by number and by the rows they can make."""
    begin, rows = 0, 0
    for i, size in enumerate(sizes):
        more = size * (size + 1) // 2
        if i > begin and (rows + more > ROWS_AT_ONCE or i - begin == WORDS_AT_ONCE):
            yield slice(begin, i)
            begin, rows = i, 0
        rows += more
    if begin < len(sizes):
        yield slice(begin, len(sizes))


class ByteBpe:
    """Encoder and decoder of one vocabulary, with a DuckDB connection of its own."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        ranks = read_ranks(vocabulary)
        self.pattern = regex.compile(pattern)
        self.whole = ranks
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        pairs = {
            ranks[token[:i]] << 20 | ranks[token[i:]]: rank
            for token, rank in ranks.items()
            for i in range(1, len(token))
            if token[:i] in ranks and token[i:] in ranks
        }
        self.pairs, self.product = pairs, range(max(ranks.values()) + 1)
        self.duck = duckdb.connect(
            config={"threads": 1, "memory_limit": "400MB", "temp_directory": ""}
        )
        self._table("merges", ab=np.array([*pairs]), r=np.array([*pairs.values()]))
        hexes = pa.array([token.hex() for token in ranks])
        self._table("vocabulary", id=np.array([*ranks.values()]), bytes=hexes)
        self.reset()

    def _table(self, name: str, **columns) -> None:
        arrow = pa.table(columns)
        self.duck.register("arrow_rows", arrow)
        self.duck.execute(f"CREATE TABLE {name} AS SELECT * FROM arrow_rows")
        self.duck.unregister("arrow_rows")

    def reset(self) -> None:
        self.segments = Segments()
        self.ids = np.zeros(1 << 16, np.uint32)
        self.used = 0
        self.begin = np.zeros(1 << 12, np.int64)
        self.count = np.zeros(1 << 12, np.int32)

    def words(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        out: list = [None] * len(words)
        rest = []
        for i, word in enumerate(words):
            known = self.whole.get(word)
            if known is not None:
                out[i] = [known]
            elif len(word) > LONGEST_WORD:
                symbols = self.byte[np.frombuffer(word, np.uint8)].tolist()
                out[i] = merged(symbols, self.pairs, self.product)[0]
            else:
                rest.append(i)
        for some in portions([len(words[i]) for i in rest]):
            numbers = rest[some]
            for i, ids in zip(numbers, self._recursive([words[i] for i in numbers]), strict=True):
                out[i] = ids
        return out

    def _recursive(self, words: list[bytes]) -> list[list[int]]:
        sizes = np.array([*map(len, words)])
        ends = np.cumsum(sizes)
        data = self.byte[np.frombuffer(b"".join(words), np.uint8)]
        place = np.arange(len(data)) - np.repeat(ends - sizes, sizes)
        following = np.append(data[1:], -1)
        following[ends - 1] = -1
        self.duck.register(
            "symbols",
            pa.table(
                {
                    "w": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
                    "p": place.astype(np.int32),
                    "q": (place + 1).astype(np.int32),
                    "a": data,
                    "b": following,
                }
            ),
        )
        found = self.duck.execute(_ENCODE).fetchnumpy()
        self.duck.unregister("symbols")
        cuts = np.flatnonzero(np.diff(found["w"])) + 1
        ids = found["a"].tolist()
        bounds = [0, *cuts.tolist(), len(ids)]
        return [ids[i:j] for i, j in zip(bounds[:-1], bounds[1:], strict=True)]

    def _learn(self, keys: list[str]) -> None:
        pieces: dict[bytes, int] = {}
        per_key = [
            [pieces.setdefault(p.encode(), len(pieces)) for p in self.pattern.findall(literal(key))]
            for key in keys
        ]
        ids = self.words([*pieces])
        flat = [i for numbers in per_key for n in numbers for i in ids[n]]
        counts = [sum(len(ids[n]) for n in numbers) for numbers in per_key]
        first, last = self.segments.size - len(keys), self.segments.size
        while len(self.ids) < self.used + len(flat):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        while len(self.begin) < last:
            self.begin = np.concatenate([self.begin, np.zeros_like(self.begin)])
            self.count = np.concatenate([self.count, np.zeros_like(self.count)])
        self.ids[self.used : self.used + len(flat)] = flat
        self.count[first:last] = counts
        self.begin[first:last] = self.used + np.cumsum([0, *counts[:-1]])
        self.used += len(flat)
        self.segments.forget_long(keys)

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and the bounds of each text's."""
        if self.segments.full():
            self.reset()
        numbers = [self.segments.numbers(text) if text else [] for text in texts]
        if fresh := self.segments.take_fresh():
            self._learn(fresh)
        flat = np.fromiter((n for some in numbers for n in some), np.int64)
        counts = self.count[flat].astype(np.int64)
        ends = np.cumsum(counts)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(
            self.begin[flat] - (ends - counts), counts
        )
        bounds = np.concatenate([[0], np.cumsum([*map(len, numbers)])])
        return self.ids[at], np.concatenate([[0], ends])[bounds]

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each text, by runs of ``DECODED`` ids at most, whatever a text's length."""
        texts = np.repeat(np.arange(len(bounds) - 1, dtype=np.int32), np.diff(bounds))
        out: list[list[bytes]] = [[] for _ in range(len(bounds) - 1)]
        for at in range(0, len(ids), DECODED):
            run = ids[at : at + DECODED]
            self.duck.register(
                "tokens",
                pa.table(
                    {
                        "doc": texts[at : at + DECODED],
                        "pos": np.arange(len(run), dtype=np.int32),
                        "id": run,
                    }
                ),
            )
            for doc, text in self.duck.execute(_DECODE).fetchall():
                out[doc].append(bytes.fromhex(text))
            self.duck.unregister("tokens")
        return [b"".join(parts) for parts in out]


def _coder(vocabulary: str, pattern: str) -> ByteBpe:
    return once_per_worker("bpe", (vocabulary, pattern), lambda: ByteBpe(vocabulary, pattern))


def round_trip(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids_sha256, decoded_sha256.

    The digests are of the ids as little-endian unsigned 32-bit integers and of
    the bytes that the ids decode to. Null and empty texts have no ids. Rows are
    independent: repeated rows and other columns change nothing, an empty table gives
    no rows. ``vocabulary`` must be readable at the same path on every executor.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, pattern)
        for batch in batches:
            for block in blocks(batch, "text", BLOCK_BYTES):
                ids, bounds = coder.encode(block.column("text").to_pylist())
                texts = coder.decode(ids, bounds)
                raw = memoryview(ids.astype("<u4").tobytes())
                digests = [
                    hashlib.sha256(raw[4 * i : 4 * j]).hexdigest()
                    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        block.column("doc_id"),
                        pa.array(np.diff(bounds)),
                        pa.array(digests),
                        pa.array([hashlib.sha256(text).hexdigest() for text in texts]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return rows.mapInArrow(
        tasks, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def encode(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    text_column: str = "text",
    to: str = "ids",
    decoded_to: str | None = None,
) -> DataFrame:
    """``docs`` with an array column ``to`` of the token ids of each text (null: no ids).

    With ``decoded_to``, also with a column of the SHA-256 of the bytes that the ids
    decode to. Long texts are one row like any other, and decoded in runs of ``DECODED`` ids. All columns of ``docs`` stay, but those of the new names are replaced.
    """
    new = {to: T.ArrayType(T.IntegerType())} | (
        {decoded_to: T.StringType()} if decoded_to else {}
    )
    kept, names = _numbered(docs.drop(*new))
    place = names.index(text_column)
    schema = T.StructType([*kept.schema.fields])
    for name, kind in new.items():
        schema = schema.add(name, kind)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, pattern)
        for batch in batches:
            for block in blocks(batch, place, BLOCK_BYTES):
                ids, bounds = coder.encode(block.column(place).to_pylist())
                columns = [
                    pa.ListArray.from_arrays(
                        pa.array(bounds.astype(np.int32)), pa.array(ids.astype(np.int32))
                    )
                ]
                if decoded_to:
                    texts = coder.decode(ids, bounds)
                    columns.append(pa.array([hashlib.sha256(t).hexdigest() for t in texts]))
                yield pa.RecordBatch.from_arrays(
                    [*block.columns, *columns], [*block.schema.names, *new]
                )

    return kept.mapInArrow(tasks, schema).toDF(*names, *new)


def _numbered(rows: DataFrame) -> tuple[DataFrame, list[str]]:
    """``rows`` under plain column names, as Python operators read no others, and the real ones."""
    return rows.toDF(*(f"c{i}" for i in range(len(rows.columns)))), rows.columns


def decode(
    rows: DataFrame, vocabulary: str, pattern: str, ids_column: str = "ids", to: str = "decoded"
) -> DataFrame:
    """``rows`` with a binary column ``to`` of the bytes that the ids decode to (null: none)."""
    kept, names = _numbered(rows.drop(to))
    place = names.index(ids_column)
    schema = T.StructType([*kept.schema.fields]).add(to, T.BinaryType())

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(vocabulary, pattern)
        for batch in batches:
            for at in range(0, len(batch), 500):
                block = batch.slice(at, 500)
                lists = block.column(place)
                sizes = [0 if n is None else n for n in pc.list_value_length(lists).to_pylist()]
                texts = coder.decode(
                    pc.list_flatten(lists).to_numpy(zero_copy_only=False).astype(np.uint32),
                    np.cumsum([0, *sizes]),
                )
                yield pa.RecordBatch.from_arrays(
                    [*block.columns, pa.array(texts, pa.binary())], [*block.schema.names, to]
                )

    return kept.mapInArrow(tasks, schema).toDF(*names, to)
