"""Token ids as compact binary files in document order.

A tokenizer file's library turns every distinct part of the pieces between spaces into ids
once per worker. The ids are counted over all documents and renumbered by falling frequency, so
that nearly all take one byte. A document's numbers are written in groups of four: a control
byte with four two-bit lengths goes to one stream, the numbers' one to four bytes go to
another. Tables with an entry per control byte tell how far a group reaches and where each byte of
its four numbers stands, so numpy decodes whole blocks by lookups.

A folder holds ``ids.npy`` (the ids by falling frequency), ``manifest`` (one row per file)
and files of blocks. Files are ranges of the documents' order, each written by one task under its
final name only when it is whole; a task that runs twice writes the same file.
"""

from __future__ import annotations

import io
import json
import os
import re
import string
import struct
import uuid
import zlib
from collections.abc import Iterator
from contextlib import contextmanager
from itertools import chain, repeat
from typing import BinaryIO
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patronage.llm.scan import blocks, text_bytes
from patronage.llm.segments import once_per_worker
from patronage.session import scratch_path, stage

#: Pieces, and characters of them, kept in a worker's memory; beyond, it starts anew.
KEPT_PIECES = 800_000
KEPT_CHARACTERS = 32 << 20
#: Parts whose ids are held as lists at once.
LEARNED_AT_ONCE = 20_000
#: Bytes of texts whose pieces are looked up at once, or one text.
BLOCK_BYTES = 8 << 20
#: Ids of a block of a file, unless a single document has more.
BLOCK_IDS = 1 << 20

_HEADER = struct.Struct("<4sIQQ")
_MARK = b"TID1"
_MANIFEST = "part long, path string, documents long, ids long"
_GROUPS = 1 << 14

_lengths = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3) + 1
#: Bytes that the four numbers of a control byte take.
_REACH = _lengths.sum(axis=1)
#: 255 for each of the 16 bytes of four numbers that is written, 0 for one that is left out.
_THERE = np.where(np.arange(4) < _lengths[:, :, None], 255, 0).astype(np.uint8).reshape(256, 16)
#: Places of those that are written.
_PLACES = np.where(
    np.arange(4) < _lengths[:, :, None],
    (np.cumsum(_lengths, axis=1) - _lengths)[:, :, None] + np.arange(4),
    0,
).astype(np.int32).reshape(256, 16)
#: Four flags, as one number, of the bytes that a number of one to four bytes takes.
_TAKEN = np.array([0x1, 0x101, 0x10101, 0x1010101], "<u4")


def pack(numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Control bytes and data bytes of unsigned 32-bit numbers, filled up to whole groups with 0."""
    numbers = np.pad(numbers.astype("<u4"), (0, -len(numbers) % 4))
    extra = (numbers > 0xFF).view(np.uint8) + (numbers > 0xFFFF).view(np.uint8)
    extra += (numbers > 0xFFFFFF).view(np.uint8)
    quads = extra.reshape(-1, 4)
    control = quads[:, 0] | quads[:, 1] << 2 | quads[:, 2] << 4 | quads[:, 3] << 6
    return control, numbers.view(np.uint8)[_TAKEN[extra].view(bool)]


def unpack(control: np.ndarray, data: np.ndarray) -> np.ndarray:
    """The numbers of whole groups."""
    out = np.empty((len(control), 4), "<u4")
    ends = np.cumsum(_REACH[control])
    for at in range(0, len(control), _GROUPS):
        some = control[at : at + _GROUPS]
        base = int(ends[at - 1]) if at else 0
        part = data[base : int(ends[at + len(some) - 1])]
        starts = (ends[at : at + len(some)] - _REACH[some] - base).astype(np.int32)
        octets = part[starts[:, None] + _PLACES[some]] & _THERE[some]
        out[at : at + len(some)] = octets.view("<u4")
    return out.reshape(-1)


#: Ends of pieces before their last punctuation that are matches of their own: of ASCII, or
#: letters that are one code point in every normal form.
_SIMPLE = r"^(?:[\x00-\x7F]*[0-9A-Za-z]|[A-Za-zÀ-ÖØ-öø-ÿ]+)$"
_PLAIN = re.compile("[a-zß-öø-ÿ]+")
#: How byte-level vocabularies show bytes without a printable sign.
_SHOWN = {
    b: chr(256 + i)
    for i, b in enumerate([*range(0x21), *range(0x7F, 0xA1), 0xAD])
}


def _spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places of some spans one after another."""
    places = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    places += np.arange(len(places))
    return places


class Pieces:
    """Ids of texts by a tokenizer file, each distinct part of a piece worked out once.

    No match of the tokenizer's pattern and no normalisation reaches across a space, so a
    text's ids are those of its pieces in order. Where the tokenizer lower-cases and takes any white
    space for a space, pieces also end at line ends and tabs, and one that ends in punctuation is
    two matches, of which the first does not depend on the case of letters. Only these parts are
    kept and given to the tokenizer's library; pieces are put together from them block by block.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        with open(path, encoding="utf-8") as file:
            self.splits = _splits_punctuation(json.load(file))
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[str, int] = {}
        self.characters = 0
        self.ids, self.used = np.zeros(1 << 16, self.width), 0
        self.ends = np.zeros(1 << 16, np.int64)

    def _cut(self, pieces: pa.Array) -> tuple[pa.Array, pa.Array]:
        """The two parts of each piece; the second is empty if the piece is one part."""
        stems = pc.ascii_rtrim(pieces, characters=string.punctuation)
        simple = pc.and_not(
            pc.match_substring_regex(stems, _SIMPLE), pc.match_substring(pieces, "<")
        )
        lengths = pc.subtract(pc.binary_length(pieces), pc.binary_length(stems))
        lengths = pc.if_else(simple, lengths, 0).to_numpy(zero_copy_only=False)
        data, bounds = text_bytes(pieces)
        tails = pa.LargeStringArray.from_buffers(
            len(pieces),
            pa.py_buffer(np.append(0, np.cumsum(lengths))),
            pa.py_buffer(data[_spans(bounds[1:] - lengths, lengths)]),
        )
        return pc.if_else(simple, pc.utf8_lower(stems), pieces), tails

    def _encoded(self, parts: list[str]) -> list[list[int]]:
        """Ids of parts: plain words by the file's merges alone, as nothing else changes them."""
        merges, found, others = self.tokenizer.model, [], []
        for i, part in enumerate(parts):
            if self.splits and _PLAIN.fullmatch(part):
                octets = part if part.isascii() else part.encode().decode("latin-1").translate(_SHOWN)
                found.append([token.id for token in merges.tokenize(octets)])
            else:
                found.append([])
                others.append(i)
        for at in range(0, len(others), 4_000):
            some = others[at : at + 4_000]
            encoded = self.tokenizer.encode_batch_fast(
                [parts[i] for i in some], add_special_tokens=False
            )
            for i, one in zip(some, encoded, strict=True):
                found[i] = one.ids
        return found

    def _learn(self, fresh: list[str]) -> None:
        """Number parts that are not known yet."""
        found = self._encoded(fresh)
        ends = self.used + np.cumsum(np.fromiter(map(len, found), np.int64, len(found)))
        while ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : ends[-1]] = np.fromiter(
            chain.from_iterable(found), self.width, ends[-1] - self.used
        )
        first = len(self.numbers)
        while first + len(fresh) >= len(self.ends):
            self.ends = np.concatenate([self.ends, np.zeros_like(self.ends)])
        self.ends[first + 1 : first + 1 + len(fresh)] = ends
        self.used = int(ends[-1])
        self.numbers.update(zip(fresh, range(first, first + len(fresh)), strict=True))
        self.characters += sum(map(len, fresh))

    def _known(self, parts: pa.Array) -> np.ndarray:
        """The number of each part, new ones being learned."""
        met = parts.dictionary_encode()
        distinct = met.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = np.fromiter(map(self.numbers.get, distinct, repeat(-1)), np.int64, len(distinct))
        fresh, first = np.flatnonzero(found < 0), len(self.numbers)
        for at in range(0, len(fresh), LEARNED_AT_ONCE):
            self._learn([distinct[i] for i in fresh[at : at + LEARNED_AT_ONCE].tolist()])
        found[fresh] = np.arange(first, len(self.numbers))
        return found[met.indices.to_numpy()]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some texts one after another, and where each text's begin; null is empty."""
        if len(self.numbers) > KEPT_PIECES or self.characters > KEPT_CHARACTERS:
            self._forget()
        texts = texts.fill_null("").cast(pa.large_string())
        lists = pc.ascii_split_whitespace(texts) if self.splits else pc.split_pattern(texts, " ")
        bounds = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        met = lists.flatten().dictionary_encode()
        parts = self._cut(met.dictionary) if self.splits else [met.dictionary]
        numbers = np.stack([self._known(part) for part in parts], axis=1)
        starts = self.ends[numbers]
        lengths = self.ends[numbers + 1] - starts
        ids = self.ids[_spans(starts.reshape(-1), lengths.reshape(-1))]
        lengths = lengths.sum(axis=1)
        places = met.indices.to_numpy()
        starts, lengths = (np.cumsum(lengths) - lengths)[places], lengths[places]
        return ids[_spans(starts, lengths)], np.append(0, np.cumsum(lengths))[bounds]


def _splits_punctuation(file: dict) -> bool:
    """Whether a tokenizer file is one of the kind whose pieces ``Pieces._cut`` may cut: it
    lower-cases, and matches either letters, a digit, or a run of other characters."""
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    normalizer, splitter = (json.dumps(file[k] or {}) for k in ("normalizer", "pre_tokenizer"))
    return (
        '"Lowercase"' in normalizer and json.dumps(pattern) in splitter and '"ByteLevel"' in splitter
    )


def encode(docs: DataFrame, tokenizer: str, end_id: int | None) -> DataFrame:
    """Staged rows (doc_id, tie, n, ids, row), in no order.

    ``ids`` are ``n`` little-endian integers as a zstd frame, ``tie`` is their crc32.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = once_per_worker("pieces", tokenizer, lambda: Pieces(tokenizer))
        codec = pa.Codec("zstd", compression_level=1)
        last = np.array([] if end_id is None else [end_id], pieces.width).tobytes()
        for batch in batches:
            for part in blocks(batch, "text", BLOCK_BYTES):
                ids, bounds = pieces.encode(part.column("text"))
                size, raw = ids.itemsize, memoryview(ids.view(np.uint8))
                whole = [
                    bytes(raw[i * size : j * size]) + last
                    for i, j in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(map(zlib.crc32, whole), pa.int64()),
                        pa.array([len(ids) // size for ids in whole], pa.int64()),
                        pa.array([codec.compress(ids, asbytes=True) for ids in whole], pa.binary()),
                    ],
                    ["doc_id", "tie", "n", "ids"],
                )

    made = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tasks, "doc_id long, tie long, n long, ids binary"
    )
    return stage(made.withColumn("row", F.monotonically_increasing_id()), "ids")


def _ids(batch: pa.RecordBatch, width: str) -> Iterator[np.ndarray]:
    codec, size = pa.Codec("zstd"), np.dtype(width).itemsize
    for ids, n in zip(batch.column("ids"), batch.column("n").to_pylist(), strict=True):
        yield np.frombuffer(codec.decompress(ids.as_buffer(), n * size), width)


def by_frequency(encoded: DataFrame, width: str, vocabulary: int) -> np.ndarray:
    """All ids of the vocabulary by falling count over all rows, ties by smaller id.

    Tasks add up their counts; a row per id and task is shuffled, a row per id comes back.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(vocabulary, np.int64)
        held, waiting = [], 0
        for batch in batches:
            for ids in _ids(batch, width):
                held.append(ids)
                waiting += len(ids)
                if waiting > BLOCK_IDS:
                    total += np.bincount(np.concatenate(held), minlength=vocabulary)
                    held, waiting = [], 0
        if held:
            total += np.bincount(np.concatenate(held), minlength=vocabulary)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["id", "n"])

    counts = np.zeros(vocabulary, np.int64)
    summed = encoded.select("n", "ids").mapInArrow(tasks, "id long, n long").groupBy("id")
    for row in summed.agg(F.sum("n").alias("n")).collect():  # the vocabulary's size at most
        counts[row.id] = row.n
    return np.argsort(-counts, kind="stable").astype("<u4")


@contextmanager
def _replacing(path: str) -> Iterator[BinaryIO]:
    """A file that gets its name when it is whole."""
    attempt = f"{path}.{uuid.uuid4().hex}"
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        local = urlparse(attempt).path
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "wb") as file:
            yield file
        os.replace(local, parsed.path)
        return
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    system.create_dir(os.path.dirname(place), recursive=True)
    attempt = fs.FileSystem.from_uri(attempt)[1]
    with system.open_output_stream(attempt) as file:
        yield file
    system.move(attempt, place)


@contextmanager
def _reading(path: str) -> Iterator[BinaryIO]:
    parsed = urlparse(path)
    if parsed.scheme in ("", "file"):
        with open(parsed.path, "rb") as file:
            yield file
        return
    from pyarrow import fs

    system, place = fs.FileSystem.from_uri(path)
    with system.open_input_stream(place) as file:
        yield file


def _slices(batch: pa.RecordBatch, column: str, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose binary values have ``limit`` bytes at most, or are single rows."""
    ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(batch):
        room = limit + (int(ends[at - 1]) if at else 0)
        to = max(at + 1, int(np.searchsorted(ends, room, "right")))
        yield batch.slice(at, to - at)
        at = to


def _write_block(file: BinaryIO, ids: list, found: list[np.ndarray], rank: np.ndarray) -> None:
    """Write the ids found of some documents, filled up to whole groups each and packed at once."""
    counts = np.fromiter(map(len, found), np.int64, len(found))
    room = counts + -counts % 4
    numbers = np.zeros(room.sum(), "<u4")
    numbers[_spans(np.cumsum(room) - room, counts)] = rank[np.concatenate(found)]
    control, data = pack(numbers)
    known = np.array([i is not None for i in ids], np.uint8)
    file.write(_HEADER.pack(_MARK, len(ids), len(control), len(data)))
    file.write(np.array([i or 0 for i in ids], "<i8").tobytes())
    file.write(known.tobytes())
    file.write(counts.astype("<u8").tobytes())
    file.write(control.tobytes())
    file.write(data.tobytes())


def _blocks(file: BinaryIO) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """(doc ids, numbers of ids of each, numbers of all documents in whole groups) of each block."""
    while head := file.read(_HEADER.size):
        mark, documents, controls, datas = _HEADER.unpack(head)
        if mark != _MARK:
            raise ValueError("not a file of token ids")

        def read(kind: str, n: int) -> np.ndarray:
            return np.frombuffer(file.read(n * np.dtype(kind).itemsize), kind)

        ids, known = read("<i8", documents), read("u1", documents)
        counts = read("<u8", documents).astype(np.int64)
        control = read("u1", controls)
        yield (
            [int(i) if k else None for i, k in zip(ids, known, strict=True)],
            counts,
            unpack(control, read("u1", datas)),
        )


def write_ids(docs: DataFrame, tokenizer: str, end_id: int | None, folder: str) -> None:
    """Encode ``docs`` (doc_id, text) and write their ids to ``folder`` in ascending order of ids.

    Every row is a document of the files, repeated ones too; null counts as an empty text. Null
    ids come first, and rows with equal ids are ordered by their tokens. Ranges of the order are
    cut by a third key, the row's number, so that one id may hold any share of the rows. An empty
    table makes a folder without files. ``end_id`` ends each document unless it is null. Other
    columns of ``docs`` are not read.
    """
    pieces = Pieces(tokenizer)
    width, vocabulary = pieces.width, pieces.tokenizer.get_vocab_size()
    vocabulary = max([vocabulary, *([] if end_id is None else [end_id + 1])])
    encoded = encode(docs, tokenizer, end_id)
    order = by_frequency(encoded, width, vocabulary)
    with _replacing(f"{folder}/ids.npy") as file:
        np.save(file, order)
    rank = np.empty(vocabulary, "<u4")
    rank[order] = np.arange(vocabulary)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        path = f"{folder}/part-{part:08d}.ids"
        documents = total = 0
        batches = (batch for batch in batches if len(batch))
        first = next(batches, None)
        if first is None:
            return
        with _replacing(path) as file:
            held, ids = [], 0
            for batch in chain([first], batches):
                for piece in _slices(batch, "ids"):
                    for doc_id, found in zip(
                        piece.column("doc_id").to_pylist(), _ids(piece, width), strict=True
                    ):
                        n = len(found)
                        if held and ids + n > BLOCK_IDS:
                            _write_block(file, *map(list, zip(*held, strict=True)), rank)
                            held, ids = [], 0
                        held.append((doc_id, found))
                        ids += n
                        documents += 1
                        total += n
            _write_block(file, *map(list, zip(*held, strict=True)), rank)
        yield pa.RecordBatch.from_pylist(
            [{"part": part, "path": path, "documents": documents, "ids": total}]
        )

    written = (
        encoded.repartitionByRange("doc_id", "tie", "row")
        .sortWithinPartitions("doc_id", "tie", "ids", "row")
        .mapInArrow(write, _MANIFEST)
    )
    written.write.parquet(f"{folder}/manifest")


def _files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, start) of the files: the ids before each, from one row per file."""
    manifest = spark.read.schema(_MANIFEST).parquet(f"{folder}/manifest")
    rows = manifest.orderBy("part").collect()  # one per task that wrote
    starts = np.cumsum([0, *(row.ids for row in rows)]).tolist()
    files = [(row.path, start) for row, start in zip(rows, starts, strict=False)]
    frame = spark.createDataFrame(files, "path string, start long")
    return frame.repartition(max(len(files), 1), "path")


def _documents(batches: Iterator[pa.RecordBatch], folder: str) -> Iterator[tuple]:
    """(doc_id, ids before it, ids) of each document, in files' order."""
    with _reading(f"{folder}/ids.npy") as file:
        order = np.load(io.BytesIO(file.read()))
    for batch in batches:
        for row in batch.to_pylist():
            start = row["start"]
            with _reading(row["path"]) as file:
                for ids, counts, numbers in _blocks(file):
                    at = 0
                    for doc_id, n in zip(ids, counts.tolist(), strict=True):
                        yield doc_id, start, order[numbers[at : at + n]]
                        at += n + -n % 4
                        start += n


def _rows(found: Iterator[tuple], names: list[str], kinds: list) -> Iterator[pa.RecordBatch]:
    """Batches of tuples (weight, *values), of bounded weight or a single row."""
    held, total = [], 0

    def batch() -> pa.RecordBatch:
        arrays = [pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names)

    for weight, *values in found:
        if held and (total + weight > BLOCK_IDS or len(held) == 10_000):
            yield batch()
            held, total = [], 0
        held.append(values)
        total += weight
    if held:
        yield batch()


def read_ids(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, ids) of every document in ``folder``; ``start`` counts the ids before it."""

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((len(ids), doc_id, at, ids) for doc_id, at, ids in _documents(batches, folder))
        yield from _rows(
            found, ["doc_id", "start", "ids"], [pa.int64(), pa.int64(), pa.list_(pa.int64())]
        )

    return _files(spark, folder).mapInArrow(tasks, "doc_id long, start long, ids array<long>")


def read_digests(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the ids in the files.

    ``ids_crc32`` is the unsigned crc32 of the ids as little-endian unsigned 32-bit integers.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = (
            (len(ids), doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes()))
            for doc_id, at, ids in _documents(batches, folder)
        )
        names = ["doc_id", "start", "n_tokens", "ids_crc32"]
        yield from _rows(found, names, [pa.int64()] * 4)

    return _files(spark, folder).mapInArrow(
        tasks, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )


def round_trip(docs: DataFrame, tokenizer: str, end_id: int | None = None) -> DataFrame:
    """``read_digests`` of ``docs`` written to a new folder of the shared scratch space."""
    folder = scratch_path(docs.sparkSession, "token-files")
    write_ids(docs, tokenizer, end_id, folder)
    return stage(read_digests(docs.sparkSession, folder), "digests")
