"""Token counts without tokens: byte-pair merging with a heap over a linked list.

A piece's symbols are its bytes. The adjacent pair of lowest rank (the
leftmost of equals) is popped and merged until no pair has a rank; the count is
the number of symbols less the number of merges. No token id is ever looked up.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patronage.llm.scan import blocks
from patronage.llm.segments import Segments, literal, once_per_worker


def byte_symbols() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


def merged(symbols: list[int], rank_of: dict[int, int], both_of: list[int]) -> tuple[list[int], int]:
    """Merge to the end; the symbols left and the number of merges.

    ``rank_of`` maps ``left << 20 | right`` to a rank and ``both_of`` a rank to the merged
    symbol. A pair enters the heap when its neighbours change, so a piece of n
    symbols takes O(n log n).
    """
    n = len(symbols)
    rank = rank_of.get
    heap = []
    for i in range(n - 1):
        r = rank(symbols[i] << 20 | symbols[i + 1])
        if r is not None:
            heap.append(r << 32 | i)
    if not heap:
        return symbols, 0
    symbols = list(symbols)
    after = [*range(1, n), -1]
    before = [*range(-1, n - 1)]
    heapify(heap)
    merges = 0
    while heap:
        top = heappop(heap)
        i, r = top & 0xFFFFFFFF, top >> 32
        j = after[i]
        if symbols[i] < 0 or j < 0 or rank(symbols[i] << 20 | symbols[j]) != r:
            continue  # one of the two has been merged since
        both = symbols[i] = both_of[r]
        symbols[j] = -1
        merges += 1
        k = after[i] = after[j]
        if k >= 0:
            before[k] = i
            r = rank(both << 20 | symbols[k])
            if r is not None:
                heappush(heap, r << 32 | i)
        h = before[i]
        if h >= 0:
            r = rank(symbols[h] << 20 | both)
            if r is not None:
                heappush(heap, r << 32 | h)
    return [s for s in symbols if s >= 0], merges


class TokenCounter:
    """Counts tokens as the library reading the same vocabulary file counts them."""

    def __init__(self, vocabulary: str, pattern: str) -> None:
        with open(vocabulary, encoding="utf-8") as file:
            settings = json.load(file)
        splitter = settings["pre_tokenizer"]
        if settings["model"]["type"] != "BPE" or splitter != {
            "type": "ByteLevel",
            "add_prefix_space": False,
            "trim_offsets": True,
            "use_regex": True,
        }:
            raise ValueError(f"{vocabulary} is not a byte-level BPE vocabulary of the known form")
        names = {name: b for b, name in byte_symbols().items()}
        self.ranks: dict[int, int] = {}
        self.both: list[int] = []
        for rank, (left, right) in enumerate(settings["model"]["merges"]):
            self.ranks[names[left] << 20 | names[right]] = rank
            self.both.append(names.setdefault(left + right, len(names)))
        self.special = [t["content"] for t in settings["added_tokens"] if t["special"]]
        self.cut = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None
        self.pattern = regex.compile(pattern)
        self.reset()

    def reset(self) -> None:
        self.segments = Segments()
        self.counts: list[int] = []
        self.pieces: dict[str, int] = {}

    def piece_count(self, piece: str) -> int:
        count = self.pieces.get(piece)
        if count is None:
            data = piece.encode()
            count = len(data) - merged(list(data), self.ranks, self.both)[1]
            if len(data) <= 64:
                self.pieces[piece] = count
        return count

    def _plain(self, text: str) -> int:
        numbers = self.segments.numbers(text)
        if fresh := self.segments.take_fresh():
            for key in fresh:
                self.counts.append(
                    sum(map(self.piece_count, self.pattern.findall(literal(key))))
                )
            self.segments.forget_long(fresh)
        return sum(map(self.counts.__getitem__, numbers))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.segments.full():
            self.reset()
        if self.cut is None or not any(s in text for s in self.special):
            return self._plain(text)
        parts = self.cut.split(text)
        return sum(map(self._plain, parts)) + len(parts) - 1


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_tokens, over_limit (more than ``limit``).

    Null and empty texts have no bytes and no tokens. The text of a special
    token counts as that token wherever it stands. Rows are independent: ties,
    repeated rows and other columns change nothing, an empty table gives no rows.
    ``vocabulary`` must be readable at the same path on every executor.
    """

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = once_per_worker(
            "counter", (vocabulary, pattern), lambda: TokenCounter(vocabulary, pattern)
        )
        for batch in batches:
            for block in blocks(batch, "text"):
                texts = block.column("text")
                counts = [counter.count(text.as_py()) for text in texts]
                yield pa.RecordBatch.from_arrays(
                    [block.column("doc_id"), pa.array(np.array(counts, np.int64))],
                    names=["doc_id", "n_tokens"],
                ).append_column("n_bytes", block.column("n_bytes"))

    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).alias("text"),
        F.coalesce(F.octet_length(F.col(text_column)).cast("long"), F.lit(0)).alias("n_bytes"),
    )
    return rows.mapInArrow(tasks, "doc_id long, n_tokens long, n_bytes long").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
