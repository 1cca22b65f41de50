"""Spelling variants, token files and hard negatives beside brute force and edge cases."""

import random
import re
import zlib

import brute
import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm import hard_negatives, spelling, token_files

WORDS = public_tokenizers.path("word_bpe_49k.json")


def brute_words(rows, least=7, count=2, every=31):
    counts = {}
    for doc_id, text in rows:
        for run in re.findall(r"[A-Za-zÀ-ÿ]+", brute.low(text)):
            name = "" if doc_id is None else str(doc_id)
            h = zlib.crc32(f"{name}:{run}".encode())
            if every and h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            counts[run] = counts.get(run, 0) + 1
    return {w: n for w, n in counts.items() if len(w) >= least and n >= count}


def edits(a, b):
    """Whether two words differ by exactly one edit, by trying all of them."""
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def brute_variants(counts, ratio=10):
    form, out = {}, []
    for word, n in counts.items():
        near = [w for w in counts if edits(word, w)]
        best = min(near, key=lambda w: (-counts[w], w), default=None)
        if best is not None and counts[best] >= ratio * n:
            form[word] = best
        out.append([word, form.get(word), None, n, len(near), counts.get(form.get(word))])
    for row in out:
        row[2] = row[0]
        while row[2] in form:
            row[2] = form[row[2]]
    return sorted(map(tuple, out))


def spelt_rows():
    draw = random.Random(5)
    letters = "abcdeé"
    base = ["".join(draw.choice(letters) for _ in range(draw.randint(7, 12))) for _ in range(40)]
    words = []
    for w in base:
        words += [w] * draw.choice([3, 40, 400])
        for _ in range(6):
            at = draw.randrange(len(w))
            other = draw.choice(
                [w[:at] + w[at + 1 :], w[:at] + "b" + w[at:], w[:at] + "c" + w[at + 1 :]]
            )
            words += [other] * draw.choice([2, 2, 4, 40])
    draw.shuffle(words)
    rows = [(i, " ".join(words[i * 50 : i * 50 + 50])) for i in range(len(words) // 50)]
    return [
        *rows,
        (5, None),
        (None, "ÀÉÎÕÜØÞ ÀÉÎÕÜØÞ àéîõüøþ àéîõüøþ ×××××××÷ ×××××××÷"),
        (-7, ""),
        (9, "Z" * 9000 + " " + "z" * 9000 + "," + "Z" * 9001 + ";" + "z" * 9001),
        *[(11, "repeated repeated repeatad repeatad")] * 3,
    ]


def test_spelling_variants(spark, monkeypatch, edge_docs, edge_rows, no_docs):
    rows = spelt_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").select(
        "*", *[F.lit("x").alias(c) for c in ("word", "n", "run", "h", "cell", "form", "name")]
    )
    expected = brute_variants(brute_words(rows))
    assert sum(row[1] is not None for row in expected) > 50
    assert any(row[2] not in (row[0], row[1]) for row in expected), "chains of two forms"
    for cell, sampled, leaf in ((50_000, 200, 24), (60, 30, 4)):
        monkeypatch.setattr(spelling, "CELL", cell)
        monkeypatch.setattr(spelling, "SAMPLED", sampled)
        monkeypatch.setattr(spelling, "LEAF", leaf)
        got = spelling.spelling_variants(docs)
        assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
        assert sorted(map(tuple, got.collect())) == expected
    few = [(row[0], row[1]) for row in edge_rows]
    got = spelling.spelling_variants(edge_docs, least_length=2, every=3, ratio=2)
    assert sorted(map(tuple, got.collect())) == brute_variants(brute_words(few, 2, 2, 3), 2)
    assert spelling.spelling_variants(no_docs).count() == 0


def test_cells_cut_by_a_hash_where_letters_are_the_same(spark, monkeypatch):
    draw = random.Random(1)
    letters = list("abcdefgh")
    words = set()
    while len(words) < 300:
        draw.shuffle(letters)
        words.add("".join(letters))
    words |= {w[:3] + "z" + w[4:] for w in list(words)[:100]} | {w[1:] for w in list(words)[:50]}
    counts = {w: draw.choice([2, 20, 200]) for w in words}
    monkeypatch.setattr(spelling, "CELL", 20)
    monkeypatch.setattr(spelling, "SAMPLED", 20)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    got = spelling.variants(frame)
    assert sorted(map(tuple, got.collect())) == brute_variants(counts)


def test_one_edit_by_letters():
    draw = random.Random(2)
    for _ in range(400):
        a = bytes(draw.choices(b"ab", k=draw.randint(3, 6)))
        b = bytes(draw.choices(b"ab", k=len(a) + draw.randint(0, 1)))
        matrix = [np.frombuffer(w, np.uint8)[None] for w in (a, b)]
        assert spelling.one_edit(*matrix)[0] == edits(a, b)


def brute_ids(rows, end):
    tokenizer = Tokenizer.from_file(WORDS)
    encoded = [
        (doc_id, [*tokenizer.encode(text or "", add_special_tokens=False).ids, end])
        for doc_id, text in rows
    ]
    return sorted(encoded, key=lambda row: (row[0] is not None, row[0] or 0))


def test_token_files(spark, edge_docs, edge_rows, no_docs, tmp_path, monkeypatch):
    odd = [
        (100, "é Éclair  x ́y  Å Å don't 'S it 's ΑΣ <|endoftext|>z"),
        (101, "a<|startoftext|> <|endoftext|>  日本語 ١٢٣ 🙂🙂 x\x00y 가 ﬁ"),
        (102, " "),
        (103, "word " * 5_000),
        (104, "Dogs' DOGS', it's. ('S) x'll.' U.S.A. <|endoftext|>. a<|b|>. 3.14, --- ''s Σας. É. ÉCOLE, ßÀÖ×÷ø! ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞß. x\n, a\x00. a\x1f."),
    ]
    docs = edge_docs.select("doc_id", "text", "ids", "n_tokens", "part").union(
        spark.createDataFrame(odd, "doc_id long, text string").select(
            "*", *[F.lit("x").alias(c) for c in ("ids", "n_tokens", "part")]
        )
    )
    monkeypatch.setattr(token_files, "BLOCK_IDS", 3_000)
    monkeypatch.setattr(token_files, "BLOCK_BYTES", 1_000)
    monkeypatch.setattr(token_files, "KEPT_PIECES", 50)
    rows = [(row[0], row[1]) for row in edge_rows] + odd
    folder = str(tmp_path / "ids")
    token_files.write_ids(docs, WORDS, 2, folder)
    got = sorted(token_files.read_ids(spark, folder).collect(), key=lambda r: r.start)
    expected = brute_ids(rows, 2)
    assert [r.doc_id for r in got] == [doc_id for doc_id, _ in expected]
    assert sorted((r.doc_id or -1, r.ids) for r in got) == sorted(
        (doc_id or -1, ids) for doc_id, ids in expected
    )
    at = 0
    for row in got:
        assert row.start == at
        at += len(row.ids)
    digests = token_files.read_digests(spark, folder).orderBy("start").collect()
    assert [tuple(r) for r in digests] == [
        (r.doc_id, r.start, len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes())) for r in got
    ]
    assert token_files.round_trip(no_docs, WORDS, 2).count() == 0


def test_parts_of_pieces_are_worked_out_once_whatever_stands_beside_them(monkeypatch):
    monkeypatch.setattr(token_files, "LEARNED_AT_ONCE", 7)
    words = ["dog", "Éclair", "naïve", "THE", "it's", "3.14", "a<b", "日本語"]
    pairs = [f"{a}{end}{b}" for a in words for b in words for end in (".\n", ",\r\n", "!!\t", "\n")]
    pairs += [f"{case(word)}{end}" for word in words for case in (str.upper, str.title) for end in ("", ".", "?!")]
    texts = [" ".join(pairs), None, "", "\n", *pairs]
    pieces = token_files.Pieces(WORDS)
    ids, bounds = pieces.encode(pa.array(texts))
    library = Tokenizer.from_file(WORDS)
    for text, i, j in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[i:j].tolist() == library.encode(text or "", add_special_tokens=False).ids
    assert len(pieces.numbers) < 60  # of 297 strings between spaces


def test_any_sign_between_words_is_encoded_as_by_the_library():
    signs = [*map(chr, range(0x100)), *"\u0130\u0301\u1680\u2003\u2028\u3000\ufeff\u00ad\u03a3"]
    texts = [f"Ab{x}Cd. {x}E{x}, F.{x} {x}{x} <{x}|endoftext|>{x}<|ENDOFTEXT|>" for x in signs]
    ids, bounds = token_files.Pieces(WORDS).encode(pa.array(texts))
    library = Tokenizer.from_file(WORDS)
    for text, i, j in zip(texts, bounds[:-1], bounds[1:], strict=True):
        assert ids[i:j].tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents_of_a_block_are_packed_at_once(tmp_path, monkeypatch):
    draw, calls = np.random.default_rng(5), []
    found = [draw.integers(0, 400, n).astype("<u2") for n in (0, 1, 4, 7, 0, 1001)]
    rank = np.arange(400, dtype="<u4")[::-1] * 200
    path = tmp_path / "block"
    with open(path, "wb") as file, monkeypatch.context() as patch:
        pack = token_files.pack
        patch.setattr(token_files, "pack", lambda numbers: calls.append(1) or pack(numbers))
        token_files._write_block(file, [None, 1, 2, 3, 4, 5], found, rank)
    assert len(calls) == 1
    with open(path, "rb") as file:
        ((ids, counts, numbers),) = token_files._blocks(file)
    assert ids == [None, 1, 2, 3, 4, 5] and counts.tolist() == list(map(len, found))
    expected = [np.pad(rank[f], (0, -len(f) % 4)) for f in found]
    assert (numbers == np.concatenate(expected)).all()


def test_one_id_for_many_rows_is_cut_into_ranges(spark):
    docs = spark.range(4_000).select(
        F.lit(7).alias("doc_id"), F.concat(F.lit("same words "), F.col("id") % 2).alias("text")
    )
    got = token_files.round_trip(docs, WORDS).orderBy("start").toPandas()
    assert got.start.tolist() == list(range(0, 12_000, 3)) and set(got.n_tokens) == {3}
    assert (got.ids_crc32 != got.ids_crc32.shift()).sum() == 2  # equal documents stand together


def test_numbers_of_all_lengths_are_packed_and_unpacked():
    draw = np.random.default_rng(3)
    for n in (0, 1, 3, 4, 5, 1000, 300_001):
        numbers = draw.integers(0, 1 << draw.integers(1, 33, n).astype(np.uint64), dtype=np.uint64)
        control, data = token_files.pack(numbers.astype("<u4"))
        assert len(control) == -(-n // 4)
        assert (token_files.unpack(control, data)[:n] == numbers).all()


def brute_negatives(rows, every=100, positives=5, negatives=10, low=30, high=90):
    used = []
    for i, (vec_id, vector, label) in enumerate(rows):
        if vec_id is None or label is None or vector is None:
            continue
        if any(v is None or not np.isfinite(v) for v in vector):
            continue
        used.append((i, vec_id, label, [int(np.floor(256 * float(v))) for v in vector]))
    out = []
    for a in used:
        if a[1] % every:
            continue
        scored = [
            (-sum(x * y for x, y in zip(a[3], c[3], strict=True)), c[1], c[2] == a[2])
            for c in used
            if c[0] != a[0] and len(c[3]) == len(a[3])
        ]
        scored.sort()
        for p in [s for s in scored if s[2]][:positives]:
            hard = [s for s in scored if not s[2] and low * p[0] >= 100 * s[0] >= high * p[0]]
            out += [
                (a[1], p[1], k + 1, s[1], -p[0], -s[0]) for k, s in enumerate(hard[:negatives])
            ]
    return sorted(out)


@pytest.mark.parametrize("held", [8_000, 40])
def test_hard_negatives(spark, monkeypatch, held):
    monkeypatch.setattr(hard_negatives, "HELD", held)
    monkeypatch.setattr(hard_negatives, "SCORED", 17)
    draw = np.random.default_rng(0)
    rows = [(i, draw.normal(0, 0.2, 11).tolist(), int(i) % 4) for i in range(300)]
    rows += [(i, rows[0][1], i % 3) for i in range(300, 420)]  # a third are copies
    rows += [(100, rows[100][1], 1), (100, rows[100][1], 1), (7, rows[7][1], 2)]  # repeated rows
    rows += [(500, [0.5] * 3, 1), (501, [0.5] * 3, 1), (502, [0.3] * 3, 2), (600, [], 1), (601, [], 1)]
    rows += [(602, [], 3), (700, None, 1), (701, [0.1] * 11, None), (None, [0.1] * 11, 1)]
    rows += [
        (800, [float("nan")] * 11, 1),
        (900, [float("inf")] * 11, 1),
        (1000, [None] * 11, 1),
        (1100, [0.0] * 11, 2),
        (1200, [-3e5] * 11, 3),
        (1201, [3e5] * 11, 3),
        (1202, [-2e5] * 11, 2),
    ]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").select(
        "*", *[F.lit("x").alias(c) for c in ("uid", "x", "width", "score", "anchor", "groups")]
    )
    got = hard_negatives.hard_negatives(frame)
    assert dict(got.dtypes)["rank"] == "int"
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    assert hard_negatives.hard_negatives(frame.where("false")).count() == 0


def test_subset_sums_give_inner_products_of_any_width():
    draw = np.random.default_rng(4)
    for width, reach in ((1, 3), (8, 200), (13, 1 << 20), (64, 300)):
        x, a = (draw.integers(-reach, reach + 1, (n, width)) for n in (50, 9))
        packed = hard_negatives.pack(x, hard_negatives.planes_needed(reach))
        assert (hard_negatives.scores(hard_negatives.tables(a), packed) == x @ a.T).all()
