"""Each operator beside its brute-force version on a table of edge cases."""

import hashlib
import random
import re
import struct
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from patronage.llm import (
    byte_bpe,
    embedding_dedup,
    exact_dedup,
    kneser_ney,
    language_id,
    license_scan,
    mixing,
    quality,
    simhash,
    token_count,
)
from patronage.llm.components import components
from patronage.llm.scan import text_bytes

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
JSON = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def ordered(rows):
    return sorted(rows, key=lambda row: [(x is not None, str(type(x)), x) for x in row])


def pairs(edge_rows):
    return [(row[0], row[1]) for row in edge_rows]


def test_exact_groups(edge_docs, edge_rows, rows_of, no_docs):
    assert rows_of(exact_dedup.exact_groups(edge_docs)) == ordered(
        brute.exact_groups(pairs(edge_rows))
    )
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_exact_dedup_keeps_one_row_of_a_group_and_all_columns(edge_docs, edge_rows):
    kept = exact_dedup.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    texts = [brute.low(row.text) for row in kept.select("text").collect()]
    assert sorted(texts) == sorted({brute.low(text) for _, text in pairs(edge_rows)})
    ids = {row.doc_id for row in kept.select("doc_id").collect()}
    assert 2 in ids and 1 not in ids


def test_one_text_in_every_row(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("Same").alias("text"))
    row = exact_dedup.exact_groups(docs).select("keep_id", "group_size").distinct().collect()
    assert [tuple(r) for r in row] == [(1999, 2000)]


def test_kneser_ney(edge_docs, edge_rows, no_docs):
    got = kneser_ney.held_out_scores(edge_docs)
    expected = {}
    for (doc_id, text), row in zip(pairs(edge_rows), brute.kneser_ney(pairs(edge_rows)), strict=True):
        expected.setdefault((doc_id, len(brute.words(text)) + 1), row)
    for row in got.collect():
        n_tokens, n_known, n, base, score = expected[row.doc_id, row.n_tokens]
        assert (row.n_known, row.train_tokens) == (n_known, n)
        assert row.base_score == pytest.approx(base, rel=1e-12)
        assert row.score == pytest.approx(score, rel=1e-9)
        assert row.held_out == (brute.crc(row.doc_id) % 10 == 0)
    assert got.count() == len(edge_rows)
    assert kneser_ney.held_out_scores(no_docs).count() == 0


def test_kneser_ney_without_training_text(spark):
    model = kneser_ney.train(spark.createDataFrame([], "text string"))
    docs = spark.createDataFrame([(1, "some words"), (2, None)], "doc_id long, text string")
    rows = kneser_ney.score(docs, model).orderBy("doc_id").collect()
    assert [(r.n_known, r.score, r.base_score) for r in rows] == [(0, 0.0, 0.0), (0, 0.0, 0.0)]


def test_kneser_ney_probabilities_sum_to_one(spark, edge_docs):
    """Over all known words and one unknown, after a known word."""
    docs = edge_docs.where("doc_id BETWEEN 20 AND 40")
    model = kneser_ney.train(docs)
    vocabulary = sorted(
        {w for row in docs.collect() for w in brute.words(brute.low(row.text))} | {"notseen"}
    )
    frame = spark.createDataFrame(
        [(i, f"the {w}") for i, w in enumerate(vocabulary)] + [(-1, "the")],
        "doc_id long, text string",
    )
    scores = {r.doc_id: r.score for r in kneser_ney.score(frame, model).collect()}
    # p(w | the) is the probability of "the w" without its end over that of "the".
    mapped = kneser_ney.MappedModel(model)
    total = 0.0
    for i, w in enumerate(vocabulary):
        hashes, first = kneser_ney.token_hashes(*text_bytes(pa.array([f"the {w}"])))
        with_w = mapped.score(hashes[:2], np.array([0, 2]))[2][0]
        alone = mapped.score(hashes[:1], np.array([0, 1]))[2][0]
        total += 10 ** (with_w - alone)
        assert scores[i] <= with_w
    total += 10 ** (scores[-1] - alone)
    assert total == pytest.approx(1, abs=1e-9)


def test_byte_bpe(edge_docs, edge_rows, rows_of, no_docs):
    library = tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    expected = []
    for doc_id, text in pairs(edge_rows):
        ids = library.encode_ordinary(text or "")
        expected.append(
            (
                doc_id,
                len(ids),
                hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(),
                hashlib.sha256((text or "").encode()).hexdigest(),
            )
        )
    assert rows_of(byte_bpe.round_trip(edge_docs, RANKS, PATTERN)) == ordered(expected)
    assert byte_bpe.round_trip(no_docs, RANKS, PATTERN).count() == 0


def test_byte_bpe_columns(edge_docs):
    encoded = byte_bpe.encode(edge_docs, RANKS, PATTERN, decoded_to="mask")
    decoded = byte_bpe.decode(encoded, RANKS, PATTERN, to="bytes")
    assert set(decoded.columns) == set(edge_docs.columns)
    text = F.coalesce(F.col("text"), F.lit(""))
    wrong = (text.cast("binary") != F.col("bytes")) | (F.sha2(text, 256) != F.col("mask"))
    assert decoded.where(wrong | F.col("bytes").isNull()).count() == 0


def test_long_words_and_short_ones_are_merged_alike():
    coder = byte_bpe.ByteBpe(RANKS, PATTERN)
    library = tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    texts = ["ab" * n for n in (1, 2, 100, 127, 128, 129, 400)] + ["é" * 127, "é" * 128]
    ids, bounds = coder.encode(texts)
    got = [ids[i:j].tolist() for i, j in zip(bounds[:-1], bounds[1:], strict=True)]
    assert got == [library.encode_ordinary(t) for t in texts]


def test_blocks_of_long_distinct_words_fit_in_memory():
    draw = random.Random(4)
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = ["".join(draw.choices(letters, k=draw.randint(100, 254))) for _ in range(9_000)]
    library = tiktoken.Encoding(
        "own", pat_str=PATTERN, mergeable_ranks=byte_bpe.read_ranks(RANKS), special_tokens={}
    )
    text = " ".join(words)
    ids, _ = byte_bpe.ByteBpe(RANKS, PATTERN).encode([text])
    assert ids.tolist() == library.encode_ordinary(text)


def test_token_counts(edge_docs, edge_rows, rows_of, no_docs):
    library = Tokenizer.from_file(JSON)
    expected = []
    for doc_id, text in pairs(edge_rows):
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        expected.append((doc_id, len((text or "").encode()), n, n > 512))
    assert rows_of(token_count.count_tokens(edge_docs, JSON, PATTERN)) == ordered(expected)
    assert token_count.count_tokens(no_docs, JSON, PATTERN).count() == 0


def vectors():
    draw = np.random.default_rng(3)
    rows = []
    for i in range(60):
        rows.append((i, draw.normal(size=8).astype(np.float32).tolist()))
    for i in range(60, 160):  # copies with noise, chains among them
        base = np.array(rows[draw.integers(0, len(rows))][1])
        rows.append((i, (base + draw.normal(0, 0.12, 8)).astype(np.float32).tolist()))
    rows += [(200 + i, rows[5][1]) for i in range(4)] + [(5, rows[5][1])]
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [1.0, None] * 4)]
    rows += [(304, [float("nan")] * 8), (305, [float("inf")] * 8), (306, [1.0, 2.0])]
    rows += [(307, [2.0, 4.0]), (308, [-0.0, 0.0])]
    return rows


def test_embedding_near_dedup(spark, rows_of):
    rows = vectors()
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    frame = frame.select("*", *[F.lit(1).alias(c) for c in ("k1", "x", "unit", "n", "block", "kept")])
    got = embedding_dedup.near_vectors(frame)
    expected = [(i, n, c, i == c) for i, n, c in brute.near_vectors(rows)]
    assert rows_of(got) == ordered(expected)
    assert embedding_dedup.near_vectors(frame.where("false")).count() == 0


def test_embedding_recall(spark):
    """Against all pairs, where vectors probe a part of the lists only."""
    draw = np.random.default_rng(0)
    x = draw.normal(size=(4000, 32))
    x[2000:] = x[draw.integers(0, 2000, 2000)] + draw.normal(0, 0.2, (2000, 32))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    expected = int(((unit @ unit.T) >= 0.95).sum() - len(x))
    frame = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>"
    )
    got = embedding_dedup.near_vectors(frame, probes=8).agg(F.sum("n_links")).first()[0]
    assert 0.95 * expected <= got <= expected and expected > 2000


@pytest.mark.parametrize("list_size", [150, 30, 8])
def test_embedding_links_of_a_dense_group(spark, rows_of, monkeypatch, list_size):
    """A third of the vectors differ little from one another and share many lists."""
    monkeypatch.setattr(embedding_dedup, "LIST_SIZE", list_size)
    draw = np.random.default_rng(1)
    x = draw.normal(size=(1500, 64))
    x[:500] = x[0] + draw.normal(0, 0.2, (500, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.95
    frame = spark.createDataFrame(
        [(i, row.tolist()) for i, row in enumerate(x)], "vec_id long, embedding array<double>"
    )
    got = rows_of(embedding_dedup.near_vectors(frame), "vec_id", "n_links", "component_id")
    root = brute.roots(len(x), zip(*np.nonzero(np.tril(near, -1)), strict=True))
    assert got == [(i, int(near[i].sum()) - 1, root[i]) for i in range(len(x))]
    assert near[:500, :500].mean() > 0.3


def test_language_id(edge_docs, edge_rows, no_docs):
    rows = language_id.held_out_predictions(edge_docs).collect()
    assert len(rows) == len(edge_rows)
    texts = dict(pairs(edge_rows))
    for row in rows:
        assert row.held_out == (brute.crc(row.doc_id) % 3 == 1)
        assert 0 <= row.score <= 1
        if row.doc_id in (5, 6, 7, 13):
            assert (row.lang_pred, row.score) == ("und", 0)
        else:
            assert row.lang_pred in ("en", "fr", "de"), texts[row.doc_id]
    assert language_id.held_out_predictions(no_docs).count() == 0


def test_language_id_gradients():
    """Backpropagation through time against finite differences."""
    network = language_id.Network.new(3)
    network.weights = {k: w.astype(np.float64) for k, w in network.weights.items()}
    codes = np.frombuffer(b"abcaxyzbqrsa", np.uint8).reshape(3, 4)
    truth, weight = np.array([0, 2, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        found = network.labels(codes)[:, np.arange(3), truth]
        return -(found * weight).sum() / weight.sum() / codes.shape[1]

    grads = network.gradients(codes, truth, weight)
    draw = np.random.default_rng(1)
    for name, values in network.weights.items():
        used = np.argwhere(np.abs(grads[name]) > 1e-4)
        for place in used[draw.choice(len(used), min(5, len(used)), replace=False)]:
            place = tuple(place)
            kept, step = values[place], 1e-3
            values[place] = kept + step
            up = loss()
            values[place] = kept - step
            down = loss()
            values[place] = kept
            assert grads[name][place] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=2e-5)


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language_id.held_out_predictions(docs).where("held_out")
    right = found.join(docs.select("doc_id", "lang"), "doc_id").agg(
        F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))
    )
    assert right.first()[0] > 0.95


def test_license_scan(edge_docs, edge_rows, rows_of, no_docs):
    got = license_scan.scan(edge_docs)
    columns = ("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")
    expected = [(doc_id, *brute.licenses(text)) for doc_id, text in pairs(edge_rows)]
    assert rows_of(got, *columns) == ordered(expected)
    for row in got.collect():
        assert set(row.base_labels.split(",")) <= {*row.labels.split(","), ""}
        assert 0 <= row.score <= 1 and (row.score > 0) == (row.labels != "")
    assert license_scan.scan(no_docs).count() == 0


def test_license_spans_survive_changes(spark):
    text = dict(license_scan.TEMPLATES[:1])["mit"].split()
    changed = [*text[:10], "really", *text[10:30], *text[32:]]
    rows = [
        (1, " ".join(["some", "words", "before", *text])),
        (2, " ".join(changed)),
        (3, " ".join(text[:8])),
        (4, "This work is licensed under the GNU General Public License, version 3."),
        (5, "permission is granted to nobody for this software"),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    labels = {r.doc_id: r.labels for r in license_scan.scan(frame).collect()}
    assert labels == {1: "mit", 2: "mit", 3: "", 4: "gpl", 5: ""}


def test_license_words_met_twice_count_once(spark):
    apache = next(text for label, text in license_scan.TEMPLATES if label == "apache-2")
    rows = [
        (1, "licensed under the BSD license or licensed under the GPL"),
        (2, "licensed under the BSD 3 clause License " * 3),
        (3, "licensed under the MIT License or licensed under the MIT License"),
        (4, apache.replace("this file", "this file here")),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in license_scan.scan(frame).collect()}
    assert {i: r.labels for i, r in got.items()} == {1: "", 2: "bsd", 3: "mit", 4: "apache-2"}
    n = len(re.findall(r"\w+", apache)) - 2
    # A word after "this file" breaks two grams, as the phrase of three words stands at the head.
    spans = {r.doc_id: r.score for r in license_scan.scan(frame, phrases=()).collect()}
    assert spans[4] == pytest.approx((n - 2) / n) and spans[3] == 1


def test_native_plans_have_no_python(edge_docs):
    for frame in (exact_dedup.exact_groups(edge_docs), license_scan.scan(edge_docs)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_mixing(edge_docs, edge_rows, rows_of, no_docs):
    got = mixing.taken_words(edge_docs).collect()
    assert len(got) == len(edge_rows)
    targets = brute.mix_targets([(row[3], row[1]) for row in edge_rows])
    by_id = {row[0]: row for row in edge_rows if row[0] is not None}
    taken = dict.fromkeys(targets, 0)
    for row in got:
        assert 0 <= row.taken <= 3 * row.size
        assert row.size == 0 or row.taken % row.size == 0
        if row.doc_id is not None:
            source = by_id[row.doc_id][3]
            assert row.size == len(brute.words(by_id[row.doc_id][1]))
            assert row.source_size == targets[source][0]
            assert row.target == pytest.approx(targets[source][1])
            taken[source] += row.taken
    again = mixing.taken_words(edge_docs.repartition(3))
    assert rows_of(again) == ordered([tuple(row) for row in got])
    assert mixing.taken_words(no_docs).count() == 0
    mixed = mixing.mixed_documents(edge_docs)
    assert mixed.columns == edge_docs.columns
    words = sum(len(brute.words(row.text)) for row in mixed.select("text").collect())
    assert words == sum(row.taken for row in got)


def test_mixing_comes_near_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    drawn = mixing.mix(docs).groupBy("source").agg(
        F.sum("taken").alias("taken"), F.max("target").alias("target")
    )
    for row in drawn.collect():
        assert row.taken == pytest.approx(row.target, rel=0.03)


def test_flight_keeps_words_and_documents():
    draw = np.random.default_rng(0)
    for n in (3, 40, 700):
        sizes = draw.integers(0, 500, n).tolist()
        chances = draw.uniform(0, 1, n).tolist()
        flown = mixing.flight(sizes, chances, random.Random(1))
        assert sum(0 < p < 1 for p in flown) <= 2
        assert sum(flown) == pytest.approx(sum(chances), abs=1e-6 * n)
        assert np.dot(flown, sizes) == pytest.approx(np.dot(chances, sizes), abs=1e-3 * n)
        landed = mixing.landing(sizes, flown, random.Random(2))
        assert set(landed) <= {0.0, 1.0}


def test_quality(spark, edge_docs, edge_rows, no_docs):
    labels = spark.createDataFrame(
        [(row[0], i % 2, 0) for i, row in enumerate(edge_rows)] + [(1, None, 0), (9, 7, 0)],
        "doc_id long, quality int, toxic int",
    )
    rows = quality.held_out_scores(edge_docs, labels).collect()
    assert len(rows) == len(edge_rows)
    for row in rows:
        assert row.held_out == (zlib.crc32(str("" if row.doc_id is None else row.doc_id).encode()) % 5 == 0)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.3)
    assert quality.held_out_scores(no_docs, labels).count() == 0
    unlabelled = quality.held_out_scores(edge_docs, labels.where("false"))
    assert {(r.score, r.predicted) for r in unlabelled.collect()} == {(0.5, 1)}


def test_quality_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    found = quality.held_out_scores(docs, labels).where("held_out").join(labels, "doc_id")
    right = found.agg(F.avg((F.col("quality") == F.col("predicted")).cast("double")))
    assert right.first()[0] > 0.95


def test_simhash(edge_docs, edge_rows, rows_of, no_docs):
    assert rows_of(simhash.near_groups(edge_docs)) == ordered(brute.near_groups(pairs(edge_rows)))
    assert simhash.near_groups(no_docs).count() == 0
    kept = simhash.deduplicate(edge_docs)
    assert kept.columns == edge_docs.columns
    ids = {row.doc_id for row in kept.select("doc_id").collect()}
    assert 60 in ids and not ids & set(range(62, 70))


@pytest.mark.parametrize("bucket", [2, 1000])
def test_simhash_links_with_full_buckets(spark, bucket, monkeypatch):
    """Chains of near fingerprints, with and without the way for overfull buckets."""
    draw = np.random.default_rng(5)
    values = [int(v) for v in draw.integers(0, 1 << 63, 40)]
    for _ in range(400):
        v = values[draw.integers(0, len(values))]
        for b in draw.choice(64, draw.integers(1, 4), replace=False):
            v ^= 1 << int(b)
        values.append(v)
    values = sorted({v - (1 << 64) if v >= 1 << 63 else v for v in values})
    monkeypatch.setattr(simhash, "BUCKET", bucket)
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    got = {r.node: r.component for r in components(simhash.links(fps)).collect()}
    a = np.array(values, np.int64).view(np.uint64)
    near = np.bitwise_count(a[:, None] ^ a[None, :]) <= 2
    root = brute.roots(len(a), zip(*np.nonzero(np.tril(near, -1)), strict=True))
    assert [got.get(v, v) for v in values] == [values[r] for r in root]


def test_thresholds_obey_the_pigeonhole_principle():
    groups = [[*range(0, 22)], [*range(22, 43)], [*range(43, 64)]]
    for counts in ([[1, 9, 99]] * 3, [[1000, 1, 1], [0, 0, 0], [0, 0, 0]]):
        chosen = simhash.allocate(groups, np.array(counts, float), 2)
        assert sum(chosen) == 2 - 3 + 1 and min(chosen) >= -1
    assert simhash.allocate(groups, np.array([[1e9] * 3, [1e9] * 3, [1, 1, 1]], float), 2) == [-1, -1, 2]


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(500, i) for i in range(501, 600)]
    frame = spark.createDataFrame([*chain, *star, (7, 7), (900, 3)], "a long, b long")
    got = {r.node: r.component for r in components(frame).collect()}
    assert all(got[i] == 100 for i in range(100, 161))
    assert all(got[i] == 500 for i in range(500, 600))
    assert got[900] == got[3] == 3 and 7 not in got
