"""Cases that once went wrong: hot ids, long texts, lookalikes, odd names, dense groups."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

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
)
from patronage.llm.scan import text_bytes
from patronage.llm.store import map_array
from patronage.session import stage


def test_repeated_rows_come_near_the_targets(spark):
    rows = [(1, "a", "ten words " * 5)] * 500
    rows += [(i, "b", "w " * 20) for i in range(1000)]
    rows += [(None, "c", "ten words " * 5)] * 500
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").select(
        "*", F.lit("x").alias("lot"), F.lit("y").alias("place")
    )
    targets = brute.mix_targets([(source, text) for _, source, text in rows])
    taken = mixing.taken_words(docs)
    assert taken.count() == 2000
    per_source = mixing.mix(docs).groupBy("source").agg(F.sum("taken").alias("taken")).collect()
    for row in per_source:
        assert row.taken == pytest.approx(targets[row.source][1], abs=20)
    assert taken.agg(F.sum("taken")).first()[0] == sum(row.taken for row in per_source)
    assert taken.where("taken > 3 * size").count() == 0
    mixed = mixing.mixed_documents(docs).groupBy("source").agg(
        F.sum(F.size(F.split(F.trim("text"), " "))).alias("n")
    )
    assert {row.source: row.n for row in mixed.collect()} == {
        row.source: row.taken for row in per_source
    }


def hot_rows(spark):
    many = spark.range(30_000).select(
        F.lit(3).alias("doc_id"), F.concat(F.lit("some words "), F.col("id")).alias("text")
    )
    rest = spark.range(10, 400).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("other text "), F.col("id")).alias("text")
    )
    return stage(many.union(rest))


def test_rows_of_one_id_do_not_reach_the_driver(spark, monkeypatch):
    docs = hot_rows(spark)
    labels = spark.createDataFrame(
        [(3, 1), (3, 0), *[(i, i % 2) for i in range(10, 400)]], "doc_id long, quality int"
    )
    fitted = []
    monkeypatch.setattr(quality, "fit", lambda x, good: fitted.append(len(x)))
    quality.train(docs, labels)
    held_out = sum(brute.crc(i) % 5 == 0 for i in range(10, 400))
    assert fitted == [2 + 390 - held_out]
    words = language_id.sample(docs.withColumn("lang", F.lit("en")))
    assert len(words) == 3 * 391


def test_a_rare_language_is_sampled(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_DOCUMENTS", 40)
    docs = spark.range(4_000).select(
        F.col("id").alias("doc_id"),
        F.concat(F.lit("word "), F.col("id")).alias("text"),
        F.when(F.col("id") % 1000 == 7, "rare").otherwise("common").alias("lang"),
    )
    words = language_id.sample(docs)
    assert sum(lang == "rare" for _, lang in words) == 2 * 4
    assert sum(lang == "common" for _, lang in words) == 2 * 20


def test_long_texts_are_decoded_in_runs(spark, monkeypatch):
    monkeypatch.setattr(byte_bpe, "DECODED", 1_000)
    draw = random.Random(0)
    words = ["alpha", "Beta", "gamma,", "naïve", "日本", "12"]
    texts = [" ".join(draw.choices(words, k=n)) for n in (0, 1, 9_000, 5, 700)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    got = byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).collect()
    assert {row.doc_id: row.decoded_sha256 for row in got} == {
        i: brute.sha256(text.encode()).hexdigest() for i, text in enumerate(texts)
    }


def test_each_template_gives_its_own_label_alone(spark):
    rows = list(enumerate(f"before it {text} and after" for _, text in license_scan.TEMPLATES))
    rows.append((100, " ".join(text for _, text in license_scan.TEMPLATES)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row.doc_id: row for row in license_scan.scan(docs).collect()}
    for i, (label, _) in enumerate(license_scan.TEMPLATES):
        assert set(got[i].labels.split(",")) == {label} | set(filter(None, got[i].base_labels.split(",")))
        assert got[i].score == 1
    assert set(got[100].labels.split(",")) == {label for label, _ in license_scan.TEMPLATES}


def test_columns_of_any_name(spark):
    rows = [(i, f"text number {i} of some words", "s", "x", "y", "z", "b") for i in range(20)]
    kind = "doc_id long, text string, source string, `a b` string, `x:y` string, `dot.ted` string"
    docs = spark.createDataFrame(rows, kind + ", `back``tick` string")
    docs = docs.union(docs.where("doc_id = 1").withColumns({"text": F.lit(None), "doc_id": F.lit(None)}))
    ranker = quality.train(
        docs.select("doc_id", "text"),
        spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int"),
    )
    for frame in (docs, docs.where("false")):
        for made in (
            quality.keep_good(frame, ranker),
            exact_dedup.deduplicate(frame),
            simhash.deduplicate(frame),
            mixing.mixed_documents(frame),
            byte_bpe.encode(
                frame,
                public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                public_tokenizers.PATTERN,
                decoded_to="decoded",
            ),
        ):
            assert set(docs.columns) <= set(made.columns)
            made.collect()


@pytest.mark.parametrize("lists", [50, 187, 500, 1000])
def test_recall_of_the_nearest_lists(lists):
    """A third of the vectors in one dense group, others in pairs of near copies."""
    draw = np.random.default_rng(lists)
    n = 12_000
    x = draw.normal(size=(n, 64))
    x[: n // 3] = x[0] + draw.normal(0, 0.2, (n // 3, 64))
    half = n // 3 + n // 3
    x[half:] = x[n // 3 : half] + draw.normal(0, 0.2, (n - half, 64))
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    found = total = 0
    quantiser = embedding_dedup.fit(embedding_dedup.thinned(unit, 0.95), lists)
    own = quantiser.lists(unit, 1)[:, 0]
    for at in range(0, n, 1_000):
        near = unit[at : at + 1_000] @ unit.T >= 0.95
        probed = quantiser.probed(unit[at : at + 1_000], 0.0, embedding_dedup.PROBES)
        total += near.sum()
        found += (near & probed[:, own]).sum()
    sparse = slice(n // 3, n)
    assert found / total >= 0.97
    near = unit[sparse] @ unit[sparse].T >= 0.95
    probed = quantiser.probed(unit[sparse], 0.0, embedding_dedup.PROBES)
    assert (near & probed[:, own[sparse]]).sum() / near.sum() >= 0.95


def test_kneser_ney_levels_of_shards(spark, edge_docs, monkeypatch):
    """Models counted through one, two and three levels of exchanges are the same."""
    docs = edge_docs.repartition(3)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    scored = []
    for shards, fan_bits, shifts in ((1, 8, [0]), (16, 2, [2, 0]), (8, 1, [2, 1, 0])):
        monkeypatch.setattr(kneser_ney, "SHARD_BYTES", size / shards)
        monkeypatch.setattr(kneser_ney, "FAN_BITS", fan_bits)
        monkeypatch.setattr(kneser_ney, "LEAST_RANGE", 16)
        model = kneser_ney.train(docs)
        assert kneser_ney._shifts(model.pair_bits, fan_bits) == shifts
        numbers = (model.n_tokens, model.n_words, model.n_pairs, model.pair_discounts)
        rows = kneser_ney.score(edge_docs, model).collect()
        scored.append((numbers, model.word_discounts, sorted(map(repr, rows))))
    assert scored[0][:2] == scored[1][:2] == scored[2][:2]
    for other in scored[1:]:
        assert other[2] == scored[0][2]


def test_kneser_ney_keeps_few_arrays(spark, edge_docs, monkeypatch):
    size = edge_docs.agg(F.sum(F.octet_length("text"))).first()[0]
    monkeypatch.setattr(kneser_ney, "SHARD_BYTES", size / 8)
    model = kneser_ney.train(edge_docs)
    texts = text_bytes(pa.array([r.text for r in edge_docs.select("text").collect()]))
    hashes, first = kneser_ney.token_hashes(*texts)
    whole = kneser_ney.MappedModel(model).score(hashes, first)
    monkeypatch.setattr(kneser_ney, "MOST_MAPPED", 2)
    few = kneser_ney.MappedModel(model)
    assert all((a == b).all() for a, b in zip(whole, few.score(hashes, first), strict=True))
    assert len(few._arrays) == 2
    # Arrays read whole count by their bytes.
    monkeypatch.setattr(kneser_ney, "MOST_MAPPED", 4_096)
    monkeypatch.setattr(kneser_ney, "MOST_READ", 1_000)
    monkeypatch.setattr(kneser_ney, "map_array", lambda path: np.array(map_array(path)))
    read = kneser_ney.MappedModel(model)
    assert all((a == b).all() for a, b in zip(whole, read.score(hashes, first), strict=True))
    assert read._read <= max(1_000, *(a.nbytes for a in read._arrays.values()))
