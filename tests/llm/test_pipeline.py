"""The corpus pipeline beside the same stages in plain Python."""

import hashlib

import brute
import corpus_pipeline
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from patronage.llm import mixing, quality
from patronage.session import stage

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = [docs]
    for _, function in corpus_pipeline.STAGES:
        out.append(stage(function(spark, out[-1], FOLDER)))
    return out


def rows(frame):
    return {row.doc_id: row for row in frame.collect()}


def test_every_stage_but_the_last_keeps_the_columns(stages):
    assert all(frame.columns == stages[0].columns for frame in stages[:-1])


def test_quality_stage(spark, stages):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    ranker = quality.train(stages[0].select("doc_id", "text"), labels)
    texts = {i: row.text for i, row in rows(stages[0]).items()}
    scores = ranker.score(quality.features(pa.array([*texts.values()])))
    expected = {i for i, score in zip(texts, scores, strict=True) if score >= 0.3}
    assert set(rows(stages[1])) == expected and 0 < len(expected) < len(texts)


def test_exact_and_near_copies(stages):
    before = [(i, row.text) for i, row in rows(stages[1]).items()]
    exact = {row[0] for row in brute.exact_groups(before) if row[3]}
    assert set(rows(stages[2])) == exact
    near = [(i, row.text) for i, row in rows(stages[2]).items()]
    assert set(rows(stages[3])) == {row[0] for row in brute.near_groups(near) if row[0] == row[2]}


def test_mixing_stage(stages):
    copies = {row.doc_id: row.copies for row in mixing.mix(stages[3]).collect()}
    found = {r.doc_id: r["count"] for r in stages[4].groupBy("doc_id").count().collect()}
    assert found == {i: n for i, n in copies.items() if n}


def test_tokens_decode_to_the_texts(stages):
    wrong = stages[5].where(F.sha2("text", 256) != F.col("decoded_sha256"))
    assert wrong.count() == 0 and stages[5].count() == stages[4].count()
    row = stages[5].first()
    assert row.decoded_sha256 == hashlib.sha256(row.text.encode()).hexdigest()
    assert row.n_tokens == len(row.ids)
