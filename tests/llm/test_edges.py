"""Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing column names, for every operator."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import fingerprints, flat_tokens, mixing, near_duplicates, packing, quality, sharding, token_frames, topk, toxicity
from tickloom.llm.token_queries import tokenizer_file
from tickloom.sources.staging import fresh_path

LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))
ROWS = [
    (1, "The quick brown fox. It jumps\nover the lazy dog!", "en", "a", 48),
    (2, None, "en", "a", None),
    (3, "", None, "b", 0),
    (4, LONG, "en", None, len(LONG)),
    (5, " \t\n  \r ", "fr", "b", 6),
    (6, "x", "de", "c", 1),
    (6, "x", "de", "c", 1),
    (7, "The quick brown fox. It jumps\nover the lazy dog!", "en", "b", 48),
    (None, "no key at all", "es", "c", 13),
    (9, "日本語 テキスト \U0001f600 é", None, None, 12),
]
CLASHING = ["key", "size", "shard", "score", "label", "place", "n", "root", "piece", "length", "range", "at", "whole", "taken"]
DDL = "doc_id long, text string, lang string, source string, n_chars long"
TOKENIZER = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def docs(spark):
    frame = spark.createDataFrame(ROWS, DDL)
    return frame.select("*", *[F.lit("clash").alias(c) for c in CLASHING])


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (2, 0, 1), (3, None, None), (None, 1, 1), (6, 1, 0), (6, 0, 1)], "doc_id long, quality int, toxic int")


def files(spark, docs):
    return token_frames.write_token_files(docs, fresh_path(spark, "files"), tokenizer_file(TOKENIZER), end_id=2)


OPERATORS = {
    "fingerprints": lambda s, d, _: fingerprints.compare_with_next(d),
    "plain_fingerprints": lambda s, d, _: fingerprints.fingerprint_documents(d),
    "token_files": lambda s, d, _: token_frames.read_token_files(files(s, d)),
    "flat_files": lambda s, d, _: flat_tokens.token_counts(
        flat_tokens.write_flat_files(d, fresh_path(s, "flat"), tokenizer_file(TOKENIZER), 50256), 50256
    ),
    "mixing": lambda s, d, _: mixing.mix(d),
    "toxicity": lambda s, d, labels: toxicity.score_texts(d, toxicity.fit_lexicon(d, labels, F.lit(False)), name="score"),
    "near_duplicates": lambda s, d, _: near_duplicates.similar_components(d),
    "sharding": lambda s, d, _: sharding.assign_shards(d),
    "quality": lambda s, d, labels: quality.score_quality(d, quality.fit_quality(d, labels, F.lit(False)), name="score"),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_one_row_for_each_document(spark, docs, labels, name):
    rows = OPERATORS[name](spark, docs, labels).collect()
    assert len(rows) == len(ROWS)


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, nothing, labels, name):
    assert OPERATORS[name](spark, nothing, labels).collect() == []
    if name in ("toxicity", "quality"):
        assert OPERATORS[name](spark, nothing, labels.limit(0)).collect() == []


def test_packing_edges(spark, docs, nothing):
    path = tokenizer_file("word_bpe_49k.json")
    rows = packing.pack_documents(docs, path, end_id=0).collect()
    assert len({r.doc_id for r in rows}) == 9 and sum(r.piece == 0 for r in rows) == len(ROWS)
    assert packing.pack_documents(nothing, path, end_id=0).collect() == []


def test_topk_edges(spark):
    vectors = [(0, [1.0, 2.0], "x"), (1, [float("nan"), 1.0], "x"), (2, None, "x"), (3, [None, 1.0], "x"), (100, [1.0, 2.0], None),
               (5, [float("inf"), 0.0], "x"), (6, [1.0, 2.0], "x"), (None, [9.0, 9.0], "x"), (7, [-1.0, 0.0], "x"), (7, [-1.0, 0.0], "x")]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>, score string")
    rows = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 100 == 0, k=2).collect()))
    same = 5 * 1024 * 1024
    assert rows == [(0, 1, 6, same), (0, 2, 100, same), (100, 1, 0, same), (100, 2, 6, same)]
    few = topk.top_k(frame.where("vec_id in (0, 7)"), F.col("vec_id") == 0, k=5).collect()
    assert [tuple(r) for r in few] == [(0, 1, 7, -1024 * 1024)]
    assert topk.top_k(frame.limit(0), F.col("vec_id") % 100 == 0).collect() == []


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_pipeline_stages(spark, docs, nothing, labels, stage, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    apply = dict(corpus_pipeline.STAGES)[stage]
    rows = apply(spark, docs, str(tmp_path))
    if stage != "packing":
        assert rows.columns == docs.columns
    assert rows.count() > 0
    assert apply(spark, nothing, str(tmp_path)).count() == 0
