"""The part of a mix against a walk through all documents of a source, and columns that clash with the mix's own."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tickloom.llm import mixing

DDL = "doc_id long, text string, source string"


def place(key, text):
    named = f"{mixing.SEED}|{key}|{hashlib.md5(text.encode()).hexdigest()}"
    return int(hashlib.md5(named.encode()).hexdigest()[:15], 16)


def walked(rows, target, size):
    """Words taken of each document: whole repetitions, then each in the seeded order that still fits."""
    whole = int(target // size) if size else 0
    rest = target - whole * size
    repeats = {k: whole for k, _, _ in rows}
    if rest > 0:
        for _, k, n in sorted((place(k, t), k, len(t.split())) for k, t, _ in rows):
            if n <= rest:
                repeats[k] += 1
                rest -= n
    return repeats


@pytest.fixture(scope="module")
def lopsided(spark):
    """Twelve sources of short texts with one long text each, and one of a single document."""
    rng = random.Random(4)
    rows, key = [], 0
    for s in range(12):
        for i in range(400):
            words = 20_000 if i == 0 else rng.randint(0, 2) if i % 9 == 0 else rng.randint(20, 60)
            rows.append((key, f"w{key} " * words, f"s{s:02d}"))
            key += 1
    rows.append((key, "one two three", "single"))
    return rows, spark.createDataFrame(rows, DDL)


def test_targets_are_met_and_the_walk_is_plain(lopsided):
    rows, docs = lopsided
    weights = (1, 3, 2, 5)
    taken = {r.doc_id: r for r in mixing.mix(docs.repartition(5), weights=weights, total=1.3).collect()}
    for source in sorted({r[2] for r in rows}):
        own = [r for r in rows if r[2] == source]
        target, size = taken[own[0][0]].mix_target, taken[own[0][0]].mix_source_size
        repeats = walked(own, target, size)
        assert {k: taken[k].mix_repeats for k, _, _ in own} == repeats
        left_out = [len(t.split()) for k, t, _ in own if repeats[k] == min(repeats.values())]
        miss = target - sum(repeats[k] * len(t.split()) for k, t, _ in own)
        assert 0 <= miss < max(1, min(left_out)) or target >= 2 * size


@pytest.mark.parametrize("names", [["mix_place", "mix_source", "of"], ["mix_size", "mix_copy", "mix_repeats"], ["toxicity", "toxicity_", "quality", "size", "doc"]])
def test_clashing_names_pass_through(spark, tmp_path, names):
    docs = spark.createDataFrame([(i, f"some plain words {i}", "a") for i in range(6)], DDL).withColumns({n: F.lit(f"own {n}") for n in names})
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for stage in ("toxicity", "quality", "near_duplicates", "mixing"):
        out = dict(corpus_pipeline.STAGES)[stage](spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        assert all(r[n] == f"own {n}" for r in out.collect() for n in names)
    mixed = mixing.mix(docs)
    assert {"mix_size", "mix_source_size", "mix_target", "mix_repeats"} <= set(mixed.columns) and len(set(mixed.columns)) == len(mixed.columns)
    assert all(isinstance(r.mix_size, int) for r in mixed.collect())
