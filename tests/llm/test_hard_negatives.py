"""Hard negatives against a plain form over all pairs, and its edges."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from oracle import compare
from tickloom.llm import hard_negatives as hard
from tickloom.llm import queries

FOLDER = "/root/testdata/sf0.001"


def plain(rows, positives=5, negatives=5):
    """rows: id to (label, integer vector)."""
    out = []
    for anchor, (label, vector) in rows.items():
        if anchor % 100:
            continue
        score = {k: sum(int(x) * int(y) for x, y in zip(vector, v)) for k, (_, v) in rows.items() if k != anchor}
        best = sorted((k for k in score if rows[k][0] == label), key=lambda k: (-score[k], k))[:positives]
        for p in best:
            fit = [k for k in score if rows[k][0] != label and 80 * score[p] <= 100 * score[k] <= 100 * score[p]]
            fit = sorted(fit, key=lambda k: (-score[k], k))[:negatives]
            out += [(anchor, p, i + 1, k, score[p], score[k]) for i, k in enumerate(fit)]
    return sorted(out)


def mined(spark, rows, **options):
    frame = spark.createDataFrame([(k, label, v) for k, (label, v) in rows.items()], "vec_id long, label int, embedding array<double>")
    out = hard.hard_negatives(frame.repartition(7), F.col("vec_id") % 100 == 0, scale=1, **options)
    return sorted(map(tuple, out.collect()))


@pytest.mark.parametrize("seed, spread, labels, block", [(1, 3, 3, 4096), (2, 1, 2, 2), (3, 40, 6, 3), (4, 0, 2, 4096)])
def test_equal_to_all_pairs(spark, seed, spread, labels, block):
    rng = random.Random(seed)
    # Small integers: many ties, equal positives, negative and zero scores.
    rows = {k: (rng.randrange(labels), [float(rng.randint(-1, spread)) for _ in range(3)]) for k in range(0, 700, 2 if seed == 3 else 1)}
    got = mined(spark, rows, block=block)
    assert got == plain(rows) and (got or spread == 0)


def test_a_vector_repeated_many_times(spark, monkeypatch):
    monkeypatch.setattr(hard, "HELD", 50)
    rows = {k: (k % 2, [4.0, 1.0]) for k in range(3000)}
    rows |= {k: (k % 3, [float(k % 5), 3.0]) for k in range(3000, 3200)}
    assert mined(spark, rows, negatives=3) == plain(rows, negatives=3)


def test_large_numbers_are_exact(spark):
    rng = random.Random(9)
    rows = {k: (k % 2, [float(2**29 + rng.randrange(4)), float(rng.randrange(9))]) for k in range(120)}
    assert mined(spark, rows) == plain(rows)


def test_edges(spark):
    ddl = "vec_id long, label int, embedding array<float>, score long, slot int, anchor_id long, v string, rank int"
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, 1, [1.0, 2.0]), (1, 1, [1.0, 2.0]), (2, 0, [1.0, 2.0]), (2, 0, [1.0, 2.0]), (3, None, [1.0, 2.0]), (4, 0, None),
        (5, 0, [nan, 1.0]), (6, 0, [inf, 1.0]), (8, 0, [None, 1.0]), (None, 0, [1.0, 2.0]), (9, 0, []), (10, 0, [1.0, 1.75]),
        (100, 7, [1.0, 2.0]), (200, None, [1.0, 2.0]),
    ]
    docs = spark.createDataFrame([(*r, 1, 2, 3, "x", 4) for r in rows], ddl)
    got = sorted(map(tuple, hard.hard_negatives(docs, F.col("vec_id") % 100 == 0, scale=4).collect()))
    # An anchor without another row of its label has no positive; a shorter vector is filled up with zeros.
    assert got == [(0, 1, 1, 2, 80, 80), (0, 1, 2, 100, 80, 80), (0, 1, 3, 10, 80, 72)]
    assert hard.hard_negatives(docs.limit(0), F.col("vec_id") % 100 == 0).collect() == []
    one = docs.where("vec_id = 0")
    assert hard.hard_negatives(one, F.col("vec_id") % 100 == 0).collect() == []


def test_query(spark):
    assert compare(spark, queries.QUERIES["op12_hard_negatives"], queries.ORACLES["op12_hard_negatives"], FOLDER) is None
