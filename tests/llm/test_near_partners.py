"""Partners of a signature's sets: few pairs for a large group of copies, and short rows."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest

from tickloom.llm import near_duplicates


def test_large_group_of_near_copies_makes_few_pairs(spark, monkeypatch):
    """Copies that are all like their base: few pairs are written, whatever signatures the copies share (20120 with 64 partners by name)."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    texts = {1000: " ".join(base)}
    for i in range(240):
        words = list(base)
        for at in rng.sample(range(5, 395), 4):
            words[at] = f"x{i}.{at}"
        texts[i] = " ".join(words)
    made, partners = [], near_duplicates._partners

    def counted(*arguments):
        found = partners(*arguments)
        made.append(found.count())
        return found

    monkeypatch.setattr(near_duplicates, "_partners", counted)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    found = near_duplicates.similar_components(docs).collect()
    assert {r.component_id for r in found} == {0} and len(found) == len(texts)
    assert sum(made) <= 20 * len(texts), made


def test_outlines_are_short_and_refute_no_more_than_sketches():
    rng = np.random.default_rng(3)
    for length in (0, 1, 128, 129, 500, 1001):
        x = rng.integers(0, 256, length, dtype=np.uint8)
        y = np.where(rng.random(length) < 0.3, rng.integers(0, 256, length, dtype=np.uint8), x).astype(np.uint8)
        drawn = near_duplicates.outlines([x.tobytes(), y.tobytes()])
        more = [*drawn, *near_duplicates.outlines([b"a", b"b"])]
        lengths = np.array([len(d) for d in more])
        facts = np.frombuffer(b"".join(more), np.uint8), np.cumsum(lengths) - lengths, lengths
        unlike = int(near_duplicates._unlike(*facts, np.array([0]), np.array([1]))[0])
        assert near_duplicates._unlike(*facts, np.array([0, 2, 1]), np.array([1, 3, 1])).tolist() == [unlike, 1, 0]
        fields = x != y if length <= near_duplicates.SHORT_SKETCH else (x & 3) != (y & 3)
        assert unlike == fields.sum() <= (x != y).sum()
        assert len(drawn[0]) <= max(near_duplicates.SHORT_SKETCH, length // 4 + 1) + 1


@pytest.mark.parametrize(("since", "until"), [(0, 2), (2, 5), (5, 1000), (0, 1000)])
def test_partners_across_batches(spark, since, until):
    """Every row with the partners before it, however the rows of a signature are cut into batches."""
    rng, rows, sets = random.Random(since), [], []
    for doc in range(150):
        sets.append((doc, rng.randrange(9), b"\0" + 16 * b"a", b"\0" + 16 * b"b"))
        rows += [(s, doc, 100, rng.randrange(4), rng.randrange(6)) for s in (7, 8) if rng.random() < 0.9]
    facts = {doc: shared for doc, shared, _, _ in sets}
    expected = set()
    for s in (7, 8):
        ordered = sorted((r for r in rows if r[0] == s), key=lambda r: (r[3] > 1, -facts[r[1]], r[1], r[3]))
        for (i, x), (j, y) in itertools.permutations(enumerate(ordered), 2):
            if since <= j < min(until, i) and x[4] != y[4] and (x[3] < 2 or y[3] < 2) and (x[3] % 2 == y[3] % 2):
                expected.add((x[1], y[1]))
    frame = spark.createDataFrame(rows, "signature long, doc long, n long, kind int, root long")
    known = spark.createDataFrame(sets, "doc long, shared long, own_outline binary, below_outline binary")
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    try:
        for size in (3, 1000):
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
            found = near_duplicates._partners(frame, known, since, until, (9, 10)).collect()
            assert {(r.a, r.b) for r in found} == expected
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
