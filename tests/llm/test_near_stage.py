"""The pipeline's near-duplicate stage: five words a shingle, similarity 0.8 or more."""

from __future__ import annotations

import itertools
import random

import numpy as np

import corpus_pipeline
from tickloom.llm import near_duplicates


def similarity(x, y, width=5):
    a, b = ({tuple(t.split()[i : i + width]) for i in range(len(t.split()) - width + 1)} for t in (x, y))
    return len(a & b) / len(a | b)


def test_stage_drops_copies_of_four_fifths(spark):
    rng = random.Random(8)
    texts, stays = {}, set()
    for i in range(0, 400, 10):
        base = [f"w{rng.randrange(3000)}" for _ in range(rng.choice((60, 150, 300, 700)))]
        texts[i] = " ".join(base)
        texts[i + 1] = " ".join(base[: round(0.85 * len(base))])  # cut
        spaced = list(base)
        for at in range(25, len(base), 50):  # a word in 50 replaced
            spaced[at] = f"x{i}"
        texts[i + 2] = " ".join(spaced)
        texts[i + 3] = " ".join(base[: round(0.7 * len(base))] + [f"y{i}"])  # not a copy of the whole
        kept = {i, i + 3} if similarity(texts[i + 1], texts[i + 3]) < 0.8 else {i}
        assert 0.8 <= similarity(texts[i], texts[i + 1]) < 0.9 and similarity(texts[i], texts[i + 3]) < 0.8
        assert 0.8 <= similarity(texts[i], texts[i + 2]) < 0.9
        stays |= kept
    rows = [(k, t, "en", "s", len(t)) for k, t in texts.items()]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = corpus_pipeline.drop_near_duplicates(spark, docs, "").collect()
    assert {r.doc_id for r in found} == stays and len(found) == len(stays)


def test_pairs_at_the_limit_meet():
    """Sets as unlike as 4/5 allows share a signature not both deleted, and sketches do not refute them."""
    rng, least = np.random.default_rng(4), (4, 5)
    for sets, size in itertools.product((1, 10_000, 10**8), (4, 5, 8, 9, 10, 15, 20, 31, 57, 100, 333, 1200)):
        for _ in range(12):
            pool = np.unique(rng.integers(0, 2**64, 3 * size, dtype=np.uint64))
            rng.shuffle(pool)
            gone = int(rng.integers(0, size // 5 + 1))
            more = int(rng.integers(0, size // 4 + 2))
            x, y = np.sort(pool[:size]), np.sort(np.concatenate([pool[gone:size], pool[size : size + more]]))
            if not near_duplicates.similar(x, y, least) or np.array_equal(x, y):
                continue
            both = np.array([len(x), len(y)]), np.concatenate([x, y])
            owner, signature, kind = near_duplicates.signatures(*both, sets, least)
            rows = [set(zip(signature[owner == i].tolist(), kind[owner == i].tolist())) for i in (0, 1)]
            full, every = [{s for s, k in r if k < 2} for r in rows], [{s for s, _ in r} for r in rows]
            assert full[0] & every[1] or full[1] & every[0], (sets, size, len(y))
            drawn = near_duplicates.sketches(*both, least)
            band = np.searchsorted(near_duplicates.bands(2 * size, least), both[0], side="right")
            # Sketches of the group both are in: the lower band's own, and below that of the band above.
            a, below = (0 if band[0] <= band[1] else 1), int(band[0] != band[1])
            p, q = drawn[0][a], drawn[below][1 - a]
            assert len(p) == len(q) and sum(i != j for i, j in zip(p, q)) <= len(np.setxor1d(x, y))
