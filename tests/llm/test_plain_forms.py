"""op1, op5 and op9 against forms that go byte by byte, word by word and entry by entry."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickloom.llm import fingerprints as fp
from tickloom.llm import quality, queries, samples, topk, toxicity
from tickloom.llm.samples import in_fold

FOLDER = "/root/testdata/sf0.001"
M32, M64 = (1 << 32) - 1, (1 << 64) - 1


def plain_signature(data: bytes, size: int) -> str:
    """Chunks of a text byte by byte; the last of 64 takes all the rest."""
    chunks, begin = [], 0
    for i in range(len(data)):
        r = 0
        for j in range(i - 6, i + 1):
            r = (r * int(fp._ROLL) + (data[j] if j >= 0 else 0)) & M32
        r ^= r >> 15
        r = r * int(fp._MIX) & M32
        r ^= r >> 13
        if r % size == 0 or i == len(data) - 1:
            chunks.append(data[begin : i + 1])
            begin = i + 1
    if len(chunks) > 64:
        chunks[63:] = [b"".join(chunks[63:])]
    out = ""
    for chunk in chunks:
        h, power = 0, 1
        for b in chunk:
            h, power = (h + (b + 1) * power) & M64, power * fp._BASE & M64
        for _ in range(2):
            h = (h ^ (h >> 32)) * 0xD6E8FEB86659FD93 & M64
        out += chr(fp.ALPHABET[h >> 58])
    return out


def plain_fingerprint(text: str) -> str:
    data, size = text.encode(), 1
    while len(data) > fp.AIM * size:
        size *= 2
    return f"{size}:{plain_signature(data, size)}:{plain_signature(data, 2 * size)}"


def plain_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    parts = [dict(zip((int(n), 2 * int(n)), (x, y))) for n, x, y in (f.split(":") for f in (a, b))]
    best = 0.0
    for size in parts[0].keys() & parts[1].keys():
        x, y = parts[0][size], parts[1][size]
        table = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        run, longest = [[0] * (len(y) + 1) for _ in range(len(x) + 1)], 0
        for i, c in enumerate(x):
            for j, d in enumerate(y):
                table[i + 1][j + 1] = table[i][j] + 1 if c == d else max(table[i][j + 1], table[i + 1][j])
                run[i + 1][j + 1] = run[i][j] + 1 if c == d else 0
                longest = max(longest, run[i + 1][j + 1])
        # Edit distance by insertions and deletions, in proportion to both lengths.
        edits = len(x) + len(y) - 2 * table[-1][-1]
        if longest >= max(1, min(min(len(x), len(y)) // 3, fp.RUN)):
            best = max(best, 1 - edits / max(1, len(x) + len(y)))
    return best


def test_op1_equals_a_byte_loop(spark, tmp_path):
    rng = random.Random(3)
    own = ["", None, "é😀x", "abc " * 400, "one phrase, " * 300] + ["".join(rng.choices("abcdefg \n", k=rng.randint(1, 1500))) for _ in range(12)]
    own += [own[8], own[8][:700] + "zz" + own[8][700:]]
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").where("doc_id % 9 = 0 and n_chars < 3000").select("text").collect()
    own += [r.text for r in rows[:25]]
    spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = sorted(queries.QUERIES["op1_fingerprints"](spark, str(tmp_path)).collect())
    texts = [t or "" for t in own]
    prints = [plain_fingerprint(t) for t in texts]
    for i, (row, text) in enumerate(zip(found, texts)):
        following = texts[(i + 1) % len(texts)]
        half = len(text) // 2
        changed = text[: len(text) - half] + following[:half]
        assert (row.doc_id, row.n_chars, row.edited_sha256) == (i, len(text), hashlib.sha256(changed.encode()).hexdigest())
        assert (row.fingerprint, row.edited_fingerprint) == (prints[i], plain_fingerprint(changed))
        assert row.near_edited == pytest.approx(plain_likeness(prints[i], row.edited_fingerprint))
        assert row.near_next == pytest.approx(plain_likeness(prints[i], prints[(i + 1) % len(texts)]))


def plain_matches(lexicon, words):
    line = f" {' '.join(words)} ".replace("l", "i")
    weights = {}
    for entry, weight in lexicon.weights.items():
        name = entry.replace("l", "i")
        weights[name] = max(weight, weights.get(name, weight))

    def places(text):
        return [m.start() for m in re.finditer(f"(?={re.escape(text)})", line)]

    free = [(a, a + len(p) + 1) for p in {p.replace("l", "i") for p in lexicon.exceptions} for a in places(f" {p} ")]
    found = [(a, a + len(e), w) for e, w in weights.items() for a in places(f" {e}")]
    return sorted((a, w) for a, b, w in found if not any(x <= a and b <= y for x, y in free))


def test_matches_equal_plain_searches():
    rng = random.Random(8)
    parts = ["kill", "ill", "skil", "loser", "los", "ail", "a", "old"]
    for _ in range(200):
        weights = {p + rng.choice(["", " "]): rng.choice([1.0, 2.0]) for p in rng.sample(parts, 4)}
        lexicon = toxicity.Lexicon(weights, [" ".join(rng.choices(parts, k=2)) for _ in range(3)])
        words = rng.choices([*parts, "killer", "skilled", "losers", "x"], k=rng.randint(0, 30))
        # One entry at a place may be the beginning of another one there; each counts.
        assert sorted(lexicon.matches(words)) == plain_matches(lexicon, words)


def test_op5_equals_plain_scores(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    lexicon = toxicity.fit_lexicon(docs.select("doc_id", "text"), labels, in_fold(F.col("doc_id"), 4, 2))
    texts = {r.doc_id: r.text or "" for r in docs.collect()}
    for row in queries.QUERIES["op5_toxicity"](spark, FOLDER).collect():
        words = toxicity.folded_words(texts[row.doc_id])
        weight = sum(w for _, w in plain_matches(lexicon, words)) if words else 0.0
        offset, slope, by_length = lexicon.curve
        z = offset + slope * math.log1p(weight) + by_length * math.log1p(100 * weight / (len(words) + 20))
        assert row.score == pytest.approx(1 / (1 + math.exp(-max(-60.0, min(60.0, z)))))
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 4 == 2) and row.predicted == int(row.score >= 0.3)


@pytest.mark.parametrize("text", ["ki11 the 1oser", "k!ll the l0ser", "K|LL the lo­ser", "k​i‍ll the LÓSER", "кill the loseг"[:-1] + "r"])
def test_disguised_spellings(text):
    lexicon = toxicity.Lexicon({"kill ": 3.0, "loser ": 4.0})
    assert sorted(w for _, w in lexicon.matches(toxicity.folded_words(text))) == [3.0, 4.0]
    assert toxicity.folded_words("The end! Next | cell, 5 > 4!") == ["the", "end", "next", "cell", "s", "a"]


def test_many_exceptions_take_linear_time():
    lexicon = toxicity.Lexicon({"idiot ": 4.0}, ["idiot proof"])
    assert len(lexicon.matches(["idiot", "proof", "idiot", "x"] * 50_000)) == 50_000


def test_sample_does_not_follow_the_layout(spark):
    rows = [(i, f"text {i % 40}", i % 2) for i in range(400)]
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i // 7 % 2) for i, _, _ in rows], "doc_id long, toxic int")
    found = []
    for parts in (1, 3, 7):
        sample, sizes = samples.labelled_sample(docs.repartition(parts), labels.repartition(parts), "toxic", F.lit(False), 90)
        found.append(sorted(map(tuple, sample.select("key", "text", "label").collect())))
        assert sum(sizes.values()) == 400
    assert found[0] == found[1] == found[2] and len({t for _, t, _ in found[0]}) == len(found[0])


def test_op9_neighbours_and_pooling_equal_loops(spark):
    texts = [r.text or "" for r in spark.read.parquet(f"{FOLDER}/documents.parquet").limit(40).collect()] + ["", "one", "a a a b", "x " * 9000]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    places, signs = quality.random_vectors()
    sums = Counter()
    slots = [[zlib.crc32(t.encode()) % quality.SLOTS for t in quality._TOKEN.findall(text)] for text in texts]
    for own in slots:
        for i, word in enumerate(own):
            for j in range(max(0, i - quality.REACH), min(len(own), i + quality.REACH + 1)):
                if i != j:
                    for p, s in zip(places[own[j]], signs[own[j]]):
                        sums[word, int(p)] += int(s)
    found = {(r[0], i): n for r in quality.neighbour_sums(docs).collect() for i, n in enumerate(r[1:]) if n}
    assert found == {k: n for k, n in sums.items() if n}
    vectors = quality.word_vectors(docs)
    pooled = quality.pooled(vectors, np.array([len(s) for s in slots]), np.array([w for s in slots for w in s], np.uint16))
    for own, row in zip(slots, pooled):
        if not own:
            assert not row.any()
            continue
        words = vectors[own].astype(float)
        pairs = list(zip(own, own[1:]))
        plain = [*words.mean(axis=0), *words.std(axis=0), sum(a == b for a, b in pairs) / len(own),
                 sum(float(vectors[a] @ vectors[b]) for a, b in pairs) / len(own), len(set(own)) / len(own), math.log1p(len(own))]
        assert np.allclose(row, plain, atol=2e-3)


def test_op9_gradient_is_the_slope_of_the_loss():
    rng = np.random.default_rng(2)
    z, t = rng.normal(size=(30, 5)), rng.integers(0, 2, 30).astype(float)
    w = rng.random(30)
    w /= w.sum()
    parameters = [rng.normal(size=(5, 4)), rng.normal(size=4), rng.normal(size=4), np.array(0.3)]

    def loss(p):
        hidden = np.maximum(z @ p[0] + p[1], 0)
        y = 1 / (1 + np.exp(-(hidden @ p[2] + p[3])))
        log_loss = -(w * (t * np.log(y) + (1 - t) * np.log(1 - y))).sum()
        return log_loss + quality.PENALTY / 2 * ((p[0] ** 2).sum() + (p[2] ** 2).sum())

    for i, gradient in enumerate(quality.gradients(parameters, z, w, t)):
        for at in np.ndindex(np.shape(parameters[i])):
            moved = []
            for step in (1e-6, -1e-6):
                other = [p.copy() for p in parameters]
                other[i][at] += step
                moved.append(loss(other))
            assert (moved[0] - moved[1]) / 2e-6 == pytest.approx(np.asarray(gradient)[at], abs=1e-6)


def test_op7_repeated_vectors_send_few_entries(spark):
    vectors = [(i, [1.0, 2.0] if i % 10 else [float(i % 7), 1.0]) for i in range(6000)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    rows = {k: [math.floor(1024 * x) for x in v] for k, v in vectors}
    found = {}
    for r in topk.top_k(frame, F.col("vec_id") % 1000 == 0, k=4).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    for q in range(0, 6000, 1000):
        score = {k: sum(x * y for x, y in zip(rows[q], v)) for k, v in rows.items() if k != q}
        best = sorted(score, key=lambda k: (-score[k], k))[:4]
        assert sorted(found[q]) == [(i + 1, k, score[k]) for i, k in enumerate(best)]
    same = np.full((2, 900), 5)
    at, row = np.nonzero(np.ones((2, 900), bool))
    assert len(topk._distinct(at, row, [same, same], np.arange(900)[::-1], 4)) == 8
