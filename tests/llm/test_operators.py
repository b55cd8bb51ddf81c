"""Every operator against a plain form, a round trip or planted cases."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from oracle import compare
from tickloom.llm import fingerprints as fp
from tickloom.llm import flat_tokens, mixing, near_duplicates, packing, quality, queries, sharding, token_frames, topk, toxicity
from tickloom.llm.chunks import token_encoder
from tickloom.llm.shared_files import reading
from tickloom.llm.token_queries import tokenizer_file
from tickloom.sources.staging import fresh_path

FOLDER = "/root/testdata/sf0.001"
TOKENIZERS = ("byte_bpe_50k.json", "word_bpe_49k.json")
LIBRARY = {name: Tokenizer.from_file(tokenizer_file(name)) for name in TOKENIZERS}


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    return dict(sorted((r.doc_id, r.text or "") for r in rows))


def encoded(name, batch):
    lengths, ids = token_encoder(tokenizer_file(name))(pa.array(batch, pa.string()))
    ends = np.cumsum(lengths)
    return [ids[e - n : e].tolist() for e, n in zip(ends, lengths)]


ODD = st.text(alphabet=st.sampled_from(list("ab'sT.,!?0é \n\t\r  \x1c\x85　́ßИ日<|>😀")), max_size=25)


@pytest.mark.parametrize("name", TOKENIZERS)
@settings(max_examples=150, deadline=None)
@given(batch=st.lists(ODD, max_size=8))
def test_ids_are_the_librarys(name, batch):
    batch = [*batch, "<|endoftext|> a", "don't  I'LL\n\n x "]
    assert encoded(name, batch) == [LIBRARY[name].encode(t, add_special_tokens=False).ids for t in batch]


def test_ids_of_documents(texts):
    some = list(texts.values())[:60]
    for name in TOKENIZERS:
        assert encoded(name, some) == [LIBRARY[name].encode(t, add_special_tokens=False).ids for t in some]


def test_op1_fields(spark, texts):
    rows = sorted(queries.QUERIES["op1_fingerprints"](spark, FOLDER).collect())
    order = list(texts)
    assert [r.doc_id for r in rows] == order
    near, chance = [], []
    for row, after in zip(rows, [*order[1:], order[0]]):
        text, half = texts[row.doc_id], len(texts[row.doc_id]) // 2
        changed = text[: len(text) - half] + texts[after][:half]
        assert row.n_chars == len(text) and row.edited_sha256 == hashlib.sha256(changed.encode()).hexdigest()
        assert row.fingerprint == fp.fingerprints([text.encode()])[0][0]
        assert row.edited_fingerprint == fp.fingerprints([changed.encode()])[0][0]
        if texts[after] != text:
            near.append(row.near_edited)
            chance.append(row.near_next)
    assert np.mean(near) > 0.45 and np.mean(chance) < 0.05 and 0 <= min(chance) and max(near) <= 1


def test_fingerprint_ranges_do_not_matter(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [sorted(map(tuple, fp.compare_with_next(docs, range_chars=size).collect())) for size in (20_000, 10**9)]
    assert rows[0] == rows[1]


@given(st.lists(st.tuples(st.text("abc", max_size=40), st.text("abc", max_size=40)), min_size=1, max_size=6))
@settings(max_examples=40, deadline=None)
def test_common_subsequences(pairs):
    def plain(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row = list(itertools.accumulate(zip(row, row[1:], b), lambda left, c: max(c[1], left, c[0] + (x == c[2])), initial=0))
        return row[-1]

    def padded(words):
        out = np.zeros((len(words), fp.LONGEST), np.uint8)
        for i, w in enumerate(words):
            out[i, : len(w)] = list(w.encode())
        return out

    left, right = zip(*pairs)
    assert fp._common(padded(left), padded(right)).tolist() == [plain(a, b) for a, b in pairs]


def test_token_files_round_trip(spark, texts):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    files = token_frames.write_token_files(docs, fresh_path(spark, "frames"), tokenizer_file(TOKENIZERS[0]), end_id=2)
    wanted, start = {}, 0
    ids = {k: LIBRARY[TOKENIZERS[0]].encode(t, add_special_tokens=False).ids + [2] for k, t in texts.items()}
    for key, own in ids.items():
        wanted[key] = (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)
    rows = token_frames.read_token_files(files).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == wanted
    listed = files.orderBy("part").collect()
    assert listed == sorted(listed, key=lambda f: f.start) and sum(f.n_ids for f in listed) == start
    with reading(listed[0].path) as source:
        reader = token_frames.FrameReader(source)
        some = [int(k) for k in reader.keys[[0, len(reader.keys) // 2, -1]]]
        assert {k: v.tolist() for k, v in reader.documents(some)} == {k: ids[k] for k in some}
        source.seek(0)
        # Any zstandard reader can read the whole file.
        whole = zstandard.ZstdDecompressor().stream_reader(source.read(), read_across_frames=True).read()
    assert np.frombuffer(whole, "<u4").tolist() == [i for k in reader.keys.tolist() for i in ids[k]]


def test_damaged_frames_are_noticed(tmp_path):
    path = f"{tmp_path}/x"
    with open(path, "wb") as stream:
        writer = token_frames.FrameWriter(stream)
        writer.add(1, np.arange(1000))
        writer.finish()
    data = bytearray(open(path, "rb").read())
    table = np.frombuffer(bytes(data[-21:-9]), token_frames._ENTRY).copy()
    table["checksum"] += 1
    data[-21:-9] = table.tobytes()
    open(path, "wb").write(bytes(data))
    with reading(path) as source, pytest.raises(ValueError):
        token_frames.FrameReader(source).frame(0)


@pytest.mark.parametrize("block", [1, 7, 1000])
def test_flat_files(spark, tmp_path, block):
    rng = np.random.default_rng(block)
    wanted, paths = [], []
    for number, (n, tail) in enumerate(((300, 0), (0, 0), (50, 5), (64, 0))):
        ids = rng.integers(1, 9, n).astype("<u2")
        ids[rng.random(n) < 0.3] = 0
        if n:
            ids[-1] = tail
        path = f"{tmp_path}/{number}.u16"
        open(path, "wb").write(ids.tobytes())
        paths.append((path,))
        cuts = [-1, *np.flatnonzero(ids == 0).tolist(), *([n] if tail else [])]
        wanted += [(path, i, a + 1, b - a - 1) for i, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    found = flat_tokens.token_counts(spark.createDataFrame(paths, "path string"), 0, block)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)


def test_op3_counts(spark, texts):
    rows = queries.QUERIES["op3_token_counts"](spark, FOLDER).collect()
    counts = {k: len(LIBRARY[TOKENIZERS[0]].encode(t, add_special_tokens=False).ids) for k, t in texts.items()}
    assert {r.doc_id: r.n_tokens for r in rows} == counts


@pytest.mark.parametrize("name", ["op4_mixing", "op7_topk"])
def test_oracles(spark, name):
    assert compare(spark, queries.QUERIES[name], queries.ORACLES[name], FOLDER) is None


def test_water_filling_in_rounds(spark):
    sizes = {"a": 10, "b": 1000, "c": 7, "d": 300, "e": 5000, None: 0}
    rows = spark.createDataFrame([(s, n // 2) for s, n in sizes.items()] + [(s, n - n // 2) for s, n in sizes.items()], "source string, size long")
    found = {r.source: r.target for r in mixing.source_targets(rows).collect()}
    weight = dict(zip(["a", "b", "c", "d", "e", None], (5, 2, 1, 5, 2, 1)))
    target, open_ = {}, set(sizes)
    while True:
        left = 1.5 * sum(sizes.values()) - sum(target.values())
        share = {s: left * weight[s] / sum(weight[x] for x in open_) for s in open_}
        above = {s for s in open_ if share[s] >= 2 * sizes[s]}
        if not above:
            break
        target.update({s: 2.0 * sizes[s] for s in above})
        open_ -= above
    assert found == pytest.approx({**target, **share})


def test_mix_takes_its_target(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(["w"] * rng.randint(0, 60)), rng.choice("aaaabc")) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    taken = mixing.mix(docs, weights=(1, 9, 3), total=1.2).collect()
    for source in "abc":
        own = [r for r in taken if r.source == source]
        assert abs(sum(r.mix_size * r.mix_repeats for r in own) - own[0].mix_target) <= 60
        assert all(0 <= r.mix_repeats <= 2 for r in own)
    again = mixing.mix(docs.repartition(7), weights=(1, 9, 3), total=1.2).collect()
    assert {r.doc_id: r.mix_repeats for r in taken} == {r.doc_id: r.mix_repeats for r in again}
    assert mixing.mixed_rows(docs, weights=(1, 9, 3), total=1.2).count() == sum(r.mix_repeats for r in taken)


def test_shards(spark, texts):
    def jump(key, shards):
        state, at, following = key % 2**64, -1, 0
        while following < shards:
            at, state = following, (state * 2862933555777941757 + 1) % 2**64
            following = int((at + 1) * (2.0**31 / ((state >> 33) + 1)))
        return at

    for row in queries.QUERIES["op8_sharding"](spark, FOLDER).collect():
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert (row.shard, row.grown_shard) == (jump(row.doc_id, 16), jump(row.doc_id, 17))
    keys = np.array([-1, -5, 2**62, 0, 1, 12345])
    assert sharding.jump_hash(keys, 1000).tolist() == [jump(int(k), 1000) for k in keys]


def test_slots_are_gapless(spark):
    rows = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))
    found = sharding.assign_shards(rows, shards=2).toPandas()
    for _, own in found.groupby("shard"):
        assert sorted(own.slot) == list(range(len(own)))


def test_topk_by_numpy(spark):
    rng = np.random.default_rng(7)
    vectors = rng.normal(size=(900, 12))
    vectors[5] = vectors[6] = vectors[7]  # ties
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(5)
    whole = np.floor(1024 * vectors).astype(np.int64)
    for lists, block in ((2, 4096), (3, 4)):
        found = sorted(map(tuple, topk.top_k(frame, F.col("vec_id") % 100 == 0, 10, lists=lists, block=block).collect()))
        wanted = []
        for q in range(0, 900, 100):
            scores = whole @ whole[q]
            best = sorted((i for i in range(900) if i != q), key=lambda i: (-scores[i], i))[:10]
            wanted += [(q, n + 1, i, int(scores[i])) for n, i in enumerate(best)]
        assert found == wanted


def plain_components(texts, width=3):
    sets = {}
    for key, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets[key] = {tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()
    root = {k: k for k in sets}
    for a, b in itertools.combinations(sorted(sets), 2):
        common = len(sets[a] & sets[b])
        if common and 100 * common >= 90 * (len(sets[a]) + len(sets[b]) - common):
            old, new = max(root[a], root[b]), min(root[a], root[b])
            root = {k: new if r == old else r for k, r in root.items()}
    return {k: (len(s), root[k]) for k, s in sets.items()}


def test_components_of_edited_copies(spark):
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(400)]
    texts, key = {}, 0
    for n in (1, 2, 3, 4, 8, 10, 12, 19, 20, 21, 40, 90, 200, 600):
        base = [rng.choice(vocabulary) for _ in range(n)]
        chain = list(base)
        for copy in range(9):
            own = list(base)
            if copy > 5:  # each one a step further away
                chain[rng.randrange(n)] = f"c{key}"
                own = list(chain)
            else:
                for _ in range(rng.choice((0, 1, 1, max(1, n // 60), max(1, n // 25)))):
                    own[rng.randrange(n)] = f"x{key}"
            texts[key] = " ".join(own).upper() if copy == 3 else "\n".join(own)
            key += 1
    shared = " ".join(rng.choice(vocabulary) for _ in range(60))
    for i in range(25):  # one passage in many unlike texts
        texts[key] = shared + " " + " ".join(rng.choice(vocabulary) + str(i) for _ in range(8 + i))
        key += 1
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates.similar_components(docs).collect()}
    assert found == plain_components(texts)


def test_similar_sets_meet():
    """Random pairs at the limit of similarity share a signature under every allocation."""
    rng = np.random.default_rng(3)
    for sets in (1, 10_000, 10**8):
        for size in (1, 2, 5, 9, 10, 11, 15, 19, 20, 30, 57, 100, 333, 1200):
            for _ in range(12):
                pool = rng.integers(0, 2**64, 2 * size + 2, dtype=np.uint64)
                x = np.unique(pool[:size])
                gone = rng.integers(0, size + 1)
                y = np.unique(np.concatenate([x[rng.permutation(len(x))][: len(x) - gone], pool[size : size + rng.integers(0, size // 9 + 2)]]))
                while len(y) and not near_duplicates.similar(x, y):
                    missing = np.setdiff1d(x, y)
                    if not len(missing):
                        y = x
                    y = np.union1d(y, missing[:1])
                if not len(y) or np.array_equal(x, y):
                    continue
                both = np.array([len(x), len(y)]), np.concatenate([x, y])
                owner, signature, kind = near_duplicates.signatures(*both, sets)
                rows = [set(zip(signature[owner == i].tolist(), kind[owner == i].tolist())) for i in (0, 1)]
                full = [{s for s, k in r if k < 2} for r in rows]
                drawn = near_duplicates.sketches(*both)
                for a, b in itertools.product((0, 1), repeat=2):
                    if len(drawn[a][0]) == len(drawn[b][1]) > 0:
                        unlike = sum(p != q for p, q in zip(drawn[a][0], drawn[b][1]))
                        assert unlike <= len(np.setxor1d(x, y)) or a != b and np.diff(np.searchsorted(near_duplicates.bands(size), both[0], side="right"))[0] == 0
                every = [{s for s, _ in r} for r in rows]
                assert full[0] & every[1] or full[1] & every[0], (sets, size, len(y))


def test_op6_whole_table(spark, texts):
    found = queries.QUERIES["op6_jaccard"](spark, FOLDER).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == plain_components(texts)


def fewest(lengths, capacity):
    """Least number of sequences, by trying every partition."""
    best = len(lengths)

    def place(i, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if i == len(lengths):
            best = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= lengths[i] and rooms[j] not in rooms[:j]:
                place(i + 1, rooms[:j] + [rooms[j] - lengths[i]] + rooms[j + 1 :])
        place(i + 1, rooms + [capacity - lengths[i]])

    place(0, [])
    return best


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=9))
def test_packing_is_the_best_there_is(lengths):
    found = packing.complete_bins(np.array(lengths, np.int64), 20)
    assert sorted(n for s in found for n in s) == sorted(lengths) and all(sum(s) <= 20 for s in found)
    assert len(found) == (fewest(sorted(lengths, reverse=True), 20) if lengths else 0)


def test_op10_sequences(spark, texts):
    rows = queries.QUERIES["op10_packing"](spark, FOLDER).toPandas()
    total = 0
    for key, own in rows.groupby("doc_id"):
        ids = LIBRARY[TOKENIZERS[1]].encode(texts[key], add_special_tokens=False).ids + [0]
        own = own.sort_values("piece")
        assert list(own.start) == list(range(0, len(ids), 2048)) and own.length.sum() == len(ids)
        for piece in own.itertuples():
            part = np.array(ids[piece.start : piece.start + piece.length], "<u4")
            assert piece.ids_crc32 == zlib.crc32(part.tobytes()) and len(part) == piece.length <= 2048
        total += len(ids)
    for _, own in rows.groupby("sequence_id"):
        own = own.sort_values("offset")
        assert list(own.offset) == list(np.cumsum(own.length) - own.length) and own.length.sum() <= 2048
    assert rows.doc_id.nunique() == len(texts) and rows.sequence_id.nunique() <= -(-total // 2048) + 1


def held_out(spark, name, label):
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet").select("doc_id", label)
    rows = queries.QUERIES[name](spark, folder).join(labels, "doc_id").where("held_out").toPandas()
    high, low = rows[rows[label] == 1].score, rows[rows[label] == 0].score
    return np.mean([(a > b) + (a == b) / 2 for a in high for b in low]), (rows.predicted == rows[label]).mean()


@pytest.mark.parametrize("name,label", [("op5_toxicity", "toxic"), ("op9_quality", "quality")])
def test_held_out_accuracy(spark, name, label):
    ranked, right = held_out(spark, name, label)
    assert ranked > 0.95 and right > 0.9


def test_folding_and_exceptions():
    assert toxicity.folded_words("ІDІ0T, ídiót! l0$er") == ["idiot", "idiot", "loser"]
    lexicon = toxicity.Lexicon({"idiot ": 4.0, "lowei": 2.0}, ["idiot proof"])
    words = toxicity.folded_words("An idiot-proof plan by loweichen, no idiots, one idiot.")
    assert [w for _, w in lexicon.matches(words)] == [2.0, 4.0]
    assert lexicon.score(words) > lexicon.score(["a", "plan"])


def test_pooling():
    vectors = np.random.default_rng(0).normal(size=(quality.SLOTS, 2 * quality.WIDTH)).astype(np.float32)
    slots = np.array([3, 3, 5, 9, 3], np.int64)
    x = quality.pooled(vectors, np.array([3, 0, 2]), slots)
    assert np.allclose(x[0, : 2 * quality.WIDTH], vectors[[3, 3, 5]].mean(axis=0), atol=1e-5) and not x[1].any()
    assert x[0, -4] == pytest.approx(1 / 3) and x[0, -2] == pytest.approx(2 / 3) and x[2, -2] == 1


def test_pipeline_keeps_what_it_should(spark, tmp_path):
    """Planted toxic, poor, copied and clean documents of three sources, and the rows that must be left."""
    rng = random.Random(5)
    words = ["".join(rng.choice("aeioulnrst") for _ in range(rng.randint(3, 8))) for _ in range(500)]

    def prose(n=60):
        return " ".join(rng.choice(words) for _ in range(n)).capitalize() + "."

    rows, kinds = [], {}
    for i in range(420):
        kind = ("clean", "clean", "clean", "clean", "toxic", "poor")[i % 6]
        text = prose()
        if kind == "toxic":
            parts = text.split()
            for word in rng.sample(["idiot", "moron", "scum", "clown"], 2):
                parts.insert(rng.randrange(len(parts)), word)
            text = " ".join(parts)
        elif kind == "poor":
            text = " ".join(f"{w.upper()}!!" for w in text.split())
        rows.append((i, text, "en", f"s{i % 3}", len(text)))
        kinds[i] = kind
    clean = [r for r in rows if kinds[r[0]] == "clean"][:40]
    for r in clean:  # a copy with one word more
        rows.append((r[0] + 1000, r[1] + " more", *r[2:]))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    folder = str(tmp_path)
    docs.write.parquet(f"{folder}/documents.parquet")
    labels = [(i, int(k != "poor"), int(k == "toxic")) for i, k in kinds.items()]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["toxicity"](spark, docs, folder)
    assert {r.doc_id for r in kept.collect()} == {r[0] for r in rows if kinds.get(r[0]) != "toxic"}
    kept = stages["quality"](spark, kept, folder)
    left = {r.doc_id: r.text for r in kept.collect()}
    assert set(left) == {r[0] for r in rows if kinds.get(r[0], "clean") == "clean"}
    kept = stages["near_duplicates"](spark, kept, folder)
    once = {r.doc_id for r in kept.collect()}
    assert once == {k for k, (_, root) in plain_components(left).items() if k == root} and len(once) == 280
    packed = corpus_pipeline.run(spark, folder).toPandas()
    repeats = {r.doc_id: r.mix_repeats for r in mixing.mix(docs.where(F.col("doc_id").isin(list(once)))).collect()}
    assert packed[packed.piece == 0].doc_id.value_counts().to_dict() == {k: n for k, n in repeats.items() if n}
    assert (packed.groupby("sequence_id").length.sum() <= 2048).all()
