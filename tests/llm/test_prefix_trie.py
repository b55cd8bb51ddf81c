"""The trie of conversations against one built turn by turn, and the decomposition against plain sums."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from oracle import compare
from tickloom.llm import prefix_trie as trie
from tickloom.llm import queries

FOLDER = "/root/testdata/sf0.001"
DDL = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes, from turns in the order given: (conv_id, turn, role, text) with distinct turns."""
    own = defaultdict(list)
    for conv, turn, role, text in sorted((r for r in rows if r[0] is not None), key=lambda r: (r[0], r[1] is not None, r[1] or 0)):
        own[conv].append((role or "", text or ""))
    members, ends = defaultdict(list), defaultdict(list)
    for conv in sorted(own):
        h = zlib.crc32(str(conv).encode()) % 6
        turns = own.get(conv - int(np.fmod(conv, 100)), [])[:h] + own[conv][h:]
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(conv)
        ends[tuple(turns)].append(conv)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children[path]
        leaves[path] = sum(leaves[c] for c in below) or 1
        saved[path] = sum(saved[c] for c in below) + (len(members[path]) - 1) * (len(path[-1][1]) if path else 0)
    return sorted(
        (members[p][0], len(p), members[p[:-1]][0] if p else -1, len(members[p]), len(children[p]), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, ends[p])).encode()).hexdigest())
        for p in members
    )


def built(spark, rows, **options):
    frame = rows if hasattr(rows, "columns") else spark.createDataFrame(rows, DDL).repartition(5)
    out = trie.prefix_trie(*trie.borrow_heads(trie.order_turns(frame), 100, 5), **options)
    return sorted((*r[:2], -1 if r.parent_conv_id is None else r.parent_conv_id, *r[3:]) for r in out.collect())


def conversations(seed, count, longest, words):
    rng = random.Random(seed)
    return [
        (conv, turn, rng.choice(["user", "assistant", None]) if words > 1 else "user", rng.choice(["", None, "é😀", "a", "bc"][: words + 1]))
        for conv in rng.sample(range(-50, 700), count)
        for turn in range(rng.randint(1, longest))
    ]


@pytest.mark.parametrize("seed, longest, words, bound", [(1, 6, 2, 4), (2, 12, 1, 30), (3, 4, 4, 10**6), (4, 30, 1, 1)])
def test_equal_to_a_trie_built_by_hand(spark, seed, longest, words, bound):
    rows = conversations(seed, 120, longest, words)
    assert built(spark, rows, bound=bound) == plain(rows)


def test_one_long_conversation_and_many_copies(spark, monkeypatch):
    monkeypatch.setattr(trie, "PIECE_IDS", 7)
    monkeypatch.setattr(trie, "TOGETHER", 50)
    rows = [(3, i, "user", f"turn {i % 7}") for i in range(9000)]
    rows += [(c, i, "user", f"copy {i}") for c in range(1000, 1100) for i in range(4)]
    rows += [(100 * c, i, "a", "b") for c in range(50, 60) for i in range(c % 3 + 1)]
    assert built(spark, rows, bound=2000) == plain(rows)


def test_edges(spark):
    rows = [
        (1, None, "user", "null first"), (1, 0, None, None), (1, 5, "user", "gap"), (None, 0, "user", "no id"),
        (7, 3, "", ""), (100, 0, "user", "lent"), (160, 0, "user", "lost"), (161, 1, "x", "y"),
    ]
    frame = spark.createDataFrame(rows, DDL).withColumns({n: F.lit("clash") for n in ("pos", "said", "node", "weight", "comp", "length")})
    assert built(spark, frame) == plain(rows)
    assert built(spark, spark.createDataFrame([], DDL)) == []
    assert built(spark, spark.createDataFrame([(None, 1, "a", "b")], DDL)) == []
    # Repeated rows are turns like any other; turns of one number stand in the order of their digest.
    turns = [(100, 0, "u", "t"), (100, 0, "u", "t"), (100, 0, "u", "a"), (100, 1, "u", "z")]
    got = trie.order_turns(spark.createDataFrame(turns, DDL)).orderBy("pos").collect()
    digests = sorted(hashlib.md5(b"1:u" + t.encode()).hexdigest() for t in "tta") + [hashlib.md5(b"1:uz").hexdigest()]
    assert [r.said for r in got] == digests and [r.pos for r in got] == [1, 2, 3, 4]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=60), st.booleans(), st.integers(0, 10**6))
def test_decomposition_of_any_forest(choices, deep, seed):
    n = len(choices)
    parent = np.array([i if i == 0 or c % 11 == 0 else (i - 1 if deep and c % 3 else c % i) for i, c in enumerate(choices)])
    rng = np.random.default_rng(seed)
    members, values, acc = rng.integers(1, 5, n), rng.integers(-9, 9, (n, 2)), rng.integers(0, 3, (n, 2))
    weight, sums = members.copy(), values.copy()
    for i in range(n - 1, -1, -1):
        if parent[i] != i:
            weight[parent[i]] += weight[i]
            sums[parent[i]] += sums[i]
    total, rounds = trie.decompose(parent, weight, values, acc)
    assert (total == sums + acc).all()
    assert rounds <= int(weight.max()).bit_length()


def test_rounds_do_not_follow_the_depth():
    n = 1 << 14
    parent = np.maximum(np.arange(n) - 1, 0)
    weight = np.arange(n, 0, -1)
    total, rounds = trie.decompose(parent, weight, np.ones((n, 1), int), np.zeros((n, 1), int))
    assert (total[:, 0] == weight).all() and rounds <= 15


def test_query(spark):
    assert compare(spark, queries.QUERIES["op13_prefix_trie"], queries.ORACLES["op13_prefix_trie"], FOLDER) is None
    rows = queries.QUERIES["op13_prefix_trie"](spark, FOLDER)
    table = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((*r[:2], -1 if r[2] is None else r[2], *r[3:]) for r in rows.collect()) == plain(table)
