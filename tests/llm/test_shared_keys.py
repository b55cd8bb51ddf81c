"""Near duplicates of rows that share a key, and packing of rows that are equal."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tickloom.llm import near_duplicates, packing


def text(seed, changed=()):
    words = [f"w{w}" for w in random.Random(seed).choices(range(5000), k=200)]
    for i in changed:
        words[i] = f"x{i}"
    return " ".join(words)


def test_each_row_is_linked_by_its_own_set(spark):
    a, b, c = text(1), text(2), text(3)
    near_a, near_b = text(1, [7]), text(2, [100])
    rows = [(1, a), (1, b), (2, near_a), (3, near_b), (4, c), (4, c), (4, text(4)), (-5, text(3, [9])), (6, text(6)), (None, a)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates.similar_components(docs).collect()
    assert sorted((r.doc_id or 0, r.component_id) for r in found if r.doc_id is not None) == [
        (-5, -5), (1, 1), (1, 1), (2, 1), (3, 1), (4, -5), (4, -5), (4, 4), (6, 6),
    ]
    assert [r.component_id for r in found if r.doc_id is None] == [None]


def test_many_equal_rows_fill_several_groups(spark):
    pieces = spark.range(3000).select(
        F.when(F.col("id") < 2500, None).otherwise(F.col("id")).alias("key"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
        F.when(F.col("id") < 2500, 300).otherwise(F.col("id") % 900 + 1).cast("long").alias("length"), F.lit(5).cast("long").alias("ids_crc32"),
    )
    grouped = packing._grouped(pieces, 10, 0, 300).groupBy("group").count().collect()
    assert len(grouped) == 10 and max(r["count"] for r in grouped) < 500
    rows = packing.pack_pieces(pieces, group_pieces=300).collect()
    assert len(rows) == 3000
    sequences = {}
    for r in rows:
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= packing.CAPACITY
