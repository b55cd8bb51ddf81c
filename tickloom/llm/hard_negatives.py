"""Hard negatives by slots between the upper limits of the positives.

An anchor's positives are its best rows of the same label.  A negative suits a
positive when its score lies in a window that ends at the positive's score; the
windows of one anchor overlap.  Their upper limits, in descending order, split the
scores into disjoint slots: slot t holds the scores that t limits are not below.
The best rows of a window are the best of its own slot, filled up from the slots
below it, so the best ``k`` of every slot answer all windows.

Two passes over the rows, which stay where they are: the first keeps the best
positives of each anchor, the second the best negatives of each anchor and slot.
Each task keeps ``k`` rows for an anchor and slot (a combiner), the kept rows of
all tasks are merged by a window limit, and a merge from the lowest slot upwards
gives each window its rows.  Scores are whole, so ties are settled by id in every
task and a vector that is repeated a million times adds ``k`` rows.

Anchors are taken a block at a time: a job of its own for each, which adds its
result to the same staged folder, so what is broadcast is bounded by ``block`` and
no plan grows with the number of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.staging import fresh_path, stage

#: Anchors in a block, about; rows and anchors multiplied at a time.
BLOCK = 4096
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 4096, 128
#: Entries a task holds before it drops all but the best.
HELD = 1 << 18
_EXACT = 1 << 53
_LEAST = np.iinfo(np.int64).min

KEPT = "anchor_id long, slot int, vec_id long, score long"


def labelled_vectors(
    rows: DataFrame, scale: int, label: Column, key: str = "vec_id", vector: str = "embedding"
) -> DataFrame:
    """``vec_id, label, v`` with components ``floor(scale * x)``.

    Rows with a null id, label or vector, or with a null, NaN or infinite component take no part.  Repeated ids are one
    row, the one with the greatest label and then the greatest vector.
    """
    x = F.col(vector).cast("array<double>")
    finite = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    whole = rows.where(F.col(key).isNotNull() & finite).select(
        F.col(key).cast("long").alias("vec_id"),
        label.cast("long").alias("label"),
        F.transform(x, lambda c: F.floor(c * scale).cast("long")).alias("v"),
    )
    best = whole.where("label is not null").groupBy("vec_id").agg(F.max(F.struct("label", "v")).alias("r"))
    return best.select("vec_id", "r.label", "r.v")


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Vectors as rows; shorter ones are filled up with zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    sizes = np.asarray(lists.value_lengths(), np.int64)
    flat = np.asarray(lists.flatten(), dtype=np.int64)
    if (sizes == width).all():
        return flat.reshape(len(lists), width)
    out = np.zeros((len(lists), width), np.int64)
    ends = np.cumsum(sizes)
    out[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(flat)) - np.repeat(ends - sizes, sizes)] = flat
    return out


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """All inner products, exact: by floating point where no sum can pass 2**53, else by integers."""
    if anchors.size and rows.size:
        most = float(np.abs(anchors).max()) * float(np.abs(rows).max()) * rows.shape[1]
        if most >= 2.0**63:
            raise OverflowError("an inner product may not fit into 64 bits")
        if most >= _EXACT:
            return anchors @ rows.T
    return (anchors.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)


def _best(entries: np.ndarray, k: int) -> np.ndarray:
    """The first ``k`` of every (anchor, slot), by descending score and ascending id; columns as in ``KEPT``."""
    anchor, slot, row, score = entries
    order = np.lexsort((row, -score, slot, anchor))
    anchor, slot = anchor[order], slot[order]
    starts = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1]))))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return entries[:, order[rank < k]]


def _chosen(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of the allowed entries that may be among the ``k`` best of their line, ties of the k-th included."""
    if scores.shape[1] > k:
        held = np.where(allowed, scores, _LEAST)
        allowed = allowed & (held >= np.partition(held, -k, axis=1)[:, [-k]])
    return np.nonzero(allowed)


def _selection(block, width: int, k: int, slots: bool):
    """A mapInArrow function: what a task keeps for the anchors of a block.

    Without ``slots`` the best rows of the anchor's label, in slot 0; with them the best rows of other labels in every
    slot of the anchor, whose limits and floors the block brings along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, matrix, limits, floors = block.value
        held, count = [], 0
        for batch in batches:
            for a in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(a, ROWS_AT_ONCE)
                rows, own = np.asarray(part.column("vec_id")), np.asarray(part.column("label"))
                vectors = _matrix(part.column("v"), width)
                for q in range(0, len(ids), ANCHORS_AT_ONCE):
                    some = slice(q, q + ANCHORS_AT_ONCE)
                    scores = _scores(matrix[some], vectors)
                    same = labels[some, None] == own[None, :]
                    if slots:
                        number = (scores[:, :, None] <= limits[some, None, :]).sum(axis=2)
                        fit = ~same & (number > 0) & (scores >= floors[some, None])
                        picks = [(t, fit & (number == t)) for t in range(1, limits.shape[1] + 1)]
                    else:
                        picks = [(0, same & (ids[some, None] != rows[None, :]))]
                    for t, allowed in picks:
                        at, row = _chosen(scores, allowed, k)
                        held.append(np.stack([ids[some][at], np.full(len(at), t), rows[row], scores[at, row]]))
                        count += len(at)
                    if count > HELD:
                        held = [_best(np.concatenate(held, axis=1), k)]
                        count = held[0].shape[1]
                        if count > HELD // 2:
                            yield _record(held[0])
                            held, count = [], 0
        if count:
            yield _record(_best(np.concatenate(held, axis=1), k))

    return run


def _record(kept: np.ndarray) -> pa.RecordBatch:
    anchor, slot, row, score = kept
    columns = [pa.array(anchor), pa.array(slot.astype(np.int32)), pa.array(row), pa.array(score)]
    return pa.RecordBatch.from_arrays(columns, ["anchor_id", "slot", "vec_id", "score"])


def _ranked(kept: DataFrame, k: int) -> DataFrame:
    """The kept rows of all tasks merged: the best ``k`` of every anchor and slot."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    label: Column | None = None,
    positives: int = 5,
    negatives: int = 5,
    least: tuple[int, int] = (4, 5),
    scale: int = 256,
    key: str = "vec_id",
    vector: str = "embedding",
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for every anchor row.

    ``is_anchor`` is a condition on the column ``vec_id``; ``label`` the column of labels, ``label`` by default.  An
    anchor's positives are its ``positives`` best other rows of its label; for each, the best ``negatives`` rows of other
    labels are given whose score is at most the positive's and at least ``least`` of it (all, if there are fewer).  Scores
    are integer inner products of the scaled vectors and have to fit into 64 bits; ties go to the smaller id.  A positive
    without suitable rows has no row in the result.
    """
    spark = rows.sparkSession
    own = F.col("label") if label is None else label
    vectors = stage(labelled_vectors(rows, scale, own, key, vector), "vectors")
    width = vectors.agg(F.max(F.size("v"))).first()[0] or 0
    anchors = stage(vectors.where(is_anchor), "anchors")
    parts = max(1, -(-anchors.count() // block))
    over, under = least
    found, kept = fresh_path(spark, "positives"), fresh_path(spark, "slots")
    for path in (found, kept):
        spark.createDataFrame([], KEPT).write.parquet(path)
    for part in range(parts):
        some = anchors.where(F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part).orderBy("vec_id").toArrow()
        if not some.num_rows:
            continue
        ids, labels, matrix = np.asarray(some["vec_id"]), np.asarray(some["label"]), _matrix(some["v"], width)
        shared = spark.sparkContext.broadcast((ids, labels, matrix, None, None))
        first = vectors.mapInArrow(_selection(shared, width, positives, slots=False), KEPT)
        best = stage(_ranked(first, positives).select("anchor_id", "slot", "vec_id", "score"), "positives-block")
        best.write.mode("append").parquet(found)
        # At most ``positives`` limits for each anchor of the block.  A negative score's window is empty.
        limits = np.full((len(ids), positives), _LEAST, np.int64)
        floors = np.full(len(ids), np.iinfo(np.int64).max, np.int64)
        scores: dict[int, set[int]] = {}
        for anchor, score in best.where("score >= 0").select("anchor_id", "score").collect():
            scores.setdefault(anchor, set()).add(score)
        for i, anchor in enumerate(ids.tolist()):
            upper = sorted(scores.get(anchor, ()), reverse=True)
            limits[i, : len(upper)] = upper
            if upper:
                floors[i] = -(-over * upper[-1] // under)
        shared = spark.sparkContext.broadcast((ids, labels, matrix, limits, floors))
        second = vectors.mapInArrow(_selection(shared, width, negatives, slots=True), KEPT)
        _ranked(second, negatives).select("anchor_id", "slot", "vec_id", "score").write.mode("append").parquet(kept)
    return _windows(spark.read.parquet(found), spark.read.parquet(kept), negatives, over, under)


def _windows(found: DataFrame, kept: DataFrame, k: int, over: int, under: int) -> DataFrame:
    """Every positive's window: the suffix of its anchor's slots from its own on, cut to ``k`` rows and to its floor."""
    rank = Window.partitionBy("anchor_id").orderBy(F.desc("score"))
    # Equal scores are one limit, so a positive's slot is the number of different scores down to its own.
    limits = found.where("score >= 0").withColumn("slot", F.dense_rank().over(rank))
    listed = kept.groupBy("anchor_id").agg(
        F.array_sort(F.collect_list(F.struct("slot", (-F.col("score")).alias("below"), "vec_id"))).alias("entries")
    )
    suffix = F.slice(F.filter("entries", lambda e: e["slot"] >= F.col("slot")), 1, k)
    fit = F.filter(suffix, lambda e: -e["below"] * F.lit(under) >= F.col("score") * F.lit(over))
    return (
        limits.join(listed, "anchor_id")
        .select("anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.posexplode(fit).alias("n", "e"))
        .select(
            "anchor_id",
            "positive_id",
            (F.col("n") + 1).cast("int").alias("rank"),
            F.col("e.vec_id").alias("negative_id"),
            "positive_score",
            (-F.col("e.below")).alias("negative_score"),
        )
    )
