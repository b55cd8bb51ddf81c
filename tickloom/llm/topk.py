"""Exact top-k by inner product in three phases with a uniform threshold.

The dimensions are split into lists; a row's score is the sum of its local scores,
one for each list.  For a block of queries:

1. every list gives each query's k rows of the highest local score, as many again
   for each partition.  The other lists add what they have for these rows; the
   k-th best sum is a score that the result surely reaches;
2. that score shared equally by the lists is the cutoff: a row below it in every
   list is below the result.  Lists give all entries that reach the cutoff.  The
   k-th best sum of rows that all lists named is taken again, and rows whose upper
   bound, with the cutoff in place of what is not known, stays under it are dropped;
3. the scores of the rows that remain are completed exactly.

Rows are read by partition; what goes over the network are the entries, and what
is broadcast is one block of queries and two numbers for each, so their size is
set by ``block`` and not by the data.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.sources.staging import stage

LISTS = 2
QUERY_BLOCK = 4096
ROW_BLOCK, QUERIES_AT_ONCE = 4096, 256
_EXACT = 1 << 53


def integer_vectors(rows: DataFrame, scale: int, key: str, vector: str) -> DataFrame:
    """``vec_id, v``: components as ``floor(scale * x)``.  Vectors null or with null, NaN or infinite ones are left out."""
    x = F.col(vector).cast("array<double>")
    finite = F.coalesce(F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))), F.lit(False))
    return (
        rows.where(F.col(key).isNotNull() & finite)
        .select(F.col(key).cast("long").alias("vec_id"), x.alias("x"))
        .select("vec_id", F.transform("x", lambda c: F.floor(c * scale).cast("long")).alias("v"))
    )


def _matrix(column: pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(lists.flatten(), dtype=np.int64).reshape(len(lists), -1)


def _product(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all queries and rows, exact: by floating point where no sum can pass 2**53, else by integers."""
    if queries.size and rows.size:
        most = float(np.abs(queries).max()) * float(np.abs(rows).max()) * rows.shape[1]
        if most >= 2.0**63:
            raise OverflowError("an inner product may not fit into 64 bits")
        if most >= _EXACT:
            return queries @ rows.T
    return (queries.astype(np.float64) @ rows.T.astype(np.float64)).astype(np.int64)


def _parts(dimensions: int, lists: int) -> list[slice]:
    edges = np.linspace(0, dimensions, min(lists, max(1, dimensions)) + 1).astype(int)
    return [slice(a, b) for a, b in zip(edges, edges[1:])]


ENTRY = "query_id long, list int, vec_id long, score long"


def _distinct(at: np.ndarray, row: np.ndarray, local: list[np.ndarray], rows: np.ndarray, k: int) -> np.ndarray:
    """Of a query's rows that are alike in every list the ``k`` least ids: the others can't be in its result."""
    scores = [scores[at, row] for scores in local]
    order = np.lexsort((rows[row], *scores, at))
    same = np.ones(max(0, len(order) - 1), bool)
    for column in (at, *scores):
        same &= column[order][1:] == column[order][:-1]
    starts = np.flatnonzero(np.concatenate(([True], ~same)))
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return np.sort(order[rank < k])


def _entries(queries, parts, chosen, whole: bool, k: int):
    """A mapInArrow function: the entries that ``chosen(queries, local scores)`` picks in each list.

    ``whole``: with the local scores that the other lists have for the picked rows, which stand in the same partition.
    Of rows that are alike to a query in every list, such as repeated vectors, a block of rows gives the first ``k``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix = queries.value
        for batch in batches:
            for a in range(0, batch.num_rows, ROW_BLOCK):
                block = batch.slice(a, ROW_BLOCK)
                rows, vectors = np.asarray(block.column("vec_id")), _matrix(block.column("v"))
                for q in range(0, len(ids), QUERIES_AT_ONCE):
                    some = slice(q, q + QUERIES_AT_ONCE)
                    other = ids[some, None] != rows[None, :]
                    local = [_product(matrix[some, part], vectors[:, part]) for part in parts]
                    picked = [chosen(some, scores, other) & other for scores in local]
                    either = np.logical_or.reduce(picked)
                    at, row = np.nonzero(either)
                    kept = _distinct(at, row, local, rows, k)
                    if len(kept) < len(at):
                        some_rows = np.zeros(either.shape, bool)
                        some_rows[at[kept], row[kept]] = True
                        picked, either = [mask & some_rows for mask in picked], some_rows
                    if whole:
                        picked = [either] * len(parts)
                    for number, (mask, scores) in enumerate(zip(picked, local)):
                        at, row = np.nonzero(mask)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(ids[some][at]),
                                pa.array(np.full(len(at), number, np.int32)),
                                pa.array(rows[row]),
                                pa.array(scores[at, row]),
                            ],
                            ["query_id", "list", "vec_id", "score"],
                        )

    return run


def _highest(k: int):
    def chosen(_some, local, other):
        if local.shape[1] <= k:
            return np.ones(local.shape, bool)
        local = np.where(other, local, np.iinfo(np.int64).min)
        # All that equal the k-th: a tie can't be settled before the whole scores are known.
        return local >= np.partition(local, -k, axis=1)[:, [-k]]

    return chosen


def _reach(entries: DataFrame, lists: int, k: int) -> tuple[DataFrame, DataFrame]:
    """The rows that lists named, and for each query the k-th best of the scores that all lists together know."""
    seen = entries.groupBy("query_id", "vec_id").agg(F.sum("score").alias("known"), F.count("*").alias("lists"))
    best = Window.partitionBy("query_id").orderBy(F.desc("known"), "vec_id")
    reach = (
        seen.where(F.col("lists") == lists)
        .withColumn("n", F.row_number().over(best))
        .where(F.col("n") <= k)
        .groupBy("query_id")
        .agg(F.min("known").alias("reach"), F.count("*").alias("n"))
        .where(F.col("n") == k)
        .drop("n")
    )
    return seen, reach


def _top_of_block(spark, vectors: DataFrame, ids: np.ndarray, matrix: np.ndarray, k: int, lists: int) -> DataFrame:
    parts = _parts(matrix.shape[1], lists)
    lists = len(parts)
    queries = spark.sparkContext.broadcast((ids, matrix))

    # Phase 1: the highest of every list in every partition, with their scores in the other lists.
    first = vectors.mapInArrow(_entries(queries, parts, _highest(k), whole=True, k=k), ENTRY)
    reach = dict(_reach(first, lists, k)[1].collect())

    # Phase 2: all entries that reach an equal share of it; all, where a query has fewer than k rows to go by.
    lowest = np.iinfo(np.int64).min
    cutoffs = np.array([-(-reach[q] // lists) if q in reach else lowest for q in ids.tolist()], np.int64)
    cut = spark.sparkContext.broadcast(cutoffs)

    def sufficient(some, local, _other):
        return local >= cut.value[some, None]

    second = stage(vectors.mapInArrow(_entries(queries, parts, sufficient, whole=False, k=k), ENTRY), "topk-entries")
    seen, better = _reach(second, lists, k)
    limits = spark.createDataFrame(
        [(q, int(c), reach.get(q)) for q, c in zip(ids.tolist(), cutoffs)], "query_id long, cutoff long, first long"
    )
    # What a list did not name is below the cutoff there.
    high = F.col("known") + (lists - F.col("lists")) * (F.col("cutoff") - 1)
    least = F.greatest("first", "reach")
    left = (
        seen.join(limits, "query_id").join(better, "query_id", "left").where(F.col("first").isNull() | (high >= least))
    )

    # Phase 3: exact scores of the rows that remain.
    own = spark.createDataFrame([(q, m.tolist()) for q, m in zip(ids.tolist(), matrix)], "query_id long, q array<long>")
    pairs = left.select("query_id", "vec_id").join(vectors, "vec_id").join(own, "query_id")
    dot = F.aggregate(F.zip_with("q", "v", lambda a, b: a * b), F.lit(0).cast("long"), lambda s, x: s + x)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        pairs.select("query_id", "vec_id", dot.alias("score"))
        .withColumn("rank", F.row_number().over(ranked).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )


def top_k(
    rows: DataFrame, is_query, k: int = 10, scale: int = 1024, lists: int = LISTS, block: int = QUERY_BLOCK,
    key: str = "vec_id", vector: str = "embedding",
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` rows of the highest integer inner product for every query row.

    ``is_query`` is a condition on the column ``vec_id``.  A query is never its own result; ties go to the smaller id,
    and where there are fewer than ``k`` other rows all of them are given.  Vectors must be of one length.  Rows with
    one id are one row: repeated ids take the greatest vector.  Queries are taken ``block`` at a time.
    """
    spark = rows.sparkSession
    vectors = integer_vectors(rows, scale, key, vector).groupBy("vec_id").agg(F.max("v").alias("v"))
    vectors = stage(vectors, "topk-vectors")
    queries = vectors.where(is_query)
    parts = max(1, -(-queries.count() // block))
    out = None
    for part in range(parts):
        mine = F.pmod(F.xxhash64("vec_id"), F.lit(parts)) == part
        some = queries.where(mine).orderBy("vec_id").toArrow()
        if not some.num_rows:
            continue
        top = _top_of_block(spark, vectors, np.asarray(some["vec_id"]), _matrix(some["v"]), k, lists)
        out = top if out is None else out.unionByName(top)
    if out is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return out
