"""op1, op4, op6, op7, op8: queries that fingerprint, join, count and deal out whole documents, and search vectors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.fingerprints import compare_with_next
from tickloom.llm.mixing import SEED, mix
from tickloom.llm.near_duplicates import similar_components
from tickloom.llm.registry import query, table
from tickloom.llm.sharding import assign_shards
from tickloom.llm.topk import top_k


@query("op1_fingerprints")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all texts and of their edited texts."""
    return compare_with_next(table(spark, folder, "documents"))


OP4_SQL = f"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS size,
         substr(md5('{SEED}|' || coalesce(CAST(doc_id AS VARCHAR), '') || '|' || md5(coalesce(text, ''))), 1, 15) AS place
  FROM documents),
sums AS (SELECT source, CAST(sum(size) AS DOUBLE) AS n FROM sized GROUP BY source),
weighed AS (
  SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS w FROM sums),
running AS (
  SELECT *, 1.5 * sum(n) OVER () AS wanted, 2.0 * coalesce(sum(n) OVER earlier, 0) AS given,
         sum(w) OVER () - coalesce(sum(w) OVER earlier, 0) AS sharing
  FROM weighed
  WINDOW earlier AS (ORDER BY n / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
marked AS (SELECT *, 2.0 * n * sharing <= (wanted - given) * w AS capped FROM running),
targets AS (
  SELECT source, n, CASE WHEN capped THEN 2.0 * n ELSE
    w * (wanted - 2.0 * sum(CASE WHEN capped THEN n ELSE 0 END) OVER ()) / sum(CASE WHEN capped THEN 0 ELSE w END) OVER ()
    END AS target
  FROM marked),
wanted AS (
  SELECT *, CASE WHEN n > 0 THEN floor(target / n) ELSE 0 END AS whole FROM targets),
walked AS (
  SELECT s.source, s.place, sum(s.size) AS size, row_number() OVER (PARTITION BY s.source ORDER BY s.place) AS i,
         floor(any_value(w.target - w.whole * w.n)) AS part, any_value(w.target - w.whole * w.n) > 0 AS has_part
  FROM sized s JOIN wanted w ON s.source IS NOT DISTINCT FROM w.source GROUP BY s.source, s.place),
walk AS (
  SELECT source, place, i, size <= part AS fits, part - CASE WHEN size <= part THEN size ELSE 0 END AS rest
  FROM walked WHERE i = 1 AND has_part
  UNION ALL
  SELECT e.source, e.place, e.i, e.size <= w.rest, w.rest - CASE WHEN e.size <= w.rest THEN e.size ELSE 0 END
  FROM walk w JOIN walked e ON e.source IS NOT DISTINCT FROM w.source AND e.i = w.i + 1),
taken AS (
  SELECT e.source, e.place, w.n, w.target, w.whole + CASE WHEN k.fits THEN 1 ELSE 0 END AS repeats
  FROM walked e JOIN wanted w ON e.source IS NOT DISTINCT FROM w.source
  LEFT JOIN walk k ON k.source IS NOT DISTINCT FROM e.source AND k.place = e.place)
SELECT s.doc_id, CAST(s.size AS BIGINT) AS size, CAST(t.n AS BIGINT) AS source_size, round(t.target, 6) AS target,
       CAST(s.size * t.repeats AS BIGINT) AS taken
FROM sized s JOIN taken t ON s.source IS NOT DISTINCT FROM t.source AND s.place = t.place
"""


@query("op4_mixing", OP4_SQL)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that the mix takes."""
    return mix(table(spark, folder, "documents")).select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.round("mix_target", 6).alias("target"),
        (F.col("mix_size") * F.col("mix_repeats")).alias("taken"),
    )


@query("op6_jaccard")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose shingle sets are nine tenths alike."""
    return similar_components(table(spark, folder, "documents"))


OP7_SQL = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(list_zip(q.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors r ON q.vec_id % 100 = 0 AND q.vec_id <> r.vec_id)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM scored
QUALIFY rank <= 10
"""


@query("op7_topk", OP7_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    """The ten highest inner products of every hundredth vector."""
    return top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


# DuckDB has no CRC-32; its column is left to a test.
@query("op8_sharding")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    """Shard and slot of every document."""
    return assign_shards(table(spark, folder, "documents"))
