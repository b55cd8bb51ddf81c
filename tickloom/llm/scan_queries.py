"""op11, op12, op13: queries that scan texts for licenses, mine hard negatives and build the trie of conversations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.hard_negatives import hard_negatives
from tickloom.llm.licenses import license_labels, scan_licenses
from tickloom.llm.prefix_trie import borrow_heads, order_turns, prefix_trie
from tickloom.llm.registry import query, table


# SQL has the base places, but not the rules' labels; tests hold both against plain loops.
@query("op11_licenses")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    """Licenses that every document names."""
    return license_labels(scan_licenses(table(spark, folder, "documents")))


OP12_SQL = """
WITH vectors AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, a.label = r.label AS same, r.vec_id,
         list_sum(list_transform(list_zip(a.v, r.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors a JOIN vectors r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
positives AS (
  SELECT anchor_id, vec_id, score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, p.vec_id AS positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id)::INT AS rank,
       n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON p.anchor_id = n.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
"""


@query("op12_hard_negatives", OP12_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label)


# CRC-32 bit by bit: the bits of the id's digits, the least first.
OP13_SQL = """
WITH turns AS (
  SELECT conv_id, turn, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS said,
         length(coalesce(text, '')) AS chars
  FROM conversations WHERE conv_id IS NOT NULL),
own AS (
  SELECT conv_id, list({'said': said, 'chars': chars} ORDER BY turn NULLS FIRST, said) AS turns,
         CAST(conv_id AS VARCHAR) AS digits FROM turns GROUP BY conv_id),
hashed AS (
  SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], range(0, 8 * length(digits))), lambda c, t:
    xor(xor(c, CASE WHEN t % 8 = 0 THEN ascii(substr(digits, t // 8 + 1, 1)) ELSE 0 END) >> 1,
        3988292384 * (xor(c, CASE WHEN t % 8 = 0 THEN ascii(substr(digits, t // 8 + 1, 1)) ELSE 0 END) & 1))),
    4294967295) % 6 AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 100),
steps AS (
  SELECT conv_id, unnest(range(0, len(turns) + 1)) AS depth, turns,
         list_transform(turns, lambda t: t.said) AS said FROM rebuilt),
nodes AS (
  SELECT said[1:depth] AS path, min(conv_id) AS conv_id, depth, count(*) AS n_convs,
         coalesce(max(turns[depth].chars), 0) AS chars,
         coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(turns) = depth), '') AS ends
  FROM steps GROUP BY ALL),
linked AS (
  SELECT n.*, p.conv_id AS parent_conv_id, count(*) FILTER (k.path IS NOT NULL) AS n_children
  FROM nodes n LEFT JOIN nodes p ON n.depth = p.depth + 1 AND n.path[1:p.depth] = p.path
  LEFT JOIN nodes k ON k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path
  GROUP BY ALL),
sums AS (
  SELECT above, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * chars) AS saved_tokens
  FROM (SELECT path[1:unnest(range(0, depth + 1))] AS above, n_children, n_convs, chars FROM linked) GROUP BY above)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(ends) AS ends_sha256
FROM linked JOIN sums ON above = path
"""

#: Conversations borrow the head of every so many-th one, at most so many turns.
LENDERS, MOST_HEADS = 100, 5


@query("op13_prefix_trie", OP13_SQL)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    """The trie of all rebuilt conversations."""
    return prefix_trie(*borrow_heads(order_turns(table(spark, folder, "conversations")), LENDERS, MOST_HEADS))
