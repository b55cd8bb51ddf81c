"""Bounded samples of labelled rows, for fitting."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.stacking import stack
from tickloom.sources.staging import stage


def in_fold(key: Column, folds: int, fold: int) -> Column:
    """Whether a row belongs to a fold by the CRC-32 of its key as text; a null key belongs to none."""
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, held_out: Column, per_class: int, key: str = "doc_id", text: str = "text"
) -> tuple[DataFrame, dict[int, int]]:
    """``key, text, label`` of at most ``per_class`` rows of each class outside ``held_out``, and the classes' sizes.

    Rows are taken in the order of a hash of their key.  A key labelled twice counts once, with its greater label;
    labels other than 0 and 1 are left out, and of rows with equal texts the first one in that order is taken.
    """
    known = (
        labels.where(F.col(label).isin(0, 1) & F.col(key).isNotNull() & ~held_out)
        .groupBy(F.col(key).alias("key"))
        .agg(F.max(label).cast("int").alias("label"))
    )
    counts = {int(r[0]): int(r[1]) for r in known.groupBy("label").count().collect()}
    if not counts:
        return stage(docs.select(F.col(key).alias("key"), F.lit("").alias("text"), F.lit(0).alias("label")).limit(0), "labelled-texts"), counts
    # A class's rows of the least hashes: those below a bound that leaves few more than are wanted, then the first ones.
    place = F.shiftrightunsigned(F.xxhash64("key"), 1)
    few = stack(*[_least(known.withColumn("place", place), label, n, per_class) for label, n in counts.items()])
    few = stage(few, "labelled-keys")
    texts = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    # Of equal texts the row that comes first counts, wherever the rows are stored.
    one = F.min(F.struct("place", "key", "label")).alias("one")
    joined = texts.join(few, "key").groupBy("text").agg(one).select("one.key", "text", "one.label")
    return stage(joined, "labelled-texts"), counts


def _least(known: DataFrame, label: int, count: int, most: int) -> DataFrame:
    """``key, label, place`` of the ``most`` rows of the class with the least places, which are spread over 63 bits."""
    own = known.where(F.col("label") == label)
    if count <= most:
        return own
    share = (most + 8 * math.sqrt(most) + 64) / count
    near = own.where(F.col("place") < min(int(share * 2**63), 2**63 - 1))
    return near.orderBy("place", "key").limit(most)
