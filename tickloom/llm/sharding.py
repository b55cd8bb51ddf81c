"""Shards by jump consistent hashing, with gapless places in every shard.

The shard of a row depends on its key and the number of shards alone; no ring or
table is kept.  With one more shard, the rows that move all move into it, and
they are the fraction that an even split needs.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.series import number_rows
from tickloom.sources.staging import stage

SHARDS = 16

# Fixed values of the published algorithm.
MULTIPLIER = np.uint64(2862933555777941757)
KEPT_BITS = np.uint64(33)
SCALE = float(1 << 31)


def jump_hash(keys: np.ndarray, shards: int) -> np.ndarray:
    """Shard of every 64-bit key."""
    if shards < 1:
        raise ValueError("at least one shard")
    state = keys.astype(np.int64).view(np.uint64).copy()
    shard, following = np.zeros(len(state), np.int64), np.zeros(len(state), np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = following[moving]
        state[moving] = state[moving] * MULTIPLIER + np.uint64(1)
        following[moving] = ((shard[moving] + 1) * (SCALE / ((state[moving] >> KEPT_BITS) + 1).astype(float))).astype(np.int64)
        moving = moving[following[moving] < shards]
    return shard


def shard_of(key: Column, shards: int) -> Column:
    @F.pandas_udf("int")
    def shard(keys: pd.Series) -> pd.Series:
        return pd.Series(jump_hash(keys.to_numpy(np.int64), shards).astype(np.int32))

    return shard(key)


def _hash_key(docs: DataFrame, key: str) -> Column:
    whole = isinstance(docs.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    return F.coalesce(F.col(key).cast("long") if whole else F.xxhash64(key), F.lit(0))


def assign_shards(docs: DataFrame, shards: int = SHARDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, size, text_crc32, law, shard, slot, grown_shard`` of every row; other columns are left out.

    ``size`` is the text's bytes and one for its separator; a null text is empty.  A null key goes where key 0 goes.
    ``slot`` numbers a shard's rows in the order of a hash of the key, then of key and text, so it doesn't depend on
    how the table is stored.  Numbering takes sorted ranges of about equal size, whose counts give each range its first
    slot, so the rows of one key may fill many of them.
    """
    filled = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(
        F.col(key).alias("key"),
        _hash_key(docs, key).alias("hashed"),
        (F.octet_length(filled) + 1).cast("long").alias("size"),
        F.crc32(filled.cast("binary")).alias("text_crc32"),
        F.conv(F.substring(F.md5(F.coalesce(F.col(key).cast("string"), F.lit(""))), 1, 15), 16, 10).cast("long").alias("spot"),
    )
    placed = stage(
        rows.withColumn("shard", shard_of(F.col("hashed"), shards))
        .withColumn("grown_shard", shard_of(F.col("hashed"), shards + 1))
        .drop("hashed"),
        "shards",
    )
    # Equal rows may take each other's slots; all else goes by the row.
    numbered = number_rows(placed.withColumn("keyless", F.col("key").isNull()), ["shard"], ["spot", "keyless", "key", "text_crc32", "size"], "n")
    return numbered.select(
        F.col("key").alias(key),
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        (F.col("n") - 1).alias("slot"),
        "grown_shard",
    )
