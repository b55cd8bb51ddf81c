"""Batch and streaming inputs (S1) and the pruned lake reader."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.schemas import BRONZE_TRADE

MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
    ]
)


def message_stream(
    spark: SparkSession,
    source: str = "kafka",
    *,
    topics: list[str] | None = None,
    servers: str | None = None,
    path: str | None = None,
    per_trigger: int | None = None,
    options: dict | None = None,
) -> DataFrame:
    """Messages with key, value and topic.

    ``kafka`` needs the connector on the cluster and starts at the latest
    offsets; any other source is a file format holding the same three columns.
    ``per_trigger`` bounds a micro-batch, in offsets or files.
    """
    reader = spark.readStream.format(source)
    if source == "kafka":
        reader = reader.options(
            **{"kafka.bootstrap.servers": servers, "subscribe": ",".join(topics or []), "startingOffsets": "latest"}
        )
        if per_trigger:
            reader = reader.option("maxOffsetsPerTrigger", per_trigger)
        return reader.options(**(options or {})).load().select("key", "value", "topic")
    reader = reader.schema(MESSAGE)
    if per_trigger:
        reader = reader.option("maxFilesPerTrigger", per_trigger)
    stream = reader.options(**(options or {})).load(path)
    return stream.filter(F.col("topic").isin(topics)) if topics else stream


def table_stream(
    spark: SparkSession, folder: str, name: str, schema: T.StructType, files_per_trigger: int | None = None
) -> DataFrame:
    """One Parquet table of a folder as a stream of its files."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def read_bronze(spark: SparkSession, path: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Bronze trades with start <= timestamp < end.

    The time range is repeated on the partition column, so whole days are pruned.
    """
    trades = spark.read.schema(BRONZE_TRADE).parquet(path)
    stamp, day = F.col("timestamp"), F.col("date_partition")
    if start is not None:
        at = F.lit(start).cast("timestamp_ntz")
        trades = trades.filter((stamp >= at) & (day >= at.cast("date")))
    if end is not None:
        at = F.lit(end).cast("timestamp_ntz")
        trades = trades.filter((stamp < at) & (day <= at.cast("date")))
    return trades
