"""Messages to the lake, the price table and the candle table, continuously."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickloom.functions import checks
from tickloom.operators import quality as Q
from tickloom.operators.candles import latest_price
from tickloom.operators.normalize import normalise
from tickloom.schemas import BRONZE_TRADE
from tickloom.sources import sinks
from tickloom.sources.decode import decode_messages
from tickloom.streaming import jobs


@dataclass(frozen=True)
class Tables:
    """Folders of the tables an ingest keeps."""

    bronze: str
    rejects: str
    latest: str
    candles: str


def judged_trades(
    messages: DataFrame, as_of: Column | None = None, processing_time: Column | None = None, lateness: str | None = None
) -> DataFrame:
    """S2, P3 and the whole gate: every trade with its first failed dimension.

    The records are normalised before they are judged, so both wire formats can
    pass; completeness looks at the canonical columns.
    """
    now = F.current_timestamp() if as_of is None else as_of
    trades = normalise(decode_messages(messages), processing_time)
    return jobs.gate_stream(trades.withColumn(Q.FAILED, Q.row_failure(now, checks.complete())), lateness)


def store_batch(tables: Tables) -> Callable[[DataFrame, int], None]:
    """Splits a judged batch into the lake, the rejects and the price table, each of which has it once."""

    def write(batch: DataFrame, number: int) -> None:
        named = jobs.batch_name(batch, number)
        batch.persist()
        try:
            good = Q.accepted(batch)
            sinks.write_bronze(good, tables.bronze, batch=named)
            sinks.publish_latest(latest_price(good), tables.latest)
            rejects = Q.rejected(batch).write.partitionBy(Q.FAILED)
            sinks.append_once(batch.sparkSession, rejects, tables.rejects, Q.FAILED, *named)
        finally:
            batch.unpersist()

    return write


def start_storage(
    messages: DataFrame,
    tables: Tables,
    checkpoint: str,
    every: str | None = jobs.BATCH_EVERY,
    as_of: Column | None = None,
    processing_time: Column | None = None,
    lateness: str | None = None,
) -> StreamingQuery:
    """Messages to the lake, the rejects and the latest prices.

    A micro-batch is in the lake and the rejects once, also when it is written again
    after a failure; the prices are a keyed upsert and come out the same.  With
    ``lateness`` accuracy is judged in event time (``jobs.gate_stream``) and accepted
    trades reach the lake that much later.
    """
    judged = jobs.observed(judged_trades(messages, as_of, processing_time, lateness))
    return jobs.start(judged, checkpoint, store_batch(tables), every=every)


def start_candles(
    spark: SparkSession, tables: Tables, checkpoint: str, every: str | None = jobs.FLUSH_EVERY
) -> StreamingQuery:
    """Accepted trades, as the lake gets them, to the candle table.

    Candles are corrected while they are open and left alone once the watermark
    has passed them.
    """
    accepted = spark.readStream.schema(BRONZE_TRADE).parquet(tables.bronze)
    candles = jobs.candle_rows(jobs.candle_stream(accepted))
    return jobs.start(candles, checkpoint, jobs.to_candles(tables.candles), "update", every=every)
