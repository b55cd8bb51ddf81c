"""Outputs: bronze append, batches written once, keyed upserts, month partitions, event envelopes."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.ledger import upsert_latest
from tickloom.operators.normalize import CANONICAL
from tickloom.sources.staging import staged

#: Folders of the table of latest prices.
PRICE_BUCKETS = 8


def bronze_rows(trades: DataFrame) -> DataFrame:
    """S3: the nine lake columns, times without zone."""
    naive = {name: F.col(name).cast("timestamp_ntz") for name in ("timestamp", "processing_time")}
    return trades.select(*CANONICAL).withColumns(naive)


def write_bronze(trades: DataFrame, path: str, spread: bool = True, batch: tuple[str, int] | None = None) -> None:
    """S3/O3: appends to the day-partitioned lake table, sorted by time, symbol, side.

    ``spread`` first gathers the rows of a day, so a micro-batch adds one file to
    each day it touches; adaptive execution splits a day again where it is larger
    than the advisory partition size.  ``batch`` names the writer and the number of
    the micro-batch, which is then in the table once however often it is written.
    """
    rows = bronze_rows(trades)
    order = ["date_partition", "timestamp", "symbol", "side"]
    rows = rows.hint("rebalance", "date_partition") if spread else rows
    writer = rows.sortWithinPartitions(*order).write.partitionBy("date_partition").option("compression", "zstd")
    if batch is None:
        writer.mode("append").parquet(path)
    else:
        append_once(rows.sparkSession, writer, path, "date_partition", *batch)


def append_once(spark: SparkSession, writer: DataFrameWriter, path: str, partition: str, source: str, number: int) -> None:
    """Appends a micro-batch to a Parquet table with one partition column, exactly once.

    The files carry the names of their source and batch.  A marker is set before the
    write and another after it: a batch that is marked as done is not written again,
    and one that was only begun first loses the files of the attempt that broke off.
    A source writes its batches one after the other, as a streaming query does, so
    the markers of the batch before are no longer needed.
    """
    def place(name: str):
        return spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{name}")

    name = f"batch-{source}-{number}"
    # Spark's readers pass over names that begin with an underscore.
    begun, done = (place(f"_batches/{name}.{state}") for state in ("begun", "done"))
    files = begun.getFileSystem(spark._jsc.hadoopConfiguration())
    if files.exists(done):
        return
    if files.exists(begun):
        for left in files.globStatus(place(f"{partition}=*/{name}-*")) or []:
            files.delete(left.getPath(), False)
    else:
        files.create(begun, True).close()
    writer.mode("append").option("mapreduce.output.basename", name).parquet(path)
    files.create(done, True).close()
    for state in ("begun", "done"):
        files.delete(place(f"_batches/batch-{source}-{number - 1}.{state}"), False)


def _stored(spark: SparkSession, path: str, like: DataFrame) -> DataFrame | None:
    """The table at ``path``, or None before the first write."""
    try:
        return spark.read.schema(like.schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def upsert_table(batch: DataFrame, path: str, keys: list[str], version: list[str], partition: str) -> None:
    """Keyed upsert into a Parquet table partitioned by ``partition``.

    Only the partitions the batch touches are read and replaced.  Per key the
    highest version wins, so a repeated batch changes nothing.  The merged rows
    are staged first: the table is never read while it is being replaced.
    """
    spark = batch.sparkSession
    # Read twice below: for the partitions it touches and for its rows.
    with staged(batch, "upsert-batch") as rows:
        stored = _stored(spark, path, rows)
        current = rows.limit(0)
        if stored is not None:
            touched = rows.select(partition).distinct()
            current = stored.join(touched, partition, "left_semi").select(*rows.columns)
        with staged(upsert_latest(current, rows, keys, version), "upsert-merged") as merged:
            merged.hint("rebalance", partition).write.partitionBy(partition).mode("overwrite").option(
                "partitionOverwriteMode", "dynamic"
            ).parquet(path)


def upsert_candles(candles: DataFrame, path: str) -> None:
    """1-minute candles by (symbol, open_time).

    A candle with fewer trades never replaces one with more: a partial candle
    from late trades loses against the full one.
    """
    dated = candles.withColumn("open_date", F.to_date("open_time"))
    upsert_table(dated, path, ["symbol", "open_time"], ["trades_count", "volume"], "open_date")


def publish_latest(prices: DataFrame, path: str) -> None:
    """Latest price and time per symbol, last trade time wins, in a few folders by a hash of the symbol."""
    rows = prices.select("symbol", "price", "price_time")
    spread = rows.withColumn("bucket", F.pmod(F.xxhash64("symbol"), F.lit(PRICE_BUCKETS)).cast("int"))
    upsert_table(spread, path, ["symbol"], ["price_time", "price"], "bucket")


def with_month(rows: DataFrame, stamp: str) -> DataFrame:
    return rows.withColumn("month", F.date_format(F.col(stamp), "yyyy-MM"))


def write_months(rows: DataFrame, path: str, stamp: str) -> None:
    """Appends to a month-partitioned table; months need no declaration."""
    with_month(rows, stamp).hint("rebalance", "month").write.partitionBy("month").mode("append").parquet(path)


def event_messages(
    events: DataFrame, service: str = "unknown", now: Column | None = None, payload: list[str] | None = None
) -> DataFrame:
    """Events as messages with key, value and headers.

    ``events`` has type and any of aggregateId, userId, id, timestamp and
    correlationId; all its columns go into the value.
    """
    now = F.current_timestamp() if now is None else now
    columns = events.columns
    ids = [F.col(c).cast("string") for c in ("aggregateId", "userId", "id") if c in columns]
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"
    times = [F.col("timestamp").cast("string")] if "timestamp" in columns else []
    stamp = F.coalesce(*times, F.date_format(now, iso))
    body = [F.col(c) for c in (payload or columns) if c not in ("timestamp", "service")]
    correlation = F.col("correlationId") if "correlationId" in columns else F.lit(None).cast("string")
    headers = F.array(
        F.struct(F.lit("event-type").alias("key"), F.col("type").alias("value")),
        F.struct(F.lit("correlation-id").alias("key"), F.coalesce(correlation, F.uuid()).alias("value")),
    )
    return events.select(
        F.coalesce(*ids).alias("key"),
        F.to_json(F.struct(*body, stamp.alias("timestamp"), F.lit(service).alias("service"))).alias("value"),
        headers.alias("headers"),
    )


def create_lake_table(spark: SparkSession, name: str, location: str, table_format: str = "parquet") -> DataFrame:
    """The seven-column trade table, in the given format."""
    spark.sql(
        f"""CREATE TABLE IF NOT EXISTS {name} (
            symbol STRING, timestamp TIMESTAMP, price DOUBLE, volume DOUBLE,
            side STRING, trade_id STRING, source STRING
        ) USING {table_format} LOCATION '{location}'"""
    )
    return spark.table(name)
