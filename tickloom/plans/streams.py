"""Streaming queries (S1, T1-T9) run to the end of the given files.

Each reads the tables as a stream, writes to the shared folder through a real
sink, and returns what was written.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions.times import span_micros
from tickloom.operators import normalize as N
from tickloom.operators import quality as Q
from tickloom.plans import ingest as P
from tickloom.plans import views as V
from tickloom.plans.market import OHLCV, rollup_sql
from tickloom.plans.registry import query, r
from tickloom.schemas import QUALITY_DIMENSIONS
from tickloom.sources import decode, readers
from tickloom.sources.staging import fresh_path
from tickloom.streaming import jobs as J


def _event_stream(spark: SparkSession, folder: str) -> DataFrame:
    schema = V.table(spark, folder, "events").schema
    return readers.table_stream(spark, folder, "events", schema)


def _tick_stream(spark: SparkSession, folder: str) -> DataFrame:
    return V.ticks_of(_event_stream(spark, folder))


def _collected(spark: SparkSession, stream: DataFrame, label: str) -> DataFrame:
    """Runs an append stream into files and reads them back."""
    path = fresh_path(spark, label)
    J.to_files(stream, path, f"{path}-checkpoint", every=None).awaitTermination()
    return spark.read.schema(stream.schema).parquet(path)


def _each_batch(spark: SparkSession, stream: DataFrame, label: str, sink, mode: str) -> str:
    path = fresh_path(spark, label)
    J.start(stream, f"{path}-checkpoint", sink(path), mode, every=None).awaitTermination()
    return path


def message_stream(spark: SparkSession, folder: str, files: int | None = None) -> DataFrame:
    """The messages written as files and read as a stream of them, ``files`` of them in a micro-batch."""
    path = fresh_path(spark, "messages")
    rows = V.messages(spark, folder)
    (rows.repartition(4, "key") if files else rows).write.parquet(path)
    return readers.message_stream(spark, "parquet", path=path, per_trigger=files)


@query(
    "S1_message_source",
    f"""WITH {V.MESSAGES_SQL} SELECT trade_id AS key, topic, m = 7 AS is_empty FROM wire""",
)
def s1(spark: SparkSession, folder: str) -> DataFrame:
    decoded = decode.decode_messages(message_stream(spark, folder))
    return _collected(spark, decoded.select("key", "topic", (F.col("text") == "{}").alias("is_empty")), "decoded")


# Emitted: candles whose end the watermark, one minute behind the last trade, has passed.
_FINAL = f"""WITH {V.C1M_SQL}, mark AS (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 1 MINUTE AS closed_at FROM ticks)"""


@query(
    "T1_candle_stream",
    f"""{_FINAL} SELECT symbol, open_time, {OHLCV}, open_time + INTERVAL 1 MINUTE AS close_time, trades_count
FROM c1m, mark WHERE open_time + INTERVAL 1 MINUTE <= closed_at""",
)
def t1(spark: SparkSession, folder: str) -> DataFrame:
    return _collected(spark, J.candle_rows(J.candle_stream(_tick_stream(spark, folder))), "stream-1m")


@query(
    "T2_corrected_candles",
    f"""WITH {V.C1M_SQL} SELECT symbol, open_time, {r("open")} AS open, {r("close")} AS close, {r("volume")} AS volume, trades_count FROM c1m""",
)
def t2(spark: SparkSession, folder: str) -> DataFrame:
    """Update mode: candles are corrected in the keyed table as trades arrive."""
    candles = J.candle_rows(J.candle_stream(_tick_stream(spark, folder)))
    path = _each_batch(spark, candles, "stream-upsert", J.to_candles, "update")
    return spark.read.parquet(path).select("symbol", "open_time", "open", "close", "volume", "trades_count")


@query(
    "T3_latest_price",
    f"""WITH {V.TICKS_SQL} SELECT symbol, {r('arg_max(price, "timestamp")')} AS price, max("timestamp") AS price_time FROM ticks GROUP BY symbol""",
)
def t3(spark: SparkSession, folder: str) -> DataFrame:
    latest = J.latest_price_stream(_tick_stream(spark, folder))
    path = _each_batch(spark, latest, "stream-latest", J.to_latest, "update")
    return spark.read.parquet(path).select("symbol", "price", "price_time")


_WALK = f"""WITH RECURSIVE {V.TICKS_SQL}, seq AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id) AS k FROM ticks), walk AS (
  SELECT symbol, k, trade_id, [price] AS recent, true AS accepted FROM seq WHERE k = 1
  UNION ALL
  SELECT symbol, k, trade_id, CASE WHEN ok THEN list_slice(list_append(recent, price), -100, -1) ELSE recent END, ok
  FROM (SELECT s.symbol, s.k, s.trade_id, s.price, w.recent,
               len(w.recent) < 10 OR NOT (list_avg(w.recent) > 0 AND abs(s.price - list_avg(w.recent)) / list_avg(w.recent) > 0.5) AS ok
        FROM walk w JOIN seq s ON s.symbol = w.symbol AND s.k = w.k + 1))"""


@query("T4_accuracy_gate", f"{_WALK} SELECT symbol, trade_id, accepted FROM walk")
def t4(spark: SparkSession, folder: str) -> DataFrame:
    gated = _collected(spark, J.accuracy_stream(_tick_stream(spark, folder)), "stream-gate")
    return gated.select("symbol", "trade_id", "accepted")


_PARTS, _LATENESS = 5, "1 day"


def _arriving(trades: DataFrame, key: str) -> tuple[str, list[DataFrame]]:
    """A folder, and the trades in parts by their arrival, up to ``_LATENESS`` after their time."""
    delay = F.pmod(F.xxhash64(key), F.lit(span_micros(_LATENESS)))
    late = trades.withColumn("_arrival", F.unix_micros("timestamp") + delay)
    first, last = late.agg(F.min("_arrival"), F.max("_arrival")).first()
    step = ((last or 0) - (first or 0)) // _PARTS + 1
    part = F.floor((F.col("_arrival") - F.lit(first or 0)) / F.lit(step))
    return fresh_path(trades.sparkSession, "arriving"), [late.where(part == i).drop("_arrival") for i in range(_PARTS)]


def _in_parts(parts: tuple[str, list[DataFrame]], run) -> None:
    """Runs a stream once after each part arrived, so a part is a micro-batch whatever its files, and each run goes on
    from the checkpoint of the one before."""
    path, rows = parts
    for i, part in enumerate(rows):
        part.write.parquet(f"{path}/{i:03d}")
        run(part.sparkSession.readStream.schema(part.schema).parquet(f"{path}/*")).awaitTermination()


def _released(verdicts: str) -> str:
    """Of ``symbol, trade_id, accepted`` those that the watermark has reached at the end."""
    return f"""SELECT w.symbol, w.trade_id, w.accepted FROM ({verdicts}) w JOIN ticks t USING (trade_id)
WHERE t."timestamp" <= (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 1 DAY FROM ticks)"""


@query("T4_event_time_gate", f"{_WALK} {_released('SELECT symbol, trade_id, accepted FROM walk')}")
def t4_event_time(spark: SparkSession, folder: str) -> DataFrame:
    """The verdicts of one pass in order of time, from parts whose trades come up to a day late."""
    out = fresh_path(spark, "stream-gate")
    parts = _arriving(V.ticks(spark, folder), "trade_id")
    _in_parts(parts, lambda stream: J.to_files(J.accuracy_stream(stream, _LATENESS), out, f"{out}-checkpoint", every=None))
    gated = spark.read.schema("symbol string, trade_id string, accepted boolean").parquet(out)
    return gated.select("symbol", "trade_id", "accepted")


@query(
    "T5_bronze_batches",
    f"""{P._NORMAL_SQL} SELECT symbol, side, source, strftime("timestamp", '%Y-%m-%d') AS date_partition, count(*) AS trades,
       {r("sum(price)")} AS price, {r("sum(volume)")} AS volume FROM normal GROUP BY ALL""",
)
def t5(spark: SparkSession, folder: str) -> DataFrame:
    """Messages to the lake: decode, normalise, append in micro-batches."""
    decoded = decode.decode_messages(message_stream(spark, folder))
    rows = N.normalise(decoded, P.processed_at())
    path = _each_batch(spark, rows, "stream-bronze", J.to_bronze, "append")
    return (
        readers.read_bronze(spark, path)
        .groupBy("symbol", "side", "source", "date_partition")
        .agg(F.count(F.lit(1)).alias("trades"), F.sum("price").alias("price"), F.sum("volume").alias("volume"))
    )


@query(
    "T6_quality_counters",
    f"""{P.CHECKED_SQL}, f AS (SELECT CASE WHEN NOT q1 THEN 'completeness' WHEN NOT q2 THEN 'validity' WHEN NOT q3 THEN 'consistency'
                 WHEN NOT q4 THEN 'timeliness' END AS failed FROM checked)
SELECT count(*) AS all_records, count(*) FILTER (WHERE failed = 'completeness') AS failed_completeness,
       count(*) FILTER (WHERE failed = 'validity') AS failed_validity, count(*) FILTER (WHERE failed = 'consistency') AS failed_consistency,
       count(*) FILTER (WHERE failed = 'timeliness') AS failed_timeliness FROM f""",
)
def t6(spark: SparkSession, folder: str) -> DataFrame:
    """Per-batch reports of the stateless dimensions, summed over the batches."""
    judged = V.gate_input_of(_tick_stream(spark, folder)).withColumn(Q.FAILED, Q.row_failure(F.col("as_of")))
    path = _each_batch(spark, J.observed(judged), "stream-quality", J.to_reports, "append")
    counters = ["all_records", "failed_completeness", "failed_validity", "failed_consistency", "failed_timeliness"]
    return spark.read.parquet(path).agg(*[F.sum(c).alias(c) for c in counters])


@query(
    "T6_all_dimensions",
    f"""{P.JUDGED_SQL}, row_passed AS (SELECT j.event_id, g."timestamp" AS seen_at, j.failed_dimension AS failed,
    coalesce(j.failed_dimension, 'accuracy') = 'accuracy' AS passed FROM judged j JOIN gate_input g USING (event_id)),
mark AS (SELECT date_trunc('milliseconds', max(seen_at)) - INTERVAL 1 DAY AS closed_at FROM row_passed WHERE passed)
SELECT (SELECT count(*) FROM gate_input) AS input_rows, 0 AS late_rows, count(*) AS all_records,
       {", ".join(f"count(*) FILTER (WHERE failed = '{d}') AS failed_{d}" for d in QUALITY_DIMENSIONS)}
FROM row_passed, mark WHERE NOT passed OR seen_at <= closed_at""",
)
def t6_all(spark: SparkSession, folder: str) -> DataFrame:
    """The counters that the listener kept of every micro-batch of the whole gate, summed; trades come up to a day late."""
    out, log = fresh_path(spark, "stream-judged"), fresh_path(spark, "stream-counters")
    counters = J.CounterLog(spark, log)

    def run(stream: DataFrame):
        judged = stream.withColumn(Q.FAILED, Q.row_failure(F.col("as_of")))
        return J.to_files(J.observed(J.gate_stream(judged, _LATENESS)), out, f"{out}-checkpoint", every=None)

    spark.streams.addListener(counters)
    try:
        _in_parts(_arriving(V.gate_input(spark, folder), "event_id"), run)
        counters.wait()
    finally:
        spark.streams.removeListener(counters)
    names = ["input_rows", "late_rows", "all_records", *[f"failed_{d}" for d in QUALITY_DIMENSIONS]]
    return spark.read.parquet(log).agg(*[F.sum(c).alias(c) for c in names])


@query(
    "T7_deduplicated",
    f"""WITH {V.TICKS_SQL} SELECT symbol, count(*) AS trades, {r("sum(volume)")} AS volume FROM ticks GROUP BY symbol""",
)
def t7(spark: SparkSession, folder: str) -> DataFrame:
    """Every trade delivered twice, once kept."""
    twice = _tick_stream(spark, folder).withColumn("_copy", F.explode(F.array(F.lit(1), F.lit(2)))).drop("_copy")
    kept = _collected(spark, J.deduplicated(twice), "stream-dedup")
    return kept.groupBy("symbol").agg(F.count(F.lit(1)).alias("trades"), F.sum("volume").alias("volume"))


@query(
    "T7_replayed_batch",
    f"""{P._NORMAL_SQL} SELECT symbol, side, source, strftime("timestamp", '%Y-%m-%d') AS date_partition, count(*) AS trades,
       {r("sum(price)")} AS price, {r("sum(volume)")} AS volume FROM normal GROUP BY ALL""",
)
def t7_replayed(spark: SparkSession, folder: str) -> DataFrame:
    """T5 with every micro-batch written twice, as after a failure between the write and the commit."""
    rows = N.normalise(decode.decode_messages(message_stream(spark, folder, files=1)), P.processed_at())

    def twice(path: str):
        write = J.to_bronze(path)
        return lambda batch, number: (write(batch, number), write(batch, number))

    path = _each_batch(spark, rows, "stream-replayed", twice, "append")
    return (
        readers.read_bronze(spark, path)
        .groupBy("symbol", "side", "source", "date_partition")
        .agg(F.count(F.lit(1)).alias("trades"), F.sum("price").alias("price"), F.sum("volume").alias("volume"))
    )


def _bar_updates(trades: DataFrame) -> DataFrame:
    """An update per trade of its hourly bar; every eighth trade closes the bar."""
    number = F.col("trade_id").cast("long")
    hour = F.unix_timestamp(F.date_trunc("hour", F.col("timestamp")))
    price = F.col("price")
    return trades.select(
        "symbol", F.lit("1h").alias("interval"), hour.alias("time"), price.alias("open"), (price + 1).alias("high"),
        (price - 1).alias("low"), price.alias("close"), (number % 8 == 0).alias("is_final"), number.alias("arrival"),
    )


_BARS = f"""WITH {V.TICKS_SQL}, u AS (SELECT symbol, CAST(epoch({V.HOUR}) AS BIGINT) AS time, price, event_id % 8 = 0 AS fin, event_id FROM ticks)
SELECT symbol, '1h' AS interval, time, {r("arg_max(price, ROW(fin, event_id))")} AS close, bool_or(fin) AS is_final FROM u"""


@query("T8_bar_updates", f"{_BARS} GROUP BY symbol, time")
def t8(spark: SparkSession, folder: str) -> DataFrame:
    bars = J.latest_klines(_bar_updates(V.ticks(spark, folder)))
    return bars.select("symbol", "interval", "time", "close", "is_final")


@query("T8_bar_stream", f"{_BARS} GROUP BY symbol, time")
def t8_stream(spark: SparkSession, folder: str) -> DataFrame:
    bars = J.latest_klines(_bar_updates(_tick_stream(spark, folder)))

    def sink(path: str):
        return lambda batch, number: batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    path = _each_batch(spark, bars, "stream-bars", sink, "update")
    # The last state of a bar is the one of its latest batch.
    states = spark.read.parquet(path).groupBy("symbol", "interval", "time").agg(
        F.max_by(F.struct("close", "is_final"), "batch").alias("bar")
    )
    return states.select("symbol", "interval", "time", "bar.*")


@query(
    "T9_chained_rollup",
    f"""{_FINAL}, c AS (SELECT c1m.* FROM c1m, mark WHERE open_time + INTERVAL 1 MINUTE <= closed_at), {rollup_sql(60, "c")}
SELECT symbol, open_time, {OHLCV}, trades_count, candles_count FROM rolled, mark WHERE open_time + INTERVAL 1 HOUR <= closed_at""",
)
def t9(spark: SparkSession, folder: str) -> DataFrame:
    minutes = J.candle_stream(_tick_stream(spark, folder))
    rows = J.rollup_stream(minutes, "1 hour").select(
        "symbol", F.col("window")["start"].alias("open_time"), "open", "high", "low", "close", "volume", "trades_count",
        "candles_count",
    )
    return _collected(spark, rows, "stream-1h")
