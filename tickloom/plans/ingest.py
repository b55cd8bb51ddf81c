"""Queries over wire messages and the quality gate: S2-S9, P1-P9, Q1-Q8."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import checks
from tickloom.functions.params import valid_symbol
from tickloom.functions.times import minute_floor
from tickloom.operators import candles as C
from tickloom.operators import normalize as N
from tickloom.operators import quality as Q
from tickloom.plans import views as V
from tickloom.plans.registry import query, r
from tickloom.sources import decode, readers, sinks
from tickloom.sources.staging import fresh_path


def decoded(spark: SparkSession, folder: str) -> DataFrame:
    return decode.decode_messages(V.messages(spark, folder))


def processed_at():
    return F.lit(V.PROCESSED_AT).cast("timestamp")


# --- decoding and normalising --------------------------------------------------------------

# Raw records: m in (0, 1, 9, 10); an empty message: m = 7; the others are canonical.
_PRICE_TEXT = "CASE WHEN m = 4 THEN 'n/a' WHEN m NOT IN (0, 1, 7, 9, 10) THEN CAST(price AS VARCHAR) END"


@query(
    "S2_decode",
    f"""WITH {V.MESSAGES_SQL}
SELECT trade_id AS key, topic, CASE WHEN m NOT IN (0, 1, 2, 7, 9, 10) THEN symbol END AS symbol,
       CASE WHEN m NOT IN (0, 1, 7, 9, 10) THEN side END AS side,
       CASE WHEN m NOT IN (0, 1, 6, 7, 9, 10) THEN trade_id END AS trade_id,
       CASE WHEN m = 9 THEN 'Hold' WHEN m IN (0, 1, 10) THEN upper(side[1]) || side[2:] END AS raw_side,
       CASE WHEN m IN (0, 9, 10) THEN trade_id END AS raw_id, m = 7 AS is_empty
FROM wire""",
)
def s2(spark: SparkSession, folder: str) -> DataFrame:
    rec = F.col("record")
    return decoded(spark, folder).select(
        "key", "topic", rec["symbol"].alias("symbol"), rec["side"].alias("side"), rec["trade_id"].alias("trade_id"),
        rec["S"].alias("raw_side"), rec["i"].alias("raw_id"), (F.col("text") == "{}").alias("is_empty"),
    )


@query(
    "P1_raw_check",
    f"""WITH {V.MESSAGES_SQL} SELECT trade_id AS key, m IN (0, 1) AS is_valid FROM wire""",
)
def p1(spark: SparkSession, folder: str) -> DataFrame:
    return decoded(spark, folder).select("key", checks.raw_trade_ok().alias("is_valid"))


@query(
    "P2_canonical_from_raw",
    f"""WITH {V.MESSAGES_SQL}
SELECT 'BTCUSDT' AS symbol, ms AS "timestamp", {r("price")} AS price, {r("volume")} AS volume, side,
       CASE WHEN m = 0 THEN trade_id ELSE CAST(epoch_ms(ms) AS VARCHAR) END AS trade_id, 'bybit' AS source,
       TIMESTAMP '{V.PROCESSED_AT}' AS processing_time, strftime(ms, '%Y-%m-%d') AS date_partition
FROM wire WHERE m IN (0, 1)""",
)
def p2(spark: SparkSession, folder: str) -> DataFrame:
    return N.canonical_from_raw(decoded(spark, folder), processing_time=processed_at())


@query("P2_raw_rejects", f"""WITH {V.MESSAGES_SQL} SELECT trade_id AS key, topic FROM wire WHERE m NOT IN (0, 1)""")
def p2_rejects(spark: SparkSession, folder: str) -> DataFrame:
    return N.raw_rejects(decoded(spark, folder)).select("key", "topic")


_NORMAL_SQL = f"""WITH {V.MESSAGES_SQL}, normal AS (
  SELECT event_id, CASE WHEN m IN (1, 2) THEN 'BTCUSDT' ELSE symbol END AS symbol,
         CASE WHEN m IN (7, 10) THEN TIMESTAMP '{V.PROCESSED_AT}' WHEN m IN (0, 1, 5, 9) THEN ms ELSE "timestamp" END AS "timestamp",
         CASE WHEN m = 4 THEN NULL WHEN m = 7 THEN 0.0 ELSE price END AS price,
         CASE WHEN m = 7 THEN 0.0 ELSE volume END AS volume,
         CASE m WHEN 7 THEN 'unknown' WHEN 9 THEN 'hold' ELSE side END AS side,
         CASE WHEN m IN (1, 6, 7) THEN '' ELSE trade_id END AS trade_id,
         CASE WHEN m IN (0, 1, 3, 7, 9, 10) THEN 'bybit' ELSE source END AS source
  FROM wire)"""


@query(
    "P3_normalise",
    f"""{_NORMAL_SQL} SELECT symbol, "timestamp", {r("price")} AS price, {r("volume")} AS volume, side, trade_id, source,
       TIMESTAMP '{V.PROCESSED_AT}' AS processing_time, strftime("timestamp", '%Y-%m-%d') AS date_partition FROM normal""",
)
def p3(spark: SparkSession, folder: str) -> DataFrame:
    return N.normalise(decoded(spark, folder), processed_at())


@query(
    "P4_topic_symbol",
    f"""WITH {V.MESSAGES_SQL} SELECT topic, CASE WHEN contains(topic, '-') THEN upper(split_part(topic, '-', 1)) ELSE 'BTCUSDT' END AS symbol,
       count(*) AS messages FROM wire GROUP BY ALL""",
)
def p4(spark: SparkSession, folder: str) -> DataFrame:
    topics = V.messages(spark, folder).groupBy("topic").agg(F.count(F.lit(1)).alias("messages"))
    return topics.withColumn("symbol", N.topic_symbol("topic"))


@query(
    "P5_message_key",
    f"""{_NORMAL_SQL} SELECT event_id, trade_id <> '' AS keyed_by_id, true AS is_key FROM normal""",
)
def p5(spark: SparkSession, folder: str) -> DataFrame:
    """The hash of a time has no counterpart in SQL; its range has."""
    rows = N.normalise(decoded(spark, folder).withColumn("event_id", F.col("key").cast("long")), processed_at())
    by_id = F.col("message_key") == F.col("trade_id")
    in_range = F.col("message_key").try_cast("long").between(0, 999)
    return rows.withColumn("message_key", N.message_key()).select(
        "event_id", by_id.alias("keyed_by_id"), (by_id | in_range).alias("is_key")
    )


@query(
    "P6_symbol_filter",
    """SELECT p_partkey AS id, p_brand AS symbol, false AS is_valid FROM part
UNION ALL SELECT s_suppkey, upper(replace(s_name, '#', '')), length(replace(s_name, '#', '')) BETWEEN 2 AND 20 FROM supplier""",
)
def p6(spark: SparkSession, folder: str) -> DataFrame:
    parts = V.table(spark, folder, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("symbol"))
    names = V.table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("id"), F.upper(F.replace("s_name", F.lit("#"), F.lit(""))).alias("symbol")
    )
    return parts.unionByName(names).withColumn("is_valid", valid_symbol(F.col("symbol")))


@query(
    "P8_generated_columns",
    f"""WITH {V.TRADES_SQL}
SELECT id, external_trade_id, {r("price * quantity", 2)} AS notional,
       {r("CASE WHEN fee_asset_id IS NOT NULL THEN fee_amount END", 4)} AS fee_notional FROM trades_v""",
)
def p8(spark: SparkSession, folder: str) -> DataFrame:
    rows = N.generated_columns(V.trades(spark, folder))
    return rows.select(
        "id", "external_trade_id", F.round(F.col("notional").cast("double"), 2).alias("notional"),
        F.round(F.col("fee_notional").cast("double"), 4).alias("fee_notional"),
    )


@query(
    "P9_minute_floor",
    f"""WITH {V.TICKS_SQL} SELECT trade_id, {V.MINUTE} AS minute FROM ticks""",
)
def p9(spark: SparkSession, folder: str) -> DataFrame:
    return V.ticks(spark, folder).select("trade_id", minute_floor("timestamp").alias("minute"))


# --- klines ---------------------------------------------------------------------------------

_HOURLY_KLINE = f"{V.C1H_SQL}, k AS (SELECT *, epoch_ms(open_time) AS ms FROM c1h)"


def kline_responses(spark: SparkSession, folder: str) -> DataFrame:
    """One response per symbol and day: a JSON array of positional klines."""
    hours = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    row = F.to_json(
        F.array(
            F.unix_millis("open_time").cast("string"),
            *[F.col(c).cast("string") for c in ("open", "high", "low", "close", "volume")],
        )
    )
    # Numbers arrive bare for the time and quoted for the prices.
    bare = F.regexp_replace(row, r'^\["(\d+)"', r"[$1")
    grouped = hours.groupBy("symbol", F.to_date("open_time").alias("day")).agg(F.collect_list(bare).alias("rows"))
    return grouped.select("symbol", F.concat(F.lit("["), F.array_join("rows", ","), F.lit("]")).alias("value"))


@query(
    "S7_kline_rows",
    f"""WITH {_HOURLY_KLINE} SELECT symbol, ms // 1000 AS time, {r("open")} AS open, {r("high")} AS high, {r("low")} AS low,
       {r("close")} AS close FROM k""",
)
def s7(spark: SparkSession, folder: str) -> DataFrame:
    return decode.kline_rows(kline_responses(spark, folder))


def kline_messages(spark: SparkSession, folder: str) -> DataFrame:
    """A stream frame per 1-minute candle and one other frame per symbol and day."""
    minutes = V.minute_candles(spark, folder)
    k = F.struct(
        F.unix_millis("open_time").alias("t"), F.col("symbol").alias("s"), F.lit("1m").alias("i"),
        *[F.col(c).cast("string").alias(n) for c, n in (("open", "o"), ("high", "h"), ("low", "l"), ("close", "c"))],
        (F.col("trades_count") > 1).alias("x"),
    )
    frames = minutes.select(F.to_json(F.struct(F.lit("kline").alias("e"), k.alias("k"))).alias("value"))
    others = minutes.select("symbol", F.to_date("open_time").alias("day")).distinct()
    return frames.unionByName(others.select(F.to_json(F.struct(F.col("symbol").alias("result"))).alias("value")))


@query(
    "S8_kline_frames",
    f"""WITH {V.C1M_SQL} SELECT epoch_ms(open_time) // 1000 AS time, {r("open")} AS open, {r("high")} AS high, {r("low")} AS low,
       {r("close")} AS close, trades_count > 1 AS is_final, '1m' AS interval, symbol FROM c1m""",
)
def s8(spark: SparkSession, folder: str) -> DataFrame:
    return decode.kline_frames(kline_messages(spark, folder))


# --- sinks -----------------------------------------------------------------------------------


def canonical_trades(spark: SparkSession, folder: str) -> DataFrame:
    return V.ticks(spark, folder).withColumns(
        {"processing_time": processed_at(), "date_partition": F.to_date("timestamp")}
    )


@query(
    "S3_bronze_append",
    f"""WITH {V.TICKS_SQL} SELECT symbol, "timestamp", {r("price")} AS price, {r("volume")} AS volume, side, trade_id, source,
       TIMESTAMP '{V.PROCESSED_AT}' AS processing_time, strftime("timestamp", '%Y-%m-%d') AS date_partition
FROM ticks""",
)
def s3(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "bronze")
    sinks.write_bronze(canonical_trades(spark, folder), path, spread=True)
    return readers.read_bronze(spark, path)


@query(
    "O3_bronze_order",
    f"""WITH {V.TICKS_SQL} SELECT strftime("timestamp", '%Y-%m-%d') AS date_partition, count(*) AS rows, true AS in_order
FROM ticks GROUP BY ALL""",
)
def o3(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "bronze")
    sinks.write_bronze(canonical_trades(spark, folder), path)
    # Row order inside a file, checked by the running maximum of the sort columns.
    files = readers.read_bronze(spark, path).select(
        "date_partition", F.struct("timestamp", "symbol", "side").alias("place"), F.input_file_name().alias("file"),
        F.monotonically_increasing_id().alias("nth"),
    )
    by_file = files.groupBy("date_partition", "file").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min_by("place", "nth").alias("first"), F.min("place").alias("low"),
        F.max_by("place", "nth").alias("last"), F.max("place").alias("high"),
    )
    ordered = (F.col("first") == F.col("low")) & (F.col("last") == F.col("high"))
    return by_file.groupBy("date_partition").agg(F.sum("rows").alias("rows"), F.bool_and(ordered).alias("in_order"))


@query(
    "S4_candle_upsert",
    f"""WITH {V.C1M_SQL} SELECT symbol, open_time, {r("open")} AS open, {r("close")} AS close, {r("volume")} AS volume, trades_count FROM c1m""",
)
def s4(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "candles")
    candles = V.minute_candles(spark, folder)
    sinks.upsert_candles(candles, path)
    # A late partial candle for every minute, and a replay: neither changes the table.
    partial = candles.withColumns({"volume": F.lit(0.0), "trades_count": F.lit(0).cast("long")})
    sinks.upsert_candles(partial, path)
    sinks.upsert_candles(candles, path)
    return spark.read.parquet(path).select("symbol", "open_time", "open", "close", "volume", "trades_count")


@query(
    "S5_month_partitions",
    f"""WITH {V.TRADES_SQL} SELECT strftime(trade_ts, '%Y-%m') AS month, count(*) AS trades FROM trades_v GROUP BY ALL""",
)
def s5(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "trades-by-month")
    sinks.write_months(V.trades(spark, folder), path, "trade_ts")
    months = spark.read.option("partitionColumnTypeInference", "false").parquet(path)
    return months.groupBy(F.date_format("trade_ts", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("trades"))


@query(
    "S6_event_publish",
    """SELECT CAST(coalesce(CASE WHEN event_id % 3 = 0 THEN event_id END, CASE WHEN event_id % 3 = 1 THEN user_id END, event_id) AS VARCHAR) AS key,
       event_type AS type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%gZ') AS "timestamp", 'order-service' AS service,
       event_type AS header_type, CAST(event_id AS VARCHAR) AS header_correlation FROM events""",
)
def s6(spark: SparkSession, folder: str) -> DataFrame:
    number = F.col("event_id")
    events = V.table(spark, folder, "events").select(
        F.when(number % 3 == 0, number).alias("aggregateId"),
        F.when(number % 3 == 1, F.col("user_id")).alias("userId"),
        number.alias("id"),
        F.col("event_type").alias("type"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("timestamp"),
        number.cast("string").alias("correlationId"),
    )
    sent = sinks.event_messages(events, "order-service")
    body = F.from_json("value", "type string, timestamp string, service string")
    return sent.select(
        "key", body["type"].alias("type"), body["timestamp"].alias("timestamp"), body["service"].alias("service"),
        F.col("headers")[0]["value"].alias("header_type"), F.col("headers")[1]["value"].alias("header_correlation"),
    )


@query(
    "S9_publish_latest",
    f"""WITH {V.TICKS_SQL} SELECT symbol, {r('arg_max(price, "timestamp")')} AS price, max("timestamp") AS price_time
FROM ticks GROUP BY symbol""",
)
def s9(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "latest")
    rows = V.ticks(spark, folder)
    sinks.publish_latest(C.latest_price(rows), path)
    # An older batch that arrives later leaves the table as it is.
    older = rows.filter(F.col("timestamp") < F.lit("2024-01-10").cast("timestamp"))
    sinks.publish_latest(C.latest_price(older), path)
    return spark.read.parquet(path).select("symbol", "price", "price_time")


@query(
    "S11_lake_table",
    f"""WITH {V.TICKS_SQL} SELECT symbol, side, source, count(*) AS trades, {r("sum(volume)")} AS volume FROM ticks GROUP BY ALL""",
)
def s11(spark: SparkSession, folder: str) -> DataFrame:
    path = fresh_path(spark, "lake")
    name = "lake_trades_" + path.rsplit("-", 1)[1]
    lake = sinks.create_lake_table(spark, name, path)
    rows = V.ticks(spark, folder).select(*lake.columns)
    rows.write.mode("append").insertInto(name)
    totals = spark.table(name).groupBy("symbol", "side", "source").agg(
        F.count(F.lit(1)).alias("trades"), F.sum("volume").alias("volume")
    )
    return totals


# --- quality gate ------------------------------------------------------------------------------

_CHECKED = """checked AS (
  SELECT *, symbol IS NOT NULL AS q1,
         price BETWEEN 0.00001 AND 10000000 AND volume BETWEEN 0.000001 AND 1000000 AND side IN ('buy', 'sell')
           AND lower(source) IN ('bybit', 'binance', 'coinbase') AND coalesce(symbol <> '', false) AND trade_id <> '' AS q2,
         coalesce(upper(symbol) LIKE '%USDT' AND length(symbol) >= 5, false) AND trade_id <> '0' AS q3,
         date_diff('microsecond', "timestamp", as_of) BETWEEN -10000000 AND 300000000 AS q4
  FROM gate_input)"""
_JUDGED = """first_four AS (
  SELECT *, CASE WHEN NOT q1 THEN 'completeness' WHEN NOT q2 THEN 'validity' WHEN NOT q3 THEN 'consistency'
                 WHEN NOT q4 THEN 'timeliness' END AS failed FROM checked),
seq AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id) AS k FROM first_four WHERE failed IS NULL),
walk AS (
  SELECT symbol, k, event_id, [price] AS recent, true AS ok FROM seq WHERE k = 1
  UNION ALL
  SELECT symbol, k, event_id, CASE WHEN ok THEN list_slice(list_append(recent, price), -100, -1) ELSE recent END, ok
  FROM (SELECT s.symbol, s.k, s.event_id, s.price, w.recent,
               len(w.recent) < 10 OR NOT (list_avg(w.recent) > 0 AND abs(s.price - list_avg(w.recent)) / list_avg(w.recent) > 0.5) AS ok
        FROM walk w JOIN seq s ON s.symbol = w.symbol AND s.k = w.k + 1)),
judged AS (
  SELECT f.event_id, f.symbol, coalesce(f.failed, CASE WHEN NOT w.ok THEN 'accuracy' END) AS failed_dimension
  FROM first_four f LEFT JOIN walk w USING (event_id))"""
CHECKED_SQL = f"WITH RECURSIVE {V.GATE_INPUT_SQL}, {_CHECKED}"
JUDGED_SQL = f"{CHECKED_SQL}, {_JUDGED}"


@query("Q1_completeness", f"{CHECKED_SQL} SELECT event_id, q1 AS passed FROM checked")
def q1(spark: SparkSession, folder: str) -> DataFrame:
    return V.gate_input(spark, folder).select("event_id", checks.complete().alias("passed"))


@query(
    "Q1_completeness_wire",
    f"""WITH {V.MESSAGES_SQL} SELECT trade_id AS key, m NOT IN (0, 1, 2, 3, 6, 7, 9, 10) AS passed FROM wire""",
)
def q1_wire(spark: SparkSession, folder: str) -> DataFrame:
    return decoded(spark, folder).select("key", checks.complete_keys(F.col("present")).alias("passed"))


@query("Q2_validity", f"{CHECKED_SQL} SELECT event_id, q2 AS passed FROM checked")
def q2(spark: SparkSession, folder: str) -> DataFrame:
    return V.gate_input(spark, folder).select("event_id", checks.valid().alias("passed"))


@query("Q3_consistency", f"{CHECKED_SQL} SELECT event_id, q3 AS passed FROM checked")
def q3(spark: SparkSession, folder: str) -> DataFrame:
    return V.gate_input(spark, folder).select("event_id", checks.consistent().alias("passed"))


@query("Q4_timeliness", f"{CHECKED_SQL} SELECT event_id, q4 AS passed FROM checked")
def q4(spark: SparkSession, folder: str) -> DataFrame:
    return V.gate_input(spark, folder).select("event_id", checks.timely(F.col("as_of")).alias("passed"))


@query(
    "Q5_accuracy",
    f"""WITH {V.TICKS_SQL}, m AS (
  SELECT *, avg(price) OVER w AS mean, count(*) OVER w AS seen FROM ticks
  WINDOW w AS (PARTITION BY symbol ORDER BY "timestamp", trade_id ROWS BETWEEN 100 PRECEDING AND 1 PRECEDING))
SELECT symbol, trade_id, {r("mean", 8)} AS recent_mean, CASE WHEN seen >= 10 AND mean > 0 THEN {r("abs(price - mean) / mean", 8)} END AS deviation FROM m""",
    # A mean of 64 prices in cents has 8 decimals: at 6 it could fall on a tie.
    places=8,
)
def q5(spark: SparkSession, folder: str) -> DataFrame:
    return Q.with_deviation(V.ticks(spark, folder)).select("symbol", "trade_id", "recent_mean", "deviation")


@query(
    "Q5_accepted",
    f"""WITH RECURSIVE {V.TICKS_SQL}, seq AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY "timestamp", trade_id) AS k FROM ticks), walk AS (
  SELECT symbol, k, trade_id, [price] AS recent, true AS accepted FROM seq WHERE k = 1
  UNION ALL
  SELECT symbol, k, trade_id, CASE WHEN ok THEN list_slice(list_append(recent, price), -100, -1) ELSE recent END, ok
  FROM (SELECT s.symbol, s.k, s.trade_id, s.price, w.recent,
               len(w.recent) < 10 OR NOT (list_avg(w.recent) > 0 AND abs(s.price - list_avg(w.recent)) / list_avg(w.recent) > 0.5) AS ok
        FROM walk w JOIN seq s ON s.symbol = w.symbol AND s.k = w.k + 1))
SELECT symbol, trade_id, accepted FROM walk""",
)
def q5_accepted(spark: SparkSession, folder: str) -> DataFrame:
    """Accuracy against accepted prices only."""
    return Q.with_accepted(V.ticks(spark, folder)).select("symbol", "trade_id", "accepted")


@query("Q6_first_failure", f"{JUDGED_SQL} SELECT event_id, failed_dimension FROM judged")
def q6(spark: SparkSession, folder: str) -> DataFrame:
    return Q.gate(V.gate_input(spark, folder), F.col("as_of")).select("event_id", "failed_dimension")


_FAILURES = ", ".join(
    f"count(*) FILTER (WHERE failed_dimension = '{d}') AS failed_{d}"
    for d in ("completeness", "validity", "consistency", "timeliness", "accuracy")
)


def _report_sql(by: str) -> str:
    keys = f"{by}, " if by else ""
    return f"""{JUDGED_SQL}, counts AS (
  SELECT {keys}count(*) AS all_records, count(*) FILTER (WHERE failed_dimension IS NULL) AS accepted_records, {_FAILURES}
  FROM judged GROUP BY ALL)
SELECT *, {r("CASE WHEN all_records = 0 THEN 100 ELSE accepted_records / all_records * 100 END", 2)} AS score,
       {r("CASE WHEN accepted_records = 0 THEN 100 ELSE (2 * accepted_records - all_records) / accepted_records * 100 END", 2)} AS score_ref,
       {r("(all_records - accepted_records) / greatest(accepted_records, 1) * 100", 2)} AS failure_rate_ref FROM counts"""


@query("Q7_quality_report", _report_sql(""))
def q7(spark: SparkSession, folder: str) -> DataFrame:
    return Q.quality_report(Q.gate(V.gate_input(spark, folder), F.col("as_of")))


@query("Q7_quality_by_symbol", _report_sql("symbol"))
def q7_symbol(spark: SparkSession, folder: str) -> DataFrame:
    return Q.quality_report(Q.gate(V.gate_input(spark, folder), F.col("as_of")), by=("symbol",))


# --- order requests -------------------------------------------------------------------------------


def order_requests(spark: SparkSession, folder: str) -> DataFrame:
    """A request per order, with some fields spoiled."""
    key = F.col("o_orderkey")
    uuid = F.concat(F.lit("550e8400-e29b-41d4-a716-"), F.lpad(key.cast("string"), 12, "0"))
    kind = F.element_at(F.array(*[F.lit(t) for t in ("market", "limit", "stop", "stop_limit")]), (key % 4 + 1).cast("int"))
    nothing = F.lit(None).cast("string")
    return V.table(spark, folder, "orders").select(
        key.alias("request_id"),
        F.when(key % 11 == 0, "invalid-uuid").otherwise(uuid).alias("portfolio_id"),
        F.when(key % 13 == 0, "BTC").otherwise("ETHUSDT").alias("symbol"),
        F.when(key % 17 == 0, "iceberg").otherwise(kind).alias("type"),
        F.when(key % 19 == 0, nothing).when(key % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.when(key % 7 == 0, F.lit(1500.0)).when(key % 7 == 1, F.lit(-0.5)).otherwise(F.lit(0.5)).alias("quantity"),
        F.when(key % 5 != 0, F.col("o_totalprice")).alias("price"),
        F.when(key % 23 == 0, "KRAKEN").when(key % 3 == 0, "BYBIT").alias("exchange_code"),
        F.lit("ignored").alias("note"),
    )


_REQUEST_ERRORS = """bad AS (
  SELECT o_orderkey AS k, o_orderkey % 11 = 0 AS e1, o_orderkey % 13 = 0 AS e2, o_orderkey % 17 = 0 AS e3, o_orderkey % 19 = 0 AS e4,
         o_orderkey % 7 IN (0, 1) AS e5, o_orderkey % 5 = 0 AND o_orderkey % 17 <> 0 AND o_orderkey % 4 IN (1, 3) AS e6,
         o_orderkey % 23 = 0 AS e7 FROM orders)"""


@query(
    "Q8_order_requests",
    f"""WITH {_REQUEST_ERRORS}
SELECT k AS request_id, NOT (e1 OR e2 OR e3 OR e4 OR e5 OR e6 OR e7) AS is_valid,
       concat_ws(',', CASE WHEN e1 THEN 'portfolio_id' END, CASE WHEN e2 THEN 'symbol' END, CASE WHEN e3 THEN 'type' END,
                 CASE WHEN e4 THEN 'side' END, CASE WHEN e5 THEN 'quantity' END, CASE WHEN e6 THEN 'price' END,
                 CASE WHEN e7 THEN 'exchange_code' END) AS bad_fields,
       CASE WHEN e7 THEN 'KRAKEN' WHEN k % 3 = 0 THEN 'BYBIT' ELSE 'BINANCE' END AS exchange_code FROM bad""",
)
def q8(spark: SparkSession, folder: str) -> DataFrame:
    checked = Q.check_order_requests(order_requests(spark, folder))
    fields = F.array_join(F.transform("errors", lambda e: e["field"]), ",")
    return checked.select("request_id", "is_valid", fields.alias("bad_fields"), "exchange_code")
