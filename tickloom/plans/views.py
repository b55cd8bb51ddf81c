"""The platform's tables as views of the driver's tables, in Spark and in DuckDB SQL.

Each ``*_SQL`` constant states the same mapping as the function of that name, for
the oracles' WITH clauses.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators.candles import trade_candles
from tickloom.schemas import PRICE, QUANTITY
from tickloom.operators.stacking import stack
from tickloom.sources.staging import stage


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# --- market data ------------------------------------------------------------------------


def ticks_of(events: DataFrame) -> DataFrame:
    """Trades from events; works on a stream of events too."""
    number = F.col("event_id")
    # props holds one number, {"k": n}.
    k = F.regexp_extract("props", "([0-9]+)", 1).cast("double")
    return events.select(
        F.concat(F.upper("event_type"), F.lit("USDT")).alias("symbol"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").alias("price"),
        (k + 1).alias("volume"),
        F.when(number % 2 == 0, "buy").otherwise("sell").alias("side"),
        number.cast("string").alias("trade_id"),
        F.when(number % 3 == 0, "bybit").when(number % 3 == 1, "binance").otherwise("coinbase").alias("source"),
    )


def ticks(spark: SparkSession, folder: str) -> DataFrame:
    return ticks_of(table(spark, folder, "events"))


TICKS_SQL = """ticks AS (
  SELECT upper(event_type) || 'USDT' AS symbol, ts AS "timestamp", value AS price,
         CAST(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) + 1 AS volume,
         CASE WHEN event_id % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         CAST(event_id AS VARCHAR) AS trade_id,
         CASE event_id % 3 WHEN 0 THEN 'bybit' WHEN 1 THEN 'binance' ELSE 'coinbase' END AS source,
         event_id
  FROM events)"""



def tied_ticks(spark: SparkSession, folder: str) -> DataFrame:
    """Trades of which two thirds happen on the full hour, many at one instant."""
    rows = ticks(spark, folder)
    return rows.withColumn(
        "timestamp",
        F.when(F.col("trade_id").cast("long") % 3 > 0, F.date_trunc("hour", "timestamp")).otherwise(F.col("timestamp")),
    )


TIED_TICKS_SQL = TICKS_SQL + """, tied AS (
  SELECT * REPLACE (CASE WHEN event_id % 3 > 0 THEN date_trunc('hour', "timestamp") ELSE "timestamp" END AS "timestamp"),
         row_number() OVER (PARTITION BY symbol ORDER BY
           CASE WHEN event_id % 3 > 0 THEN date_trunc('hour', "timestamp") ELSE "timestamp" END, event_id) AS turn
  FROM ticks)"""

MINUTE = """date_trunc('minute', "timestamp")"""
HOUR = """date_trunc('hour', "timestamp")"""


def candles_sql(name: str, bucket: str, keys: str = "symbol") -> str:
    """Candles straight from ticks, in DuckDB."""
    return f"""{name} AS MATERIALIZED (
  SELECT {keys}, {bucket} AS open_time, arg_min(price, "timestamp") AS open, max(price) AS high,
         min(price) AS low, arg_max(price, "timestamp") AS close, sum(volume) AS volume,
         count(*) AS trades_count
  FROM ticks GROUP BY {keys}, {bucket})"""


C1M_SQL = TICKS_SQL + ",\n" + candles_sql("c1m", MINUTE)
C1H_SQL = TICKS_SQL + ",\n" + candles_sql("c1h", HOUR)
BARS_SQL = (
    C1H_SQL + ",\nbars AS MATERIALIZED (SELECT symbol, open_time, high, close,"
    " row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS n FROM c1h)"
)
MINUTE_BARS_SQL = (
    C1M_SQL + ",\nbars AS MATERIALIZED (SELECT symbol, open_time, high, close,"
    " row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS n FROM c1m)"
)


def minute_candles(spark: SparkSession, folder: str) -> DataFrame:
    return trade_candles(ticks(spark, folder))


def hour_candles(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly candles straight from the trades, staged: the indicators pass over
    them several times, the trades are read and shuffled once."""
    return stage(trade_candles(ticks(spark, folder), "1 hour"), "candles-1h")


def listed_candles(spark: SparkSession, folder: str) -> DataFrame:
    """1-minute candles by (symbol_id, exchange_id): k is the symbol, the source the exchange."""
    place = F.when(F.col("source") == "bybit", 0).when(F.col("source") == "binance", 1).otherwise(2)
    listed = ticks(spark, folder).withColumns(
        {"symbol_id": (F.col("volume") - 1).cast("long"), "exchange_id": place.cast("long")}
    )
    return trade_candles(listed, keys=("symbol_id", "exchange_id")).withColumnRenamed("open_time", "open_ts")


LISTED_SQL = (
    TICKS_SQL.replace("event_id\n  FROM", "event_id, event_id % 3 AS exchange_id,\n"
                      "         CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS symbol_id\n  FROM")
    + ",\n" + candles_sql("listed", MINUTE, "symbol_id, exchange_id")
)


def gate_input_of(trades: DataFrame) -> DataFrame:
    """Ticks with some fields spoiled, and the time at which each is judged."""
    n = F.col("trade_id").cast("long")
    m = n % 23
    text = F.lit(None).cast("string")
    return trades.withColumns(
        {
            "symbol": F.when(m == 0, text).when(m == 4, "XUSD").otherwise(F.col("symbol")),
            "side": F.when(m == 1, "hold").otherwise(F.col("side")),
            "source": F.when(m == 2, "kraken").when(m == 5, F.upper("source")).otherwise(F.col("source")),
            "trade_id": F.when(m == 3, "0").otherwise(F.col("trade_id")),
            "event_id": n,
            "as_of": F.timestamp_micros(F.unix_micros("timestamp") + (n % 400 - 20) * 1_000_000),
        }
    )


def gate_input(spark: SparkSession, folder: str) -> DataFrame:
    return gate_input_of(ticks(spark, folder))


GATE_INPUT_SQL = TICKS_SQL + """, gate_input AS (
  SELECT CASE event_id % 23 WHEN 0 THEN NULL WHEN 4 THEN 'XUSD' ELSE symbol END AS symbol, "timestamp", price, volume,
         CASE WHEN event_id % 23 = 1 THEN 'hold' ELSE side END AS side,
         CASE event_id % 23 WHEN 2 THEN 'kraken' WHEN 5 THEN upper(source) ELSE source END AS source,
         CASE WHEN event_id % 23 = 3 THEN '0' ELSE trade_id END AS trade_id, event_id,
         "timestamp" + to_seconds(event_id % 400 - 20) AS as_of
  FROM ticks)"""


# --- wire messages -------------------------------------------------------------------------

PROCESSED_AT = "2024-02-01 00:00:00"


def messages_of(events: DataFrame) -> DataFrame:
    """Messages with key, value and topic: most canonical, some raw, some broken."""
    rows = ticks_of(events).withColumn("m", F.col("trade_id").cast("long") % 20)
    m, ident = F.col("m"), F.col("trade_id")
    millis = F.unix_millis("timestamp").cast("string")

    def text(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}": "'), value, F.lit('"'))

    def bare(key: str, value: Column) -> Column:
        return F.concat(F.lit(f'"{key}": '), value)

    price, volume = F.col("price").cast("string"), F.col("volume").cast("string")
    raw = F.concat_ws(
        ", ",
        F.when(m == 10, text("T", F.lit("abc"))).otherwise(bare("T", millis)),
        text("p", price),
        text("v", volume),
        text("S", F.when(m == 9, "Hold").otherwise(F.initcap("side"))),
        F.when(m != 1, text("i", ident)),
    )
    iso = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    zone = F.when(m == 8, "Z").otherwise("+00:00")
    canonical = F.concat_ws(
        ", ",
        F.when(m != 2, text("symbol", F.col("symbol"))),
        F.when(m == 5, bare("timestamp", millis)).otherwise(text("timestamp", F.concat(iso, zone))),
        F.when(m == 4, text("price", F.lit("n/a"))).otherwise(bare("price", price)),
        bare("volume", volume),
        text("side", F.col("side")),
        F.when(m != 6, text("trade_id", ident)),
        F.when(m != 3, text("source", F.col("source"))),
    )
    body = F.when(m.isin(0, 1, 9, 10), raw).otherwise(canonical)
    value = F.when(m != 7, F.concat(F.lit("{"), body, F.lit("}")))
    topic = F.when(m == 1, "trades").otherwise(F.concat(F.lower("symbol"), F.lit("-bybit")))
    return rows.select(
        ident.cast("binary").alias("key"), value.cast("binary").alias("value"), topic.alias("topic")
    )


def messages(spark: SparkSession, folder: str) -> DataFrame:
    return messages_of(table(spark, folder, "events"))


MESSAGES_SQL = TICKS_SQL + """, wire AS (
  SELECT *, event_id % 20 AS m, date_trunc('milliseconds', "timestamp") AS ms,
         CASE WHEN event_id % 20 = 1 THEN 'trades' ELSE lower(symbol) || '-bybit' END AS topic
  FROM ticks)"""


# --- book ------------------------------------------------------------------------------------


def assets(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("n_nationkey")
    code = F.regexp_replace("n_name", "_", "")
    for number, name in enumerate(["USDT", "USDC", "ERROR", "VIEW", "PURCHASE", "SIGNUP", "CLICK"]):
        code = F.when(key == number, name).otherwise(code)
    return table(spark, folder, "nation").select(
        key.cast("long").alias("id"), code.alias("code"), F.col("n_name").alias("name")
    )


ASSETS_SQL = """assets AS (
  SELECT CAST(n_nationkey AS BIGINT) AS id,
         CASE n_nationkey WHEN 0 THEN 'USDT' WHEN 1 THEN 'USDC' WHEN 2 THEN 'ERROR' WHEN 3 THEN 'VIEW'
              WHEN 4 THEN 'PURCHASE' WHEN 5 THEN 'SIGNUP' WHEN 6 THEN 'CLICK'
              ELSE replace(n_name, '_', '') END AS code, n_name AS name
  FROM nation)"""


def symbols(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("p_partkey")
    name = F.concat(F.lit("B"), F.substring("p_brand", 7, 4), F.lit("P"), key.cast("string"), F.lit("USDT"))
    return table(spark, folder, "part").select(
        key.alias("id"),
        name.alias("symbol"),
        (key % 23 + 2).cast("long").alias("base_asset_id"),
        F.lit(0).cast("long").alias("quote_asset_id"),
        F.lit(True).alias("is_active"),
    )


SYMBOLS_SQL = """symbols AS (
  SELECT p_partkey AS id, 'B' || substr(p_brand, 7, 4) || 'P' || p_partkey || 'USDT' AS symbol,
         CAST(p_partkey % 23 + 2 AS BIGINT) AS base_asset_id, CAST(0 AS BIGINT) AS quote_asset_id
  FROM part)"""


def exchanges(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("s_suppkey")
    code = F.when(key == 0, "BINANCE").when(key == 1, "COINBASE").when(key == 2, "KRAKEN").otherwise(F.col("s_name"))
    return table(spark, folder, "supplier").select(key.alias("id"), code.alias("code"), F.col("s_name").alias("name"))


EXCHANGES_SQL = """exchanges AS (
  SELECT s_suppkey AS id, CASE s_suppkey WHEN 0 THEN 'BINANCE' WHEN 1 THEN 'COINBASE' WHEN 2 THEN 'KRAKEN'
         ELSE s_name END AS code, s_name AS name
  FROM supplier)"""


def portfolios(spark: SparkSession, folder: str) -> DataFrame:
    key, segment = F.col("c_custkey"), F.col("c_mktsegment")
    base = F.when(segment == "BUILDING", 1).when(segment == "MACHINERY", 2).otherwise(0)
    return table(spark, folder, "customer").select(
        key.alias("id"),
        key.alias("user_id"),
        F.col("c_name").alias("name"),
        base.cast("long").alias("base_currency_id"),
        F.timestamp_seconds(F.lit(1_700_000_000) + key).alias("created_at"),
    )


PORTFOLIOS_SQL = """portfolios AS (
  SELECT c_custkey AS id, c_custkey AS user_id, c_name AS name,
         CAST(CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS BIGINT) AS base_currency_id,
         make_timestamp((1700000000 + c_custkey) * 1000000) AS created_at
  FROM customer)"""


def balances(spark: SparkSession, folder: str) -> DataFrame:
    """Cash in USDT and one other asset per portfolio."""
    key = F.col("c_custkey")
    cash = F.struct(F.lit(0).cast("long").alias("asset_id"), (F.col("c_acctbal").cast("decimal(12,2)") * 20).cast(QUANTITY).alias("qty"))
    coin = F.struct((key % 23 + 2).cast("long").alias("asset_id"), (key % 7 / 2).cast(QUANTITY).alias("qty"))
    return (
        table(spark, folder, "customer")
        .select(key.alias("portfolio_id"), F.explode(F.array(cash, coin)).alias("_b"))
        .select("portfolio_id", "_b.*")
    )


BALANCES_SQL = """balances AS (
  SELECT c_custkey AS portfolio_id, CAST(0 AS BIGINT) AS asset_id, CAST(CAST(c_acctbal AS DECIMAL(12,2)) * 20 AS DECIMAL(38,18)) AS qty FROM customer
  UNION ALL
  SELECT c_custkey, CAST(c_custkey % 23 + 2 AS BIGINT), CAST((c_custkey % 7) / 2.0 AS DECIMAL(38,18)) FROM customer)"""


def orders(spark: SparkSession, folder: str) -> DataFrame:
    key, status, urgency = F.col("o_orderkey"), F.col("o_orderstatus"), F.substring("o_orderpriority", 1, 1)
    at = F.col("o_orderdate").cast("timestamp")
    return table(spark, folder, "orders").select(
        key.alias("id"),
        F.col("o_custkey").alias("portfolio_id"),
        (key % 200).alias("symbol_id"),
        (key % 10).alias("exchange_id"),
        F.concat(F.lit("ext_"), key.cast("string")).alias("external_order_id"),
        F.when(key % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.when(urgency == "1", "market").when(urgency == "3", "stop").when(urgency == "4", "stop_limit")
        .otherwise("limit").alias("type"),
        F.col("o_totalprice").cast(PRICE).alias("price"),
        ((key % 50 + 1).cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast(QUANTITY).alias("quantity"),
        F.when(status == "F", "filled").when(status == "P", "partially_filled").when(key % 4 == 0, "new")
        .otherwise("open").alias("status"),
        at.alias("created_ts"),
        at.alias("updated_ts"),
    )


ORDERS_SQL = """orders_v AS (
  SELECT o_orderkey AS id, o_custkey AS portfolio_id, o_orderkey % 200 AS symbol_id, o_orderkey % 10 AS exchange_id,
         'ext_' || o_orderkey AS external_order_id,
         CASE WHEN o_orderkey % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN 'market' WHEN '3' THEN 'stop' WHEN '4' THEN 'stop_limit'
              ELSE 'limit' END AS type,
         CAST(o_totalprice AS DECIMAL(20,8)) AS price,
         CAST(CAST(o_orderkey % 50 + 1 AS DECIMAL(10,0)) * 0.01 AS DECIMAL(38,18)) AS quantity,
         CASE WHEN o_orderstatus = 'F' THEN 'filled' WHEN o_orderstatus = 'P' THEN 'partially_filled'
              WHEN o_orderkey % 4 = 0 THEN 'new' ELSE 'open' END AS status,
         o_orderdate AS created_ts, o_orderdate AS updated_ts
  FROM orders)"""


def trades(spark: SparkSession, folder: str) -> DataFrame:
    order, line = F.col("l_orderkey"), F.col("l_linenumber")
    return table(spark, folder, "lineitem").select(
        (order * 10 + line).alias("id"),
        (order % 150).alias("portfolio_id"),
        F.col("l_partkey").alias("symbol_id"),
        F.col("l_suppkey").alias("exchange_id"),
        order.alias("order_id"),
        F.concat(F.lit("x_"), order.cast("string"), F.lit("_"), line.cast("string")).alias("external_trade_id"),
        F.when(F.col("l_returnflag") == "N", "buy").otherwise("sell").alias("side"),
        (F.col("l_extendedprice") / F.col("l_quantity")).cast(PRICE).alias("price"),
        F.col("l_quantity").cast(QUANTITY).alias("quantity"),
        F.when(line % 2 == 1, F.lit(0)).cast("long").alias("fee_asset_id"),
        (F.col("l_extendedprice") * F.col("l_tax")).cast(QUANTITY).alias("fee_amount"),
        F.col("l_shipdate").cast("timestamp").alias("trade_ts"),
    )


TRADES_SQL = """trades_v AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey % 150 AS portfolio_id, l_partkey AS symbol_id,
         l_suppkey AS exchange_id, l_orderkey AS order_id, 'x_' || l_orderkey || '_' || l_linenumber AS external_trade_id,
         CASE WHEN l_returnflag = 'N' THEN 'buy' ELSE 'sell' END AS side,
         round(l_extendedprice / l_quantity, 8) AS price, l_quantity AS quantity,
         CASE WHEN l_linenumber % 2 = 1 THEN CAST(0 AS BIGINT) END AS fee_asset_id,
         l_extendedprice * l_tax AS fee_amount, l_shipdate AS trade_ts
  FROM lineitem)"""


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Execution or cancel requests: one per order, every seventh by a stranger."""
    key = F.col("o_orderkey")
    return table(spark, folder, "orders").select(
        key.alias("order_id"),
        F.when(key % 7 == 0, F.col("o_custkey") + 1).otherwise(F.col("o_custkey")).alias("user_id"),
        F.when(key % 3 == 0, F.col("o_totalprice") * 0.99).cast(PRICE).alias("execution_price"),
    )


def repeated_requests(spark: SparkSession, folder: str) -> DataFrame:
    """The same requests, every one delivered again a minute later and half of them with another price."""
    once = requests(spark, folder).withColumn("requested_at", F.lit("2024-03-01").cast("timestamp"))
    again = once.withColumns(
        {
            "requested_at": F.col("requested_at") + F.expr("interval 1 minute"),
            "execution_price": F.when(F.col("order_id") % 2 == 0, F.lit(1)).otherwise(F.col("execution_price")).cast(PRICE),
        }
    )
    return stack(once, again)


REQUESTS_SQL = """requests AS (
  SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 7 = 0 THEN o_custkey + 1 ELSE o_custkey END AS user_id,
         CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_totalprice * 0.99 AS DECIMAL(20,8)) END AS execution_price
  FROM orders)"""
