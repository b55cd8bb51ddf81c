"""Queries over trades and candles: A1-A9, A12, O1, O3, S and W."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import backtest as B
from tickloom.operators import book
from tickloom.operators import candles as C
from tickloom.operators import indicators as I
from tickloom.operators.ledger import insert_missing
from tickloom.operators.refresh import refresh_rollups
from tickloom.operators.series import ROW, slice_rows
from tickloom.plans import views as V
from tickloom.plans.registry import query, r
from tickloom.sources.staging import fresh_path, stage

OHLCV = f'{r("open")} AS open, {r("high")} AS high, {r("low")} AS low, {r("close")} AS close, {r("volume")} AS volume'


def rollup_sql(minutes: int, source: str = "c1m", keys: str = "symbol", name: str = "rolled", tie: str = "") -> str:
    """Rollup of candles in DuckDB; ``tie`` orders candles of one minute."""
    bucket = f"time_bucket(INTERVAL {minutes} MINUTE, open_time)"
    rank = f"ROW(open_time{tie})"
    return f"""{name} AS (
  SELECT {keys}, {bucket} AS open_time, arg_min(open, {rank}) AS open, max(high) AS high, min(low) AS low,
         arg_max(close, {rank}) AS close, sum(volume) AS volume, CAST(sum(trades_count) AS BIGINT) AS trades_count,
         count(*) AS candles_count, min(open_time) AS first_ts
  FROM {source} GROUP BY {keys}, {bucket})"""


# --- candles ---------------------------------------------------------------------------------


@query(
    "A1_candles_1m",
    f"""WITH {V.C1M_SQL}
SELECT symbol, open_time, {OHLCV}, open_time + INTERVAL 59999999 MICROSECOND AS close_time, trades_count FROM c1m""",
)
def a1(spark: SparkSession, folder: str) -> DataFrame:
    return C.trade_candles(V.ticks(spark, folder), inclusive=True)


@query(
    "A1_complete_candles",
    f"""WITH {V.C1M_SQL}
SELECT symbol, open_time, {OHLCV}, open_time + INTERVAL 1 MINUTE AS close_time, trades_count
FROM c1m WHERE open_time < TIMESTAMP '2024-01-20 12:34:00'""",
)
def a1_complete(spark: SparkSession, folder: str) -> DataFrame:
    as_of = F.lit("2024-01-20 12:34:56").cast("timestamp")
    return C.trade_candles(V.ticks(spark, folder), as_of=as_of)


def _rollup(key: str, minutes: int, span: str):
    @query(
        key,
        f"""WITH {V.C1M_SQL}, {rollup_sql(minutes)}
SELECT symbol, open_time, {OHLCV}, open_time + INTERVAL {minutes} MINUTE AS close_time, candles_count FROM rolled""",
    )
    def build(spark: SparkSession, folder: str) -> DataFrame:
        return C.rollup_candles(V.minute_candles(spark, folder), span).drop("trades_count", "first_ts")

    return build


_rollup("A2_rollup_5m", 5, "5 minutes")
_rollup("A3_rollup_15m", 15, "15 minutes")
_rollup("A4_rollup_1h", 60, "1 hour")


@query(
    "A5_count_semantics",
    f"""WITH {V.C1M_SQL}, {rollup_sql(60)} SELECT symbol, open_time, trades_count, candles_count FROM rolled""",
)
def a5(spark: SparkSession, folder: str) -> DataFrame:
    rolled = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    return rolled.select("symbol", "open_time", "trades_count", "candles_count")


@query(
    "A6_exchange_rollup_5m",
    f"""WITH {V.LISTED_SQL}, {rollup_sql(5, "listed", "symbol_id, exchange_id")}
SELECT symbol_id, exchange_id, open_time, first_ts, {OHLCV} FROM rolled""",
)
def a6(spark: SparkSession, folder: str) -> DataFrame:
    rolled = C.rollup_candles(
        V.listed_candles(spark, folder), "5 minutes", keys=("symbol_id", "exchange_id"), open_time="open_ts"
    )
    return rolled.drop("close_time", "trades_count", "candles_count")


@query(
    "A7_first_last",
    f"""WITH {V.TICKS_SQL}
SELECT symbol, {V.HOUR} AS open_time, {r('arg_min(price, "timestamp")')} AS first_price,
       {r('arg_max(price, "timestamp")')} AS last_price
FROM ticks GROUP BY ALL""",
)
def a7(spark: SparkSession, folder: str) -> DataFrame:
    hours = V.ticks(spark, folder).withColumn("open_time", C.bucket_start("timestamp", "1 hour"))
    return C.ordered_ends(
        hours, ["symbol", "open_time"], C.event_offset("timestamp", "1 hour"), "trade_id",
        {"first_price": "price"}, {"last_price": "price"},
    )


LATEST_SQL = f"""WITH {V.TICKS_SQL}
SELECT symbol, {r('arg_max(price, "timestamp")')} AS price, max("timestamp") AS price_time FROM ticks GROUP BY symbol"""


@query(
    "A1_tied_instants",
    f"""WITH {V.TIED_TICKS_SQL}, tied_1m AS (
  SELECT symbol, {V.MINUTE} AS open_time, arg_min(price, turn) AS open, max(price) AS high, min(price) AS low,
         arg_max(price, turn) AS close, sum(volume) AS volume, count(*) AS trades_count FROM tied GROUP BY ALL)
SELECT symbol, open_time, {OHLCV}, open_time + INTERVAL 1 MINUTE AS close_time, trades_count FROM tied_1m""",
)
def a1_tied(spark: SparkSession, folder: str) -> DataFrame:
    """Trades of one instant open and close by their ids."""
    return C.trade_candles(V.tied_ticks(spark, folder))


@query(
    "A9_tied_instants",
    f"""WITH {V.TIED_TICKS_SQL} SELECT symbol, {r("arg_max(price, turn)")} AS price, max("timestamp") AS price_time
FROM tied GROUP BY symbol""",
)
def a9_tied(spark: SparkSession, folder: str) -> DataFrame:
    return C.latest_price(V.tied_ticks(spark, folder))


@query("A9_latest_price", LATEST_SQL)
def a9(spark: SparkSession, folder: str) -> DataFrame:
    return C.latest_price(V.ticks(spark, folder))


_ALL_ROLLUPS = " UNION ALL ".join(
    f"SELECT '{name}' AS timeframe, symbol, open_time, {OHLCV}, trades_count, candles_count FROM rolled_{name}"
    for name in ("5m", "15m", "1h")
)


@query(
    "A12_refresh_rollups",
    f"""WITH {V.C1M_SQL}, {rollup_sql(5, name="rolled_5m")}, {rollup_sql(15, name="rolled_15m")},
{rollup_sql(60, name="rolled_1h")} {_ALL_ROLLUPS}""",
)
def a12(spark: SparkSession, folder: str) -> DataFrame:
    candles = stage(V.minute_candles(spark, folder), "candles-1m")
    target = fresh_path(spark, "rollups")
    refresh_rollups(candles, target)
    # A second, incremental run over the later half of the days changes nothing.
    touched = candles.select(F.to_date("open_time").alias("open_date")).filter("day(open_date) > 15").distinct()
    tables = refresh_rollups(candles, target, touched)
    parts = [t.withColumn("timeframe", F.lit(name)) for name, t in tables.items()]
    whole = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return whole.drop("open_date", "first_ts", "close_time")


# --- views over listed candles -----------------------------------------------------------------


@query(
    "J1_symbol_candles",
    f"""WITH {V.LISTED_SQL}, {V.SYMBOLS_SQL}
SELECT s.symbol, l.exchange_id, l.open_time, {OHLCV}, l.open_time + INTERVAL 1 MINUTE AS close_time,
       CAST(1 AS BIGINT) AS trades_count
FROM listed l JOIN symbols s ON l.symbol_id = s.id""",
)
def j1(spark: SparkSession, folder: str) -> DataFrame:
    return book.symbol_candles(V.listed_candles(spark, folder), V.symbols(spark, folder))


@query(
    "J1_view_1h_merged",
    f"""WITH {V.LISTED_SQL}, {V.SYMBOLS_SQL}, named AS (
  SELECT s.symbol, l.* FROM listed l JOIN symbols s ON l.symbol_id = s.id),
{rollup_sql(60, "named", tie=", exchange_id")}
SELECT symbol, open_time, {OHLCV}, open_time + INTERVAL 1 HOUR AS close_time, candles_count AS trades_count FROM rolled""",
)
def j1_view(spark: SparkSession, folder: str) -> DataFrame:
    named = book.symbol_candles(V.listed_candles(spark, folder), V.symbols(spark, folder))
    return C.rollup_candles(named, "1 hour", tiebreak="exchange_id").drop("first_ts", "candles_count")


@query(
    "J6_candle_grid",
    f"""WITH {V.TICKS_SQL}, ends AS (
  SELECT symbol, min({V.HOUR}) AS a, max({V.HOUR}) AS b FROM ticks GROUP BY symbol)
SELECT length(symbol) AS symbol_id, s_suppkey AS exchange_id, symbol,
       unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS open_ts
FROM ends, supplier WHERE s_suppkey = 0""",
)
def j6(spark: SparkSession, folder: str) -> DataFrame:
    return book.candle_grid(_grid_pairs(spark, folder), "1 hour")


def _grid_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """Symbols of the ticks, each paired with the first of its exchanges by code."""
    hour = C.bucket_start("timestamp", "1 hour")
    ends = V.ticks(spark, folder).groupBy("symbol").agg(
        F.min(hour).alias("start"), F.max(hour).alias("end"), F.upper(F.min("source")).alias("code")
    )
    one = V.exchanges(spark, folder).select("code", F.col("id").alias("exchange_id"))
    return (
        ends.join(one, "code")
        .select(F.length("symbol").cast("long").alias("symbol_id"), "exchange_id", "symbol", "start", "end")
    )


@query(
    "S10_synthetic_candles",
    f"""WITH {V.LISTED_SQL}, ends AS (
  SELECT symbol, min({V.HOUR}) AS a, max({V.HOUR}) AS b FROM ticks GROUP BY symbol), grid AS (
  SELECT DISTINCT length(symbol) AS symbol_id, 0 AS exchange_id, unnest(generate_series(a, b, INTERVAL 1 MINUTE)) AS open_ts FROM ends)
SELECT symbol_id, exchange_id, open_time AS open_ts, false AS synthetic, true AS in_range FROM listed
UNION ALL SELECT symbol_id, exchange_id, open_ts, true, true FROM grid
WHERE (symbol_id, exchange_id, open_ts) NOT IN (SELECT (symbol_id, exchange_id, open_time) FROM listed)""",
)
def s10(spark: SparkSession, folder: str) -> DataFrame:
    grid = book.candle_grid(_grid_pairs(spark, folder), "1 minute")
    existing = V.listed_candles(spark, folder)
    rows = book.synthetic_candles(grid, existing, 50000.0, 1000.0)
    columns = ["symbol_id", "exchange_id", "open_ts", "open", "high", "low", "close", "volume"]
    whole = insert_missing(existing.select(*columns), rows.select(*columns), columns[:3])
    # Real prices are far below the synthetic ones.
    synthetic = F.col("close") >= 50000
    fits = F.col("open").between(50000, 51000) & F.col("high").between(50500, 51500) & F.col("low").between(49500, 50500)
    return whole.select(*columns[:3], synthetic.alias("synthetic"), (fits | ~synthetic).alias("in_range"))


# --- slices --------------------------------------------------------------------------------------


def _slice_sql(n: int, direction: str) -> str:
    return f"""WITH {V.C1H_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time {direction}) AS rank FROM c1h)
SELECT symbol, open_time, {OHLCV}, trades_count FROM ranked WHERE rank <= {n}"""


_SLICE = ["symbol", "open_time", "open", "high", "low", "close", "volume", "trades_count"]


@query("W8_slice_oldest", _slice_sql(200, ""))
def w8_oldest(spark: SparkSession, folder: str) -> DataFrame:
    candles = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    return slice_rows(candles, ["symbol"], ["open_time"], 200, "oldest").select(*_SLICE)


@query("W8_slice_newest", _slice_sql(500, "DESC"))
def w8_newest(spark: SparkSession, folder: str) -> DataFrame:
    candles = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    return slice_rows(candles, ["symbol"], ["open_time"], 500, "newest").select(*_SLICE)


@query("O1_newest_bars", _slice_sql(100, "DESC"))
def o1(spark: SparkSession, folder: str) -> DataFrame:
    candles = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    return slice_rows(candles, ["symbol"], ["open_time"], 100).orderBy("symbol", "open_time").select(*_SLICE)


@query(
    "S13_response",
    f"""WITH {V.C1H_SQL}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) AS rank FROM c1h)
SELECT symbol, '1h' AS interval, count(*) AS bars, {r("arg_min(close, open_time)")} AS first_close,
       {r("arg_max(close, open_time)")} AS last_close
FROM ranked WHERE rank <= 100 GROUP BY symbol""",
)
def s13(spark: SparkSession, folder: str) -> DataFrame:
    candles = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    bars = slice_rows(candles, ["symbol"], ["open_time"], 100)
    shaped = book.response_rows(bars, "1h", ["open", "high", "low", "close", "volume", "trades_count"])
    data = F.col("data")
    return shaped.select(
        "symbol",
        "interval",
        F.size(data).alias("bars"),
        F.element_at(data, 1)["close"].alias("first_close"),
        F.element_at(data, -1)["close"].alias("last_close"),
    )


# --- indicators ----------------------------------------------------------------------------------


def _frame(p: int) -> str:
    return f"OVER (PARTITION BY symbol ORDER BY n ROWS BETWEEN {p - 1} PRECEDING AND CURRENT ROW)"


def _sma_sql(p: int) -> str:
    return f"CASE WHEN n >= {p} THEN {r(f'avg(close) {_frame(p)}')} END AS sma_{p}"


@query(
    "W1_sma",
    f"WITH {V.BARS_SQL} SELECT symbol, open_time, {r('close')} AS close, {_sma_sql(20)}, {_sma_sql(50)}, {_sma_sql(200)} FROM bars",
)
def w1(spark: SparkSession, folder: str) -> DataFrame:
    closes = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    return I.with_sma(closes, [20, 50, 200])


def ema_sql(columns: dict[str, int], tail: str) -> str:
    """EMAs in DuckDB by recursion over the bars; ``tail`` is the final SELECT over ``e``."""
    first = ", ".join(f"close AS {name}" for name in columns)
    step = ", ".join(f"b.close * (2.0 / {p + 1}) + e.{name} * (1 - 2.0 / {p + 1})" for name, p in columns.items())
    return f"""WITH RECURSIVE {V.BARS_SQL}, e AS (
  SELECT symbol, n, {first} FROM bars WHERE n = 1
  UNION ALL
  SELECT b.symbol, b.n, {step} FROM e JOIN bars b ON b.symbol = e.symbol AND b.n = e.n + 1) {tail}"""


_EMAS = {f"ema_{p}": p for p in (2, 12, 26, 200)}


@query(
    "W2_ema",
    ema_sql(
        _EMAS,
        "SELECT symbol, open_time, " + ", ".join(f"{r(name)} AS {name}" for name in _EMAS) + " FROM e JOIN bars USING (symbol, n)",
    ),
)
def w2(spark: SparkSession, folder: str) -> DataFrame:
    closes = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    return I.with_ema(closes, list(_EMAS.values())).drop("close")


_DIFFS = """diffs AS (SELECT *, close - lag(close) OVER (PARTITION BY symbol ORDER BY n) AS d FROM bars)"""


def _strength(gain: str, loss: str) -> str:
    return f"CASE WHEN {loss} = 0 THEN 100.0 ELSE 100 - 100 / (1 + {gain} / {loss}) END"


FIRST_RSI_SQL = f"""{_DIFFS}, first_rsi AS (
  SELECT symbol, CASE WHEN count(d) < 14 THEN 50.0 ELSE {_strength("avg(greatest(d, 0))", "avg(greatest(-d, 0))")} END AS rsi
  FROM diffs WHERE n <= 15 GROUP BY symbol)"""


@query("W3_rsi_first", f"WITH {V.BARS_SQL}, {FIRST_RSI_SQL} SELECT symbol, {r('rsi')} AS rsi FROM first_rsi")
def w3(spark: SparkSession, folder: str) -> DataFrame:
    return I.first_rsi(C.rollup_candles(V.minute_candles(spark, folder), "1 hour"))


@query(
    "W3_rsi_rolling",
    f"""WITH {V.BARS_SQL}, {_DIFFS}
SELECT symbol, open_time, CASE WHEN n <= 14 THEN 50.0 ELSE
  {r(_strength(f"avg(greatest(d, 0)) {_frame(14)}", f"avg(greatest(-d, 0)) {_frame(14)}"))} END AS rsi FROM diffs""",
)
def w3_rolling(spark: SparkSession, folder: str) -> DataFrame:
    closes = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    return I.with_rsi(closes, 14).drop("close")


def macd_sql(pairs: dict[str, tuple[int, int, int]], tail: str) -> str:
    """MACD lines and signals in DuckDB; columns f_, s_ and g_ per name."""
    first, step = [], []
    for name, (fast, slow, signal) in pairs.items():
        f = f"(b.close * (2.0 / {fast + 1}) + e.f_{name} * (1 - 2.0 / {fast + 1}))"
        s = f"(b.close * (2.0 / {slow + 1}) + e.s_{name} * (1 - 2.0 / {slow + 1}))"
        g = f"({f} - {s}) * (2.0 / {signal + 1}) + e.g_{name} * (1 - 2.0 / {signal + 1})"
        first += [f"close AS f_{name}", f"close AS s_{name}", f"CAST(0 AS DOUBLE) AS g_{name}"]
        step += [f, s, g]
    return f"""WITH RECURSIVE {V.BARS_SQL}, e AS (
  SELECT symbol, n, {", ".join(first)} FROM bars WHERE n = 1
  UNION ALL
  SELECT b.symbol, b.n, {", ".join(step)} FROM e JOIN bars b ON b.symbol = e.symbol AND b.n = e.n + 1){tail}"""


@query(
    "W4_macd",
    macd_sql(
        {"m": (12, 26, 9)},
        f""" SELECT symbol, open_time, {r("f_m - s_m")} AS macd, {r("g_m")} AS macd_signal,
       {r("f_m - s_m - g_m")} AS macd_histogram FROM e JOIN bars USING (symbol, n)""",
    ),
)
def w4(spark: SparkSession, folder: str) -> DataFrame:
    closes = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    return I.with_macd(closes).drop("close")


def _band(sign: str) -> str:
    return f"CASE WHEN n >= 20 THEN {r(f'avg(close) {_frame(20)} {sign} 2 * stddev_pop(close) {_frame(20)}')} END"


@query(
    "W5_bollinger",
    f"""WITH {V.BARS_SQL} SELECT symbol, open_time, CASE WHEN n >= 20 THEN {r(f"avg(close) {_frame(20)}")} END AS bb_middle,
       {_band("+")} AS bb_upper, {_band("-")} AS bb_lower FROM bars""",
)
def w5(spark: SparkSession, folder: str) -> DataFrame:
    closes = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    return I.with_bollinger(closes).drop("close")


_RETURNS = """returns AS (SELECT *, (close - lag(close) OVER (PARTITION BY symbol ORDER BY n)) / nullif(lag(close) OVER (PARTITION BY symbol ORDER BY n), 0) AS ret FROM bars)"""


def _vol(p: int) -> str:
    return f"CASE WHEN n <= {p} THEN 0.0 ELSE {r(f'stddev_pop(ret) {_frame(p)} * sqrt({p})')} END"


@query(
    "W6_volatility",
    f"""WITH {V.BARS_SQL}, {_RETURNS} SELECT symbol, open_time, {_vol(10)} AS volatility_10, {_vol(14)} AS volatility_14 FROM returns""",
)
def w6(spark: SparkSession, folder: str) -> DataFrame:
    closes = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    return I.with_volatility(closes, [10, 14]).drop("close")


@query("W7_returns", f"WITH {V.BARS_SQL}, {_RETURNS} SELECT symbol, open_time, {r('ret')} AS simple_return FROM returns")
def w7(spark: SparkSession, folder: str) -> DataFrame:
    closes = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    return I.with_returns(closes).drop("close")


FEATURE_CTES = macd_sql(
    {"a": (12, 26, 9), "b": (5, 35, 5)},
    f""", {_RETURNS}, wide AS (
  SELECT symbol, open_time, n, high, close,
         CASE WHEN n >= 20 THEN avg(close) {_frame(20)} END AS sma_20,
         CASE WHEN n >= 50 THEN avg(close) {_frame(50)} END AS sma_50,
         CASE WHEN n >= 200 THEN avg(close) {_frame(200)} END AS sma_200,
         CASE WHEN n >= 20 THEN stddev_pop(close) {_frame(20)} END AS sd,
         CASE WHEN n <= 10 THEN 0.0 ELSE stddev_pop(ret) {_frame(10)} * sqrt(10) END AS volatility_10d,
         CASE WHEN n <= 14 THEN 0.0 ELSE stddev_pop(ret) {_frame(14)} * sqrt(14) END AS volatility_14d
  FROM returns), features AS MATERIALIZED (
  SELECT symbol, open_time, n, high, close AS price, sma_20, sma_50, sma_200, sma_20 AS bb_middle,
         sma_20 + 2 * sd AS bb_upper, sma_20 - 2 * sd AS bb_lower, volatility_10d, volatility_14d,
         f_a - s_a AS macd_12_26, f_b - s_b AS macd_5_35, g_b AS macd_signal_5_35,
         CAST(coalesce(close < sma_20 AND close < sma_50 AND close < sma_200, false) AS BIGINT) AS below_all_sma,
         n AS data_points
  FROM wide JOIN e USING (symbol, n))""",
)
_DOUBLES = [
    "high", "sma_20", "sma_50", "sma_200", "bb_middle", "bb_upper", "bb_lower", "volatility_10d", "volatility_14d",
    "macd_12_26", "macd_5_35", "macd_signal_5_35", "price",
]
_FEATURE_LIST = ", ".join(f"{r(name)} AS {name}" for name in _DOUBLES)


@query(
    "W9_feature_rows",
    f"{FEATURE_CTES} SELECT symbol, open_time, {_FEATURE_LIST}, below_all_sma, data_points FROM features",
)
def w9(spark: SparkSession, folder: str) -> DataFrame:
    return I.feature_rows(V.hour_candles(spark, folder))


@query(
    "W9_latest_features",
    f"""{FEATURE_CTES} SELECT symbol, open_time, {_FEATURE_LIST}, below_all_sma, data_points FROM features
WHERE n <= 200 QUALIFY n = max(n) OVER (PARTITION BY symbol)""",
)
def w9_latest(spark: SparkSession, folder: str) -> DataFrame:
    return I.latest_features(V.hour_candles(spark, folder), 200, "oldest")


@query(
    "W10_indicator_summary",
    macd_sql(
        {"m": (12, 26, 9), "x": (12, 12, 12)},
        f""", {FIRST_RSI_SQL}, s AS (SELECT *, avg(close) {_frame(20)} AS sma FROM bars)
SELECT symbol, {r("close")} AS current_price, CASE WHEN n >= 20 THEN {r("sma")} END AS sma, {r("f_x")} AS ema,
       {r("f_m - s_m")} AS macd, {r("g_m")} AS macd_signal, {r("f_m - s_m - g_m")} AS macd_histogram,
       {r("rsi")} AS rsi, n AS data_points
FROM e JOIN s USING (symbol, n) JOIN first_rsi USING (symbol)
WHERE n <= 200 QUALIFY n = max(n) OVER (PARTITION BY symbol)""",
    ),
)
def w10(spark: SparkSession, folder: str) -> DataFrame:
    summary = I.indicator_summary(V.hour_candles(spark, folder), side="oldest")
    return summary.select(
        "symbol", "current_price", "sma", "ema", F.col("macd.macd").alias("macd"),
        F.col("macd.signal").alias("macd_signal"), F.col("macd.histogram").alias("macd_histogram"), "rsi", "data_points",
    )


@query(
    "W11_sequences",
    f"""WITH {V.BARS_SQL}
SELECT symbol, open_time, CAST(7 AS BIGINT) AS steps, {r("lag(close, 6) OVER (PARTITION BY symbol ORDER BY n)")} AS first_close,
       {r("close")} AS last_close FROM bars QUALIFY n >= 7""",
)
def w11(spark: SparkSession, folder: str) -> DataFrame:
    bars = V.hour_candles(spark, folder).select("symbol", "open_time", "close")
    rows = I.feature_sequences(bars, ["close"], 7)
    steps = F.col("sequence")
    return rows.select(
        "symbol", "open_time", F.size(steps).alias("steps"),
        F.element_at(steps, 1)["close"].alias("first_close"), F.element_at(steps, -1)["close"].alias("last_close"),
    )


# --- crossover ---------------------------------------------------------------------------------


CROSS = """crossing AS (
  SELECT *, CASE WHEN n > 30 THEN avg(close) OVER (PARTITION BY symbol ORDER BY n ROWS BETWEEN 10 PRECEDING AND 1 PRECEDING) END AS fast,
         CASE WHEN n > 30 THEN avg(close) OVER (PARTITION BY symbol ORDER BY n ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING) END AS slow
  FROM bars)"""


@query(
    "W12_crossover",
    f"""WITH {V.BARS_SQL}, {CROSS}
SELECT symbol, open_time, {r("close")} AS close, {r("fast")} AS sma_short, {r("slow")} AS sma_long,
       CAST(sign(fast - slow) AS DOUBLE) + 0.0 AS direction FROM crossing""",
)
def w12(spark: SparkSession, folder: str) -> DataFrame:
    return B.crossover_signals(V.hour_candles(spark, folder).select("symbol", "open_time", "close"))


# The position by recursion over the bars, as a loop would keep it.
TRIPS = f"""WITH RECURSIVE {V.BARS_SQL}, {CROSS}, walk AS (
  SELECT symbol, n, open_time, close, 0 AS held, CAST(NULL AS VARCHAR) AS action FROM crossing WHERE n = 1
  UNION ALL
  SELECT c.symbol, c.n, c.open_time, c.close,
         CASE WHEN c.fast > c.slow THEN 1 WHEN c.fast < c.slow THEN 0 ELSE w.held END,
         CASE WHEN c.fast > c.slow AND w.held = 0 THEN 'buy' WHEN c.fast < c.slow AND w.held = 1 THEN 'sell' END
  FROM walk w JOIN crossing c ON c.symbol = w.symbol AND c.n = w.n + 1),
deals AS (SELECT *, lead(open_time) OVER s AS sell_time, lead(close) OVER s AS sell_price, row_number() OVER s AS d
  FROM walk WHERE action IS NOT NULL WINDOW s AS (PARTITION BY symbol ORDER BY n)),
trips AS (SELECT symbol, n, open_time AS buy_time, close AS buy_price, sell_time, sell_price,
  sell_price / close AS growth, row_number() OVER (PARTITION BY symbol ORDER BY n) AS t FROM deals WHERE action = 'buy'),
money AS (
  SELECT symbol, t, buy_time, sell_time, buy_price, sell_price, growth, CAST(10000.0 AS DOUBLE) * growth AS equity FROM trips WHERE t = 1
  UNION ALL
  SELECT x.symbol, x.t, x.buy_time, x.sell_time, x.buy_price, x.sell_price, x.growth, m.equity * x.growth
  FROM money m JOIN trips x ON x.symbol = m.symbol AND x.t = m.t + 1),
curve AS (SELECT *, greatest(10000.0, max(equity) OVER (PARTITION BY symbol ORDER BY t)) AS peak FROM money)"""

ALL_TRIPS = TRIPS.replace(V.BARS_SQL, V.MINUTE_BARS_SQL)


@query(
    "W13_round_trips",
    f"""{TRIPS} SELECT symbol, buy_time, {r("buy_price")} AS buy_price, sell_time, {r("sell_price")} AS sell_price,
       {r("growth - 1")} AS sell_return FROM curve""",
)
def w13(spark: SparkSession, folder: str) -> DataFrame:
    candles = V.hour_candles(spark, folder)
    return B.round_trips(B.backtest_bars(candles)).drop(ROW, "trip", "equity")


def _minute_bars(spark: SparkSession, folder: str) -> DataFrame:
    return stage(V.minute_candles(spark, folder), "candles-1m")


@query(
    "W13_all_bars",
    f"""{ALL_TRIPS} SELECT symbol, t AS trip, buy_time, {r("buy_price")} AS buy_price, sell_time, {r("sell_price")} AS sell_price,
       {r("growth - 1")} AS sell_return, {r("equity", 2)} AS equity FROM curve""",
)
def w13_all(spark: SparkSession, folder: str) -> DataFrame:
    """Every trip of a whole 1-minute series."""
    trips = B.round_trips(B.backtest_bars(_minute_bars(spark, folder), span="1 day")).drop(ROW)
    return trips.withColumn("equity", F.round("equity", 2))


@query(
    "W14_trend",
    f"""WITH {V.C1H_SQL}, newest AS (
  SELECT * FROM c1h QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 24), ends AS (
  SELECT symbol, arg_min(close, open_time) AS a, arg_max(close, open_time) AS b FROM newest GROUP BY symbol)
SELECT symbol, {r("a")} AS first_price, {r("b")} AS last_price, {r("(b - a) / a * 100")} AS change_percent,
       CASE WHEN (b - a) / a * 100 > 2 THEN 'up' WHEN (b - a) / a * 100 < -2 THEN 'down' ELSE 'flat' END AS trend FROM ends""",
)
def w14(spark: SparkSession, folder: str) -> DataFrame:
    return B.trend(C.rollup_candles(V.minute_candles(spark, folder), "1 hour"))


_REPORT = f"""{TRIPS}, sold AS (
  SELECT symbol, count(sell_time) AS trades, count(*) FILTER (WHERE growth > 1) AS winning,
         arg_max(equity, t) FILTER (WHERE sell_time IS NOT NULL) AS closed,
         max(buy_price) FILTER (WHERE sell_time IS NULL) AS open_price,
         max((peak - equity) / peak * 100) AS drawdown,
         CASE WHEN count(growth) > 1 AND stddev_pop(growth - 1) > 0
              THEN avg(growth - 1) / stddev_pop(growth - 1) * sqrt(250) ELSE 0 END AS sharpe
  FROM curve GROUP BY symbol),
ends AS (SELECT symbol, max(n) AS data_points, arg_max(close, n) AS last_close FROM bars GROUP BY symbol),
report AS (SELECT e.symbol, e.data_points, coalesce(trades, 0) AS trades, coalesce(winning, 0) AS winning,
  coalesce(closed, 10000.0) * coalesce(last_close / open_price, 1.0) AS final, coalesce(drawdown, 0) AS drawdown,
  coalesce(sharpe, 0) AS sharpe FROM ends e LEFT JOIN sold USING (symbol))"""


_REPORT_COLUMNS = f""" SELECT symbol, {r("(final - 10000) / 100", 2)} AS total_return, {r("final - 10000", 2)} AS total_return_abs,
       {r("sharpe", 2)} AS sharpe_ratio, {r("drawdown", 2)} AS max_drawdown,
       {r("CASE WHEN trades > 0 THEN winning / trades * 100 ELSE 0 END", 2)} AS win_rate, trades, winning AS winning_trades,
       trades - winning AS losing_trades, data_points, {r("final", 2)} AS final_equity FROM report"""


@query("W15_backtest_report", _REPORT + _REPORT_COLUMNS)
def w15(spark: SparkSession, folder: str) -> DataFrame:
    return B.backtest_report(V.hour_candles(spark, folder))


@query("W15_all_bars", _REPORT.replace(TRIPS, ALL_TRIPS) + _REPORT_COLUMNS)
def w15_all(spark: SparkSession, folder: str) -> DataFrame:
    """The report over whole 1-minute series."""
    return B.backtest_report(_minute_bars(spark, folder), span="1 day")


@query(
    "W16_drawdown",
    f"""{TRIPS} SELECT symbol, sell_time, {r("equity", 2)} AS equity, {r("peak", 2)} AS peak,
       {r("(peak - equity) / peak * 100")} AS drawdown FROM curve WHERE sell_time IS NOT NULL""",
)
def w16(spark: SparkSession, folder: str) -> DataFrame:
    trips = B.with_drawdown(B.round_trips(B.backtest_bars(V.hour_candles(spark, folder))))
    sold = trips.filter(F.col("sell_time").isNotNull())
    return sold.select(
        "symbol", "sell_time", F.round("equity", 2).alias("equity"), F.round("peak", 2).alias("peak"), "drawdown"
    )


@query(
    "W17_sharpe",
    f"{TRIPS} SELECT symbol, count(growth) AS trades, {r('CASE WHEN count(growth) > 1 AND stddev_pop(growth - 1) > 0 THEN avg(growth - 1) / stddev_pop(growth - 1) * sqrt(250) ELSE 0 END')} AS sharpe_ratio FROM curve GROUP BY symbol",
)
def w17(spark: SparkSession, folder: str) -> DataFrame:
    trips = B.round_trips(B.backtest_bars(V.hour_candles(spark, folder)))
    return trips.groupBy("symbol").agg(
        F.count("sell_return").alias("trades"), B.sharpe_ratio("sell_return").alias("sharpe_ratio")
    )


@query("W18_lookback", _slice_sql(240, "DESC"))
def w18(spark: SparkSession, folder: str) -> DataFrame:
    from tickloom.functions.params import lookback_bars

    candles = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    return slice_rows(candles, ["symbol"], ["open_time"], lookback_bars(10, "1h")).select(*_SLICE)


# --- display rules -------------------------------------------------------------------------------


@query(
    "P11_scaled_series",
    f"""WITH {V.C1H_SQL}, newest AS (
  SELECT * FROM c1h QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 168), placed AS (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY open_time) AS n, min(close) OVER (PARTITION BY symbol) AS lo,
         max(close) OVER (PARTITION BY symbol) AS hi, count(*) OVER (PARTITION BY symbol) AS k FROM newest)
SELECT symbol, open_time, {r("(n - 1) / nullif(k - 1, 0) * 60")} AS x, {r("20 - (close - lo) / nullif(hi - lo, 0) * 20")} AS y
FROM placed""",
)
def p11(spark: SparkSession, folder: str) -> DataFrame:
    candles = C.rollup_candles(V.minute_candles(spark, folder), "1 hour")
    return B.scaled_series(candles, 168).drop("close", ROW)


@query(
    "P12_ticker",
    f"""WITH {V.C1H_SQL}, newest AS (
  SELECT * FROM c1h QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY open_time DESC) <= 24), ends AS (
  SELECT symbol, arg_min(close, open_time) AS a, arg_max(close, open_time) AS b FROM newest GROUP BY symbol)
SELECT symbol, {r("CASE WHEN b < 1 THEN round(b, 4) ELSE round(b, 2) END")} AS shown_price,
       {r("abs((b - a) / a * 100)", 2)} AS shown_change, CASE WHEN b >= a THEN 'green' ELSE 'red' END AS colour FROM ends""",
)
def p12(spark: SparkSession, folder: str) -> DataFrame:
    trends = B.trend(C.rollup_candles(V.minute_candles(spark, folder), "1 hour"))
    return B.ticker(trends).select("symbol", "shown_price", "shown_change", "colour")


@query(
    "P12_day_volume",
    f"""WITH {V.TICKS_SQL}, lasts AS (SELECT symbol, max("timestamp") - INTERVAL 24 HOUR AS since FROM ticks GROUP BY symbol), sums AS (
  SELECT symbol, count(*) AS trades, sum(volume) AS volume, sum(price * volume) AS quote_volume
  FROM ticks JOIN lasts USING (symbol) WHERE "timestamp" > since GROUP BY symbol)
SELECT symbol, trades, {r("volume")} AS volume, {r("quote_volume", 4)} AS quote_volume, {r("round(volume / 1000)")} AS shown_thousands,
       {r("round(quote_volume / 1000000, 1)")} AS shown_quote_millions FROM sums""",
)
def p12_volume(spark: SparkSession, folder: str) -> DataFrame:
    rows = B.day_volume(V.ticks(spark, folder))
    return rows.withColumn("quote_volume", F.round("quote_volume", 4))


# --- flagship ------------------------------------------------------------------------------------


@query(
    "F1_hourly_bands",
    f"""WITH {V.BARS_SQL} SELECT symbol, open_time, {r("high")} AS high, {r("close")} AS close,
       CASE WHEN n >= 20 THEN {r(f"avg(close) {_frame(20)}")} END AS bb_middle,
       {_band("+")} AS bb_upper, {_band("-")} AS bb_lower FROM bars""",
)
def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Trades to hourly candles to Bollinger bands, for every symbol."""
    candles = V.hour_candles(spark, folder).select("symbol", "open_time", "high", "close")
    return I.with_bollinger(candles)
