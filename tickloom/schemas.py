"""Schemas, vocabularies and thresholds.

The values under "fixed values" have to equal the platform's for results to
agree; they are data, listed plainly.
"""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(20, 8)
QUANTITY = T.DecimalType(38, 18)

# --- fixed values: quality gate -------------------------------------------------
REQUIRED_FIELDS = ["symbol", "timestamp", "price", "volume", "side", "trade_id", "source"]
TRADE_SIDES = ["buy", "sell"]
TRADE_SOURCES = ["bybit", "binance", "coinbase"]
MIN_PRICE, MAX_PRICE = 0.00001, 10_000_000.0
MIN_VOLUME, MAX_VOLUME = 0.000001, 1_000_000.0
MAX_AGE_SECONDS = 300
MAX_SKEW_SECONDS = 10
MAX_DEVIATION = 0.50
ACCURACY_WINDOW, ACCURACY_MIN_HISTORY = 100, 10
QUALITY_DIMENSIONS = ["completeness", "validity", "consistency", "timeliness", "accuracy"]

# --- fixed values: wire defaults -------------------------------------------------
DEFAULT_SYMBOL = "BTCUSDT"
DEFAULT_SOURCE = "bybit"
DEFAULT_EXCHANGE = "BINANCE"

# --- fixed values: request limits ------------------------------------------------
INTERVALS = {"1m": "1 minute", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour"}
DEFAULT_INTERVAL = "1h"
SYMBOL_PATTERN = "^[A-Z0-9]{2,20}$"
MAX_BARS = 1000
DEFAULT_HORIZON, MAX_HORIZON = 60, 1440  # minutes

# --- fixed values: order requests ------------------------------------------------
ORDER_SYMBOL_PATTERN = "^[A-Z]{2,10}USDT$"
UUID_PATTERN = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
REQUEST_TYPES = ["market", "limit", "stop", "stop_limit"]
PRICED_TYPES = ["limit", "stop_limit"]
REQUEST_EXCHANGES = ["BINANCE", "BYBIT", "COINBASE"]
MAX_ORDER_QUANTITY = 1000

# Texts of refused requests.
REQUEST_MESSAGES = {
    "portfolio_id required": "portfolio_id is required",
    "portfolio_id format": "portfolio_id must be a valid UUID",
    "symbol required": "symbol is required",
    "symbol format": "symbol must be in format XXXUSDT (e.g., BTCUSDT)",
    "type allowed": "type must be one of: market, limit, stop, stop_limit",
    "side allowed": "side must be either buy or sell",
    "quantity required": "quantity is required",
    "quantity positive": "quantity must be positive",
    "quantity maximum": "quantity cannot exceed 1000",
    "price required": "price is required for limit orders",
    "price positive": "price must be positive",
}
NOT_OWNED = "Portfolio not found or access denied"
NO_EXCHANGE = "Exchange not found"
BAD_QUANTITY = "Quantity must be positive"
BAD_OPERATION = 'Operation must be "add" or "subtract"'

# --- fixed values: model ---------------------------------------------------------
FEATURES = [
    "high", "sma_20", "sma_50", "sma_200", "bb_middle", "bb_upper",
    "volatility_10d", "volatility_14d", "macd_12_26", "macd_5_35",
    "macd_signal_5_35", "below_all_sma",
]
SELL_THRESHOLD = 0.852637529373169
SEQUENCE_LENGTH = 7

# --- fixed values: backtest ------------------------------------------------------
STARTING_CASH = 10000.0
SHORT_PERIOD, LONG_PERIOD = 10, 30
PERIODS_PER_YEAR = 250

# --- fixed values: book ----------------------------------------------------------
ORDER_STATUS = [
    "new", "pending", "open", "partially_filled", "filled", "canceled", "rejected", "expired",
]
LIVE_STATUS = ["new", "open"]
# The order service's names of statuses and the platform's, where they differ.
PLATFORM_STATUS = {"pending": "new", "expired": "canceled"}
# What an event makes of an order, and the statuses it may come from; None before there is an order.
ORDER_TRANSITIONS = {
    "order.created": ("pending", [None]),
    "order.submitted": ("open", ["pending"]),
    "order.partially_filled": ("partially_filled", ["pending", "open", "partially_filled"]),
    "order.filled": ("filled", ["pending", "open", "partially_filled"]),
    "order.canceled": ("canceled", ["pending", "open", "partially_filled"]),
    "order.rejected": ("rejected", ["pending", "open"]),
    "order.expired": ("expired", ["pending", "open", "partially_filled"]),
}
ORDER_TYPES = ["market", "limit", "stop", "stop_limit", "stop_loss"]
TRANSACTION_TYPES = ["trade", "deposit", "withdrawal", "fee", "transfer"]
STABLECOINS = ["USDT", "USDC", "USD"]
EVENT_TYPES = [
    "user.created", "user.updated", "user.login", "user.deleted",
    "portfolio.created", "portfolio.updated",
    "balance.updated", "balance.locked", "balance.unlocked",
    "order.created", "order.submitted", "order.filled", "order.partially_filled",
    "order.canceled", "order.rejected", "order.expired",
    "transaction.created", "transaction.completed", "transaction.failed", "transaction.reversed",
]


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


# Wire record: both the canonical and the raw exchange keys, all as text, so a
# malformed value is a null after try_cast instead of a lost record.
WIRE_TRADE = _struct(
    symbol=T.StringType(), timestamp=T.StringType(), price=T.StringType(), volume=T.StringType(),
    side=T.StringType(), trade_id=T.StringType(), source=T.StringType(),
    T=T.StringType(), p=T.StringType(), v=T.StringType(), S=T.StringType(), i=T.StringType(),
)

CANONICAL_TRADE = _struct(
    symbol=T.StringType(), timestamp=T.TimestampType(), price=T.DoubleType(), volume=T.DoubleType(),
    side=T.StringType(), trade_id=T.StringType(), source=T.StringType(),
    processing_time=T.TimestampType(), date_partition=T.DateType(),
)

BRONZE_TRADE = _struct(
    symbol=T.StringType(), timestamp=T.TimestampNTZType(), price=T.DoubleType(), volume=T.DoubleType(),
    side=T.StringType(), trade_id=T.StringType(), source=T.StringType(),
    processing_time=T.TimestampNTZType(), date_partition=T.DateType(),
)

CANDLE = _struct(
    symbol=T.StringType(), open_time=T.TimestampType(), open=T.DoubleType(), high=T.DoubleType(),
    low=T.DoubleType(), close=T.DoubleType(), volume=T.DoubleType(), close_time=T.TimestampType(),
    trades_count=T.LongType(),
)

KLINE_FRAME = T.StructType([
    T.StructField("k", _struct(
        t=T.LongType(), s=T.StringType(), i=T.StringType(), o=T.StringType(), h=T.StringType(),
        l=T.StringType(), c=T.StringType(), x=T.BooleanType(),
    )),
])
