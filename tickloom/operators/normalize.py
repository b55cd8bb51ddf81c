"""Trades from the wire to the canonical nine columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.functions.checks import has_keys, instant, number, raw_trade_ok
from tickloom.schemas import DEFAULT_SOURCE, DEFAULT_SYMBOL, PRICE, QUANTITY

CANONICAL = [
    "symbol", "timestamp", "price", "volume", "side", "trade_id", "source", "processing_time", "date_partition",
]


def topic_symbol(topic: str | Column) -> Column:
    """Text before the first dash, upper case; BTCUSDT without a dash."""
    name = F.col(topic) if isinstance(topic, str) else topic
    return F.when(name.contains("-"), F.upper(F.substring_index(name, "-", 1))).otherwise(DEFAULT_SYMBOL)


def normalise(decoded: DataFrame, processing_time: Column | None = None) -> DataFrame:
    """Both record formats to canonical columns.

    A record with the keys ``timestamp`` and ``side`` is canonical already, any
    other is in the exchange's raw format.  Absent keys get the defaults; a
    value that does not parse becomes null and fails the quality gate.
    """
    now = F.current_timestamp() if processing_time is None else processing_time
    present = F.col("present")
    canonical = has_keys(present, ["timestamp", "side"])

    def given(key: str, value: Column, default) -> Column:
        absent = ~F.coalesce(F.array_contains(present, key), F.lit(False))
        return F.when(absent, F.lit(default)).otherwise(value)

    def pick(own: Column, raw: Column) -> Column:
        return F.when(canonical, own).otherwise(raw)

    r = F.col("record")
    millis = r["T"].try_cast("long")
    raw_time = F.when(F.coalesce(millis, F.lit(0)) == 0, now).otherwise(F.timestamp_millis(millis))
    out = decoded.withColumns(
        {
            "symbol": pick(given("symbol", r["symbol"], DEFAULT_SYMBOL), topic_symbol("topic")),
            "timestamp": pick(instant(r["timestamp"], "ms"), raw_time),
            "price": pick(given("price", number(r["price"]), 0.0), given("p", number(r["p"]), 0.0)),
            "volume": pick(given("volume", number(r["volume"]), 0.0), given("v", number(r["v"]), 0.0)),
            "side": pick(r["side"], F.lower(given("S", r["S"], "unknown"))),
            "trade_id": pick(given("trade_id", r["trade_id"], ""), given("i", r["i"], "")),
            "source": pick(given("source", r["source"], DEFAULT_SOURCE), F.lit(DEFAULT_SOURCE)),
            "processing_time": now,
        }
    ).withColumn("date_partition", F.to_date("timestamp"))
    passed = [c for c in decoded.columns if c not in ("key", "text", "record", "present", "topic")]
    return out.select(*CANONICAL, *passed)


def canonical_from_raw(
    decoded: DataFrame, symbol: str = DEFAULT_SYMBOL, processing_time: Column | None = None
) -> DataFrame:
    """Raw exchange trades that pass P1, in canonical form."""
    now = F.current_timestamp() if processing_time is None else processing_time
    r = F.col("record")
    return (
        decoded.filter(raw_trade_ok())
        .select(
            F.lit(symbol).alias("symbol"),
            F.timestamp_millis(r["T"].cast("long")).alias("timestamp"),
            number(r["p"]).alias("price"),
            number(r["v"]).alias("volume"),
            F.lower(r["S"]).alias("side"),
            F.coalesce(r["i"], r["T"]).alias("trade_id"),
            F.lit(DEFAULT_SOURCE).alias("source"),
            now.alias("processing_time"),
        )
        .withColumn("date_partition", F.to_date("timestamp"))
    )


def raw_rejects(decoded: DataFrame) -> DataFrame:
    """Raw records that fail P1, kept as they came."""
    return decoded.filter(~raw_trade_ok()).select("key", "topic", "text")


def message_key(trade_id: str = "trade_id", stamp: str = "timestamp") -> Column:
    """P5: the trade id, or a hash of the time in 0..999 when there is none."""
    spread = F.pmod(F.xxhash64(F.col(stamp).cast("string")), F.lit(1000)).cast("string")
    return F.when(F.col(trade_id).isNotNull() & (F.col(trade_id) != ""), F.col(trade_id)).otherwise(spread)


def exact_product(price: Column, quantity: Column) -> Column:
    """Price times quantity as decimal(38,18), exact but for digits beyond the eighteenth, which are rounded.

    decimal(20,8) * decimal(38,18) would drop to scale 6, so the quantity is split
    into a whole part and two halves of its fraction, each narrow enough for an
    exact product.  A product too large for the type is an error, not null.
    """
    size = F.abs(quantity)
    one, billion = F.lit(1).cast("decimal(1,0)"), F.lit(10**9).cast("decimal(10,0)")
    whole = F.floor(size).cast("decimal(17,0)")
    # A remainder keeps all digits; a difference of such wide decimals would not.
    scaled = (size % one) * billion
    unit = F.lit("0.000000001").cast("decimal(9,9)")
    high = (F.floor(scaled).cast("decimal(9,0)") * unit).cast("decimal(9,9)")
    low = (scaled % one).cast("decimal(9,9)")
    summand = "decimal(37,18)"
    fine = (price * high).cast(summand) + ((price * low) * unit).cast(summand)
    product = ((price * whole).cast(summand) + fine.cast(summand)).cast(QUANTITY)
    return F.when(quantity < 0, -product).otherwise(product).cast(QUANTITY)


def generated_columns(trades: DataFrame) -> DataFrame:
    """Notional, and the fee once its asset and amount are both known."""
    fee_known = F.col("fee_asset_id").isNotNull() & F.col("fee_amount").isNotNull()
    price, quantity = F.col("price").cast(PRICE), F.col("quantity").cast(QUANTITY)
    return trades.withColumns(
        {
            "notional": exact_product(price, quantity),
            "fee_notional": F.when(fee_known, F.col("fee_amount").cast(QUANTITY)),
        }
    )
