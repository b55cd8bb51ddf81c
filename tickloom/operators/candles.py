"""Trades to candles, candle rollups, latest prices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import bucket_start, micros, span_micros

ROLLUPS = {"5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour"}


#: More than twice the range of a long: times this far apart order events whatever their ids.
_STEP = 10**20

_AT, _TURN, _SIDE = "_event_at", "_event_turn", "_event_side"


def is_whole(rows: DataFrame, column: str) -> bool:
    return isinstance(rows.schema[column].dataType, T.IntegralType)


def event_offset(stamp: str, span: str) -> Column:
    """Microseconds since the start of the bucket, which order the events of one bucket."""
    return F.pmod(micros(stamp), F.lit(span_micros(span)))


def id_order(tiebreak: str) -> Column:
    """Orders ids: whole numbers of any length by value, then other texts by their bytes, then null.

    A number with a sign, white space or leading zeros is a text.
    """
    return F.struct(*_id_parts(F.col(tiebreak).cast("string")))


def _id_parts(text: Column) -> list[Column]:
    whole = F.coalesce(text.rlike("^(0|[1-9][0-9]*)$"), F.lit(False))
    kind = F.when(text.isNull(), 2).when(whole, 0).otherwise(1)
    return [kind, F.when(whole, F.length(text)).otherwise(0), text]


def id_turn(number: str | None) -> tuple[int, int, str]:
    """``id_order`` of one id, within tasks."""
    if number is None:
        return 2, 0, ""
    whole = number.isascii() and number.isdigit() and (number == "0" or number[0] != "0")
    return 0 if whole else 1, len(number) if whole else 0, number


def event_order(rows: DataFrame, at: Column, tiebreak: str) -> Column:
    """Orders events by (time, id), for ``min_by`` and ``max_by``.  ``at`` is a long.

    ``ordered_ends`` is the cheaper form for batches: Spark sorts the rows for a key that is a struct.
    """
    return _ranked(at, F.col(tiebreak)) if is_whole(rows, tiebreak) else F.struct(at, id_order(tiebreak))


def _ranked(at: Column, number: Column) -> Column:
    """A decimal that orders by (time, number), a null number last."""
    scaled = at.cast("decimal(17,0)") * F.lit(str(_STEP)).cast("decimal(21,0)")
    code = F.coalesce(number.cast("decimal(20,0)"), F.lit(str(10**19)).cast("decimal(20,0)"))
    return (scaled + code).cast("decimal(38,0)")


def _named_ends(named: DataFrame, keys: list[str], tiebreak: str, first: dict, last: dict) -> DataFrame:
    """First and last event of each group, by whole ids; Spark keeps one row a group and side before the shuffle."""
    kind, size, text = _id_parts(F.col(tiebreak).cast("string"))
    code = F.hex(F.coalesce(text, F.lit("")).cast("binary"))
    # Digits turned round and an end mark above them all reverse the order of texts.
    turned = F.concat(F.translate(code, "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    order = ["_by_time", "_by_kind", "_by_size", "_by_text"]
    sides = [
        F.struct(F.lit(side).alias(_SIDE), *[c.alias(n) for n, c in zip(order, by)])
        for side, by in enumerate([(F.col(_AT), kind, size, code), (-F.col(_AT), -kind, -size, turned)])
    ]
    values = list(dict.fromkeys([*first.values(), *last.values()]))
    both = named.select(*keys, _AT, *values, F.explode(F.array(*sides)).alias("_both"))
    turn = F.row_number().over(Window.partitionBy(*keys, _SIDE).orderBy(*order))
    ends = both.select(*keys, _AT, *values, "_both.*").withColumn("_place", turn).where("_place = 1")

    def of(side: int, column: str) -> Column:
        return F.max(F.when(F.col(_SIDE) == side, F.col(column)))

    return ends.groupBy(*keys).agg(
        of(0, _AT).alias("_named_from"), of(1, _AT).alias("_named_to"),
        *[of(0, v).alias(f"_named_{n}") for n, v in first.items()],
        *[of(1, v).alias(f"_named_{n}") for n, v in last.items()],
    )


def ordered_ends(
    rows: DataFrame, keys: list[str], at: Column, tiebreak: str | None, first: dict[str, str], last: dict[str, str],
    others: tuple[Column, ...] = (),
) -> DataFrame:
    """Groups of rows with values of their first and last event and other aggregates.

    Events are ordered by the long ``at``, those of one instant by ``tiebreak`` as in ``id_order``.  ``first`` and
    ``last`` map output names to columns.  Keys are not null.

    Ids that are longs or read like them make a decimal with the time, and a key of fixed width keeps ``min_by`` and
    ``max_by`` in the hash aggregate with map-side combine.  Only rows with other ids are looked at once more, by
    their whole ids, and the ends they give are set against those of the numbers; where there are none, adaptive
    execution drops the join.
    """
    keys, placed = list(keys), rows.withColumn(_AT, at)
    by_number = tiebreak is not None and is_whole(rows, tiebreak)
    if tiebreak is None:
        turn = F.col(_AT)
    elif by_number:
        turn = _ranked(F.col(_AT), F.col(tiebreak))
    else:
        text = F.col(tiebreak).cast("string")
        number = text.try_cast("long")
        turn = F.when((number >= 0) & (number.cast("string") == text), _ranked(F.col(_AT), number))
    ranked = placed.withColumn(_TURN, turn)
    ends = [F.min_by(v, _TURN).alias(n) for n, v in first.items()] + [F.max_by(v, _TURN).alias(n) for n, v in last.items()]
    if tiebreak is None or by_number:
        return ranked.groupBy(*keys).agg(*ends, *others)
    known = F.when(F.col(_TURN).isNotNull(), F.col(_AT))
    numbers = ranked.groupBy(*keys).agg(*ends, F.min(known).alias("_from"), F.max(known).alias("_to"), *others)
    named = _named_ends(ranked.where(F.col(_TURN).isNull()), keys, tiebreak, first, last)
    both = numbers.join(named, keys, "left")
    # At one instant numbers come before other ids.
    opens = F.col("_named_from").isNotNull() & F.coalesce(F.col("_named_from") < F.col("_from"), F.lit(True))
    closes = F.col("_named_to").isNotNull() & F.coalesce(F.col("_named_to") >= F.col("_to"), F.lit(True))
    picked = {n: F.when(opens, F.col(f"_named_{n}")).otherwise(F.col(n)) for n in first}
    picked |= {n: F.when(closes, F.col(f"_named_{n}")).otherwise(F.col(n)) for n in last}
    spent = ["_from", "_to", *[c for c in named.columns if c not in keys]]
    return both.withColumns(picked).drop(*spent)


def first_by(value: str, rank: Column) -> Column:
    """Value of the first row of the group."""
    return F.min_by(value, rank)


def last_by(value: str, rank: Column) -> Column:
    """Value of the last row of the group."""
    return F.max_by(value, rank)


def close_time(open_time: Column, span: str, inclusive: bool) -> Column:
    end = micros(open_time) + F.lit(span_micros(span))
    return F.timestamp_micros(end - 1 if inclusive else end)


def trade_candles(
    trades: DataFrame,
    span: str = "1 minute",
    keys: tuple[str, ...] = ("symbol",),
    stamp: str = "timestamp",
    tiebreak: str = "trade_id",
    as_of: Column | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """A1: trades to candles, in event-time order.

    With ``as_of`` only the buckets that ended by then are returned; without it
    all of them (the forced flush).
    """
    bucketed = trades.withColumn("open_time", bucket_start(stamp, span))
    if as_of is not None:
        # On the input, so that no unfinished bucket is shuffled.
        bucketed = bucketed.filter(F.col("open_time") < bucket_start(as_of, span))
    grouped = ordered_ends(
        bucketed, [*keys, "open_time"], event_offset(stamp, span), tiebreak, {"open": "price"}, {"close": "price"},
        (
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.sum("volume").alias("volume"),
            F.count(F.lit(1)).alias("trades_count"),
        ),
    )
    return grouped.select(
        *keys, "open_time", "open", "high", "low", "close", "volume",
        close_time(F.col("open_time"), span, inclusive).alias("close_time"),
        "trades_count",
    )


def rollup_candles(
    candles: DataFrame,
    span: str,
    keys: tuple[str, ...] = ("symbol",),
    open_time: str = "open_time",
    tiebreak: str | None = None,
    inclusive: bool = False,
) -> DataFrame:
    """A2-A5: candles to longer candles.

    ``trades_count`` sums the trades, ``candles_count`` counts the input
    candles; the platform's views report the second under the first's name.
    With several exchanges merged under one symbol, pass the exchange id column
    as ``tiebreak``.
    """
    bucketed = candles.withColumn("_bucket", bucket_start(open_time, span))
    has_trades = "trades_count" in candles.columns
    trades = F.sum("trades_count") if has_trades else F.count(F.lit(1))
    grouped = ordered_ends(
        bucketed, [*keys, "_bucket"], event_offset(open_time, span), tiebreak, {"open": "open"}, {"close": "close"},
        (
            F.min(open_time).alias("first_ts"),
            F.max("high").alias("high"),
            F.min("low").alias("low"),
            F.sum("volume").alias("volume"),
            trades.cast("long").alias("trades_count"),
            F.count(F.lit(1)).alias("candles_count"),
        ),
    )
    return grouped.select(
        *keys, F.col("_bucket").alias("open_time"), "first_ts", "open", "high", "low", "close", "volume",
        close_time(F.col("_bucket"), span, inclusive).alias("close_time"),
        "trades_count", "candles_count",
    )


def latest_price(
    trades: DataFrame, keys: tuple[str, ...] = ("symbol",), stamp: str = "timestamp", tiebreak: str = "trade_id"
) -> DataFrame:
    """Last price and its time per symbol, the greatest id deciding between trades of one instant."""
    at = F.unix_micros(F.col(stamp).cast("timestamp"))
    return ordered_ends(trades, list(keys), at, tiebreak, {}, {"price": "price"}, (F.max(stamp).alias("price_time"),))
