"""Moving-average crossover report per symbol.

Everything runs over whole series, in blocks; ``bars`` takes the newest ones
where that is asked for.  The limit of 1000 bars is one of requests
(``functions/params.py``), not of these operators.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.series import CANDLE_CHUNK, ROW, Blocks, index_rows, running_rows, slice_rows
from tickloom.schemas import LONG_PERIOD, PERIODS_PER_YEAR, SHORT_PERIOD, STARTING_CASH
from tickloom.sources.staging import stage

KEYS = ["symbol"]
ORDER = ["open_time"]


def _crossing(frame, value: str, short: int, long: int) -> dict[str, Column]:
    """Averages of the bars before the current one, once there are ``long`` of them."""
    ready = F.col(ROW) > long
    fast = F.when(ready, F.avg(value).over(frame(-short, -1)))
    slow = F.when(ready, F.avg(value).over(frame(-long, -1)))
    return {"sma_short": fast, "sma_long": slow, "direction": F.signum(fast - slow)}


def crossover_signals(
    candles: DataFrame, short: int = SHORT_PERIOD, long: int = LONG_PERIOD, value: str = "close",
    keys=KEYS, order=ORDER, span: str = CANDLE_CHUNK,
) -> DataFrame:
    """W12 over whole series: both averages and their order (1, 0, -1; null before)."""
    blocks = Blocks.cut(index_rows(candles, keys, order, span), keys, long)
    return blocks.add(_crossing(blocks.frame, value, short, long)).rows().drop(ROW)


def _series(candles: DataFrame, bars: int | None, keys, order, span: str) -> DataFrame:
    """Numbered rows: the newest ``bars`` of every series, or all."""
    return index_rows(candles, keys, order, span) if bars is None else slice_rows(candles, keys, order, bars, span=span)


def backtest_bars(
    candles: DataFrame, bars: int | None = None, short: int = SHORT_PERIOD, long: int = LONG_PERIOD,
    value: str = "close", keys=KEYS, order=ORDER, span: str = CANDLE_CHUNK,
) -> DataFrame:
    """The candles (the newest ``bars`` if given) with the action taken on each: buy, sell or null.

    The position after a bar is the sign of the last bar whose averages differed,
    so a buy is a change to +1 and a sell a change from +1 to -1.
    """
    part = _series(candles.select(*keys, *order, value), bars, keys, order, span)
    blocks = Blocks.cut(part, keys, long)
    marked = blocks.add(_crossing(blocks.frame, value, short, long)).rows()
    sign = F.when(F.col("direction") != 0, F.col("direction"))
    signed = running_rows(marked.withColumn("_sign", sign), keys, {"_before": ("last", "_sign")}, end=-1)
    held = F.coalesce(F.col("_before") > 0, F.lit(False))
    action = F.when((F.col("_sign") > 0) & ~held, "buy").when((F.col("_sign") < 0) & held, "sell")
    return signed.withColumn("action", action).drop("_sign", "_before")


def round_trips(bars: DataFrame, value: str = "close", keys=KEYS, order=ORDER) -> DataFrame:
    """Every buy with the sell that follows it; no sell for an open position.

    ``sell_return`` is the trade's return, ``equity`` the money after the sell and
    ``trip`` the trade's number.
    """
    time = order[0]
    deals = bars.filter(F.col("action").isNotNull()).withColumn("_one", F.lit(1).cast("long"))
    # Actions alternate, starting with a buy, so two of them in a row are a trip.
    numbered = running_rows(deals, keys, {"_deal": ("sum", "_one")})
    bought, sold = F.col("action") == "buy", F.col("action") == "sell"
    trips = numbered.groupBy(*keys, F.floor((F.col("_deal") + 1) / 2).cast("long").alias("trip")).agg(
        F.max(F.when(bought, F.col(ROW))).alias(ROW),
        F.max(F.when(bought, F.col(time))).alias("buy_time"),
        F.max(F.when(bought, F.col(value))).alias("buy_price"),
        F.max(F.when(sold, F.col(time))).alias("sell_time"),
        F.max(F.when(sold, F.col(value))).alias("sell_price"),
    )
    grown = trips.withColumn("_growth", F.col("sell_price") / F.nullif("buy_price", F.lit(0.0)))
    after = running_rows(grown, keys, {"_after": ("product", "_growth")}, row="trip")
    return after.select(
        *keys, ROW, "trip", "buy_time", "buy_price", "sell_time", "sell_price",
        (F.col("_growth") - 1).alias("sell_return"),
        F.when(F.col("sell_time").isNotNull(), F.col("_after") * STARTING_CASH).alias("equity"),
    )


def with_drawdown(trips: DataFrame, keys=KEYS) -> DataFrame:
    """Fall of the equity after each sell below its running peak, in percent."""
    highest = running_rows(trips, keys, {"_highest": ("max", "equity")}, row="trip")
    peak = F.greatest(F.lit(STARTING_CASH), "_highest")
    fall = (peak - F.col("equity")) / peak * 100
    return highest.withColumns({"peak": peak, "drawdown": fall}).drop("_highest")


def sharpe_ratio(returns: str) -> Column:
    """Mean over population deviation of the trade returns, times sqrt(250);
    0 with fewer than two trades or no spread."""
    deviation = F.stddev_pop(returns)
    usable = (F.count(returns) > 1) & (deviation > 0)
    ratio = F.avg(returns) / F.nullif(deviation, F.lit(0.0)) * math.sqrt(PERIODS_PER_YEAR)
    return F.when(usable, ratio).otherwise(F.lit(0.0))


def backtest_report(
    candles: DataFrame,
    bars: int | None = None,
    symbols: DataFrame | None = None,
    value: str = "close",
    keys=KEYS,
    order=ORDER,
    span: str = CANDLE_CHUNK,
) -> DataFrame:
    """One row per symbol, amounts and percentages with two decimals.

    ``symbols`` lists requested symbols; those without candles get zeros.
    """
    # The running passes below read their input twice, so each reads a stored one.
    marked = stage(backtest_bars(candles, bars, value=value, keys=keys, order=order, span=span), "backtest-bars")
    ends = marked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("data_points"), F.max_by(value, ROW).alias("_last_price")
    )
    trips = with_drawdown(stage(round_trips(marked, value, keys, order), "round-trips"), keys)
    deals = trips.groupBy(*keys).agg(
        F.count("sell_time").alias("trades"),
        F.count_if(F.col("sell_return") > 0).alias("winning_trades"),
        F.max_by("equity", F.when(F.col("sell_time").isNotNull(), F.col(ROW))).alias("_closed"),
        F.max(F.when(F.col("sell_time").isNull(), F.col("buy_price"))).alias("_open_price"),
        F.max("drawdown").alias("_drawdown"),
        sharpe_ratio("sell_return").alias("_sharpe"),
    )
    # One row per symbol on both sides.
    both = ends.join(deals, keys, "left")
    if symbols is not None:
        both = symbols.select(*keys).distinct().join(both, keys, "left")
    cash = F.coalesce("_closed", F.lit(STARTING_CASH))
    open_leg = F.coalesce(F.col("_last_price") / F.nullif("_open_price", F.lit(0.0)), F.lit(1.0))
    final = cash * open_leg
    trades = F.coalesce("trades", F.lit(0))
    winners = F.coalesce("winning_trades", F.lit(0))

    def cents(column: Column) -> Column:
        return F.round(F.coalesce(column, F.lit(0.0)), 2)

    return both.select(
        *keys,
        cents((final - STARTING_CASH) / STARTING_CASH * 100).alias("total_return"),
        cents(final - STARTING_CASH).alias("total_return_abs"),
        cents(F.col("_sharpe")).alias("sharpe_ratio"),
        cents(F.col("_drawdown")).alias("max_drawdown"),
        cents(winners / F.nullif(trades, F.lit(0)) * 100).alias("win_rate"),
        trades.alias("trades"),
        winners.alias("winning_trades"),
        (trades - winners).alias("losing_trades"),
        F.coalesce("data_points", F.lit(0)).alias("data_points"),
        cents(final).alias("final_equity"),
    )


def trend(candles: DataFrame, bars: int = 24, value: str = "close", keys=KEYS, order=ORDER) -> DataFrame:
    """Change over the newest 24 hourly candles; up above 2 %, down below -2 %."""
    part = slice_rows(candles.select(*keys, *order, value), keys, order, bars)
    ends = part.groupBy(*keys).agg(
        F.min_by(value, ROW).alias("first_price"), F.max_by(value, ROW).alias("last_price")
    )
    base = F.nullif("first_price", F.lit(0.0))
    change = (F.col("last_price") - base) / base * 100
    return ends.withColumn("change_percent", change).withColumn(
        "trend",
        F.when(F.col("change_percent") > 2, "up").when(F.col("change_percent") < -2, "down").otherwise("flat"),
    )


def ticker(trends: DataFrame) -> DataFrame:
    """Display columns of a 24-hour ticker."""
    price = F.col("last_price")
    return trends.withColumns(
        {
            "shown_price": F.when(price < 1, F.round(price, 4)).otherwise(F.round(price, 2)),
            "shown_change": F.round(F.abs("change_percent"), 2),
            "colour": F.when(F.col("change_percent") >= 0, "green").otherwise("red"),
        }
    )


def day_volume(trades: DataFrame, span: str = "24 hours", stamp: str = "timestamp") -> DataFrame:
    """Volume and quote volume of every symbol in the ``span`` up to its last trade, plain and as shown."""
    at = F.col(stamp).cast("timestamp")
    lasts = trades.groupBy("symbol").agg((F.max(at) - F.expr(f"INTERVAL {span}")).alias("_since"))
    recent = trades.join(lasts, "symbol").where(at > F.col("_since"))
    sums = recent.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("trades"), F.sum("volume").alias("volume"),
        F.sum(F.col("price") * F.col("volume")).alias("quote_volume"),
    )
    return sums.withColumns(
        {"shown_thousands": F.round(F.col("volume") / 1000), "shown_quote_millions": F.round(F.col("quote_volume") / 1_000_000, 1)}
    )


def scaled_series(
    candles: DataFrame, bars: int, value: str = "close", height: float = 20.0, width: float = 60.0,
    keys=KEYS, order=ORDER,
) -> DataFrame:
    """Plot coordinates of the newest ``bars`` values; null when all are equal."""
    part = slice_rows(candles.select(*keys, *order, value), keys, order, bars)
    ends = part.groupBy(*keys).agg(
        F.min(value).alias("_low"), F.max(value).alias("_high"), F.max(ROW).alias("_rows")
    )
    reach = F.nullif(F.col("_high") - F.col("_low"), F.lit(0.0))
    last = F.nullif(F.col("_rows") - 1, F.lit(0))
    return part.join(ends, keys).withColumns(
        {
            "x": F.when(reach.isNotNull(), (F.col(ROW) - 1) / last * width),
            "y": height - (F.col(value) - F.col("_low")) / reach * height,
        }
    ).drop("_low", "_high", "_rows")
