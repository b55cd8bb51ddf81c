"""Technical indicators over whole candle series, all symbols at once.

Each function takes candles and returns them with columns added.  The series are
cut into blocks (see ``series``); no task ever holds a whole symbol.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.operators.series import BLOCK, CANDLE_CHUNK, LEAD, ROW, Blocks, index_rows, numbered, slice_rows

# Running sums inside a block carry factors up to decay**-size; this keeps them
# far from the end of the double range.
_MAX_EXPONENT = 500.0
_MAX_EMA_BLOCK = 1024
# Blocks whose carries are folded together; spans of so many blocks are folded on.
_SPAN_BLOCKS = 128

KEYS = ["symbol"]
ORDER = ["open_time"]


# --- bounded frames --------------------------------------------------------------


def sma(blocks: Blocks, value: str, period: int) -> Column:
    """Mean of the last ``period`` values; null before there are that many."""
    return F.when(F.col(ROW) >= period, F.avg(value).over(blocks.frame(1 - period, 0)))


def spread(blocks: Blocks, value: str, period: int) -> Column:
    return F.when(F.col(ROW) >= period, F.stddev_pop(value).over(blocks.frame(1 - period, 0)))


def simple_return(blocks: Blocks, value: str) -> Column:
    """Relative change to the row before; null on the first row or after 0."""
    before = F.lag(value).over(blocks.ordered())
    return F.when(before != 0, (F.col(value) - before) / before)


def volatility(blocks: Blocks, returns: str, period: int) -> Column:
    """Population deviation of the last ``period`` returns, times sqrt(period);
    0 while there are fewer than ``period`` of them."""
    deviation = F.stddev_pop(returns).over(blocks.frame(1 - period, 0))
    return F.when(F.col(ROW) <= period, F.lit(0.0)).otherwise(deviation * math.sqrt(period))


def strength_index(gain: Column, loss: Column) -> Column:
    """RSI from the mean gain and mean loss; 100 when nothing was lost."""
    return F.when(loss == 0, F.lit(100.0)).otherwise(100 - 100 / (1 + gain / F.nullif(loss, F.lit(0.0))))


def with_sma(df: DataFrame, periods: list[int], value: str = "close", keys=KEYS, order=ORDER, span=CANDLE_CHUNK):
    blocks = Blocks.cut(index_rows(df, keys, order, span), keys, max(periods) - 1)
    return blocks.add({f"sma_{p}": sma(blocks, value, p) for p in periods}).rows().drop(ROW)


def with_bollinger(
    df: DataFrame, period: int = 20, width: float = 2.0, value: str = "close", keys=KEYS, order=ORDER, span=CANDLE_CHUNK
) -> DataFrame:
    """Mean and mean +- ``width`` population deviations."""
    blocks = Blocks.cut(index_rows(df, keys, order, span), keys, period - 1)
    return bollinger(blocks, value, period, width).rows().drop(ROW)


def bollinger(blocks: Blocks, value: str, period: int = 20, width: float = 2.0) -> Blocks:
    middle, deviation = sma(blocks, value, period), spread(blocks, value, period)
    return blocks.add(
        {"bb_middle": middle, "bb_upper": middle + deviation * width, "bb_lower": middle - deviation * width}
    )


def with_returns(df: DataFrame, value: str = "close", keys=KEYS, order=ORDER, span=CANDLE_CHUNK) -> DataFrame:
    blocks = Blocks.cut(index_rows(df, keys, order, span), keys, 1)
    return blocks.add({"simple_return": simple_return(blocks, value)}).rows().drop(ROW)


def with_volatility(df: DataFrame, periods: list[int], value: str = "close", keys=KEYS, order=ORDER, span=CANDLE_CHUNK):
    # The oldest return of a frame needs the row before it too.
    blocks = Blocks.cut(index_rows(df, keys, order, span), keys, max(periods))
    blocks = blocks.add({"_return": simple_return(blocks, value)})
    return blocks.add({f"volatility_{p}": volatility(blocks, "_return", p) for p in periods}).rows().drop(ROW, "_return")


def with_rsi(
    df: DataFrame, period: int = 14, value: str = "close", keys=KEYS, order=ORDER, span=CANDLE_CHUNK
) -> DataFrame:
    """W3 over the last ``period`` differences of every row; 50 before there are that many."""
    blocks = Blocks.cut(index_rows(df, keys, order, span), keys, period)
    change = F.col(value) - F.lag(value).over(blocks.ordered())
    blocks = blocks.add({"_gain": F.greatest(change, F.lit(0.0)), "_loss": F.greatest(-change, F.lit(0.0))})
    recent = blocks.frame(1 - period, 0)
    rolling = strength_index(F.avg("_gain").over(recent), F.avg("_loss").over(recent))
    blocks = blocks.add({"rsi": F.when(F.col(ROW) <= period, F.lit(50.0)).otherwise(rolling)})
    return blocks.rows().drop(ROW, "_gain", "_loss")


def first_rsi(
    df: DataFrame, period: int = 14, value: str = "close", keys=KEYS, order=ORDER
) -> DataFrame:
    """W3 as the platform reports it: one number per symbol, from the first
    ``period`` differences only; 50 when there are fewer."""
    head = slice_rows(df, keys, order, period + 1, side="oldest")
    series = Window.partitionBy(*keys).orderBy(ROW)
    change = F.col(value) - F.lag(value).over(series)
    diffs = head.select(*keys, change.alias("_change"))
    return diffs.groupBy(*keys).agg(_rsi_of(period).alias("rsi"))


def _rsi_of(period: int) -> Column:
    gain = F.avg(F.greatest(F.col("_change"), F.lit(0.0)))
    loss = F.avg(F.greatest(-F.col("_change"), F.lit(0.0)))
    return F.when(F.count("_change") < period, F.lit(50.0)).otherwise(strength_index(gain, loss))


# --- exponential averages --------------------------------------------------------
#
# An EMA is e[t] = k*x[t] + (1-k)*e[t-1], started as if e[-1] were x[0].  Inside a
# block the part that stems from the block's own rows is a running sum; what
# stems from earlier blocks is the EMA at the end of the block before, decayed.
# Those block-end values follow the same recurrence over one row per block, and
# are scanned in two levels: inside spans of blocks, and over the spans.


@dataclass(frozen=True)
class Macd:
    """A fast and a slow EMA, their difference, and its signal EMA."""

    name: str
    fast: int
    slow: int
    signal: int


def _gain(period: int) -> float:
    return 2.0 / (period + 1)


def _decay(period: int) -> float:
    return 1.0 - _gain(period)


def _block_rows(periods: list[int]) -> int:
    size = _MAX_EMA_BLOCK
    for period in periods:
        if period < 2:
            raise ValueError("an EMA period is at least 2")
        while size * -math.log(_decay(period)) > _MAX_EXPONENT:
            size //= 2
    return size


def _power(base: float, exponent: Column) -> Column:
    return F.pow(F.lit(base), exponent)


def _geometric(a: float, b: float, n: Column | int) -> Column:
    """Sum of a**i * b**(n-1-i) for i in 0..n-1."""
    n = F.lit(n) if isinstance(n, int) else n
    if math.isclose(a, b, rel_tol=1e-12):
        return n * _power(a, n - 1)
    return (_power(a, n) - _power(b, n)) / (a - b)


def _block_carries(
    indexed: DataFrame, keys: list[str], value: str, emas: list[int], macds: list[Macd], size: int
) -> DataFrame:
    """One row per block: every average as it stood at the end of the block before.

    A block's own contribution is a weighted sum, so this is one hash aggregate
    over the indexed rows with map-side combine.
    """
    x = F.col(value)
    block = F.floor((F.col(ROW) - 1) / F.lit(size)).cast("long")
    left = size - 1 - F.pmod(F.col(ROW) - 1, F.lit(size))  # rows after this one in its block

    def own(period: int) -> Column:
        return _gain(period) * _power(_decay(period), left)

    sums = {f"_s{p}": F.sum(x * own(p)) for p in emas}
    for m in macds:
        g = _decay(m.signal)

        def share(period: int) -> Column:
            return _gain(m.signal) * _gain(period) * _geometric(_decay(period), g, left + 1)

        sums[f"_g_{m.name}"] = F.sum(x * (share(m.fast) - share(m.slow)))

    summary = indexed.groupBy(*keys, block.alias(BLOCK)).agg(
        F.min_by(value, ROW).alias("_first"), *[column.alias(name) for name, column in sums.items()]
    )
    states = [f"_s{p}" for p in emas] + [f"_g_{m.name}" for m in macds]
    nothing = F.struct(*[F.lit(0.0).alias(name) for name in states])

    def passed_on(rows: int):
        """What the averages are ``rows`` rows later, given what these rows add by themselves."""

        def step(state: Column, piece: Column) -> Column:
            nxt = [(state[f"_s{p}"] * (_decay(p) ** rows) + piece[f"_s{p}"]).alias(f"_s{p}") for p in emas]
            for m in macds:
                g = _decay(m.signal)

                def passed(period: int) -> Column:
                    # What a carried average adds to the signal while it decays.
                    return state[f"_s{period}"] * _gain(m.signal) * _decay(period) * _geometric(_decay(period), g, rows)

                signal = state[f"_g_{m.name}"] * (g**rows) + passed(m.fast) - passed(m.slow) + piece[f"_g_{m.name}"]
                nxt.append(signal.alias(f"_g_{m.name}"))
            return F.struct(*nxt)

        return step

    piece = F.struct(BLOCK, *states)
    spans = summary.withColumn("_span", F.floor(F.col(BLOCK) / F.lit(_SPAN_BLOCKS)).cast("long"))
    # A span that others come after is full, so all of them decay alike.
    ends = spans.groupBy(*keys, "_span").agg(
        F.min_by("_first", BLOCK).alias("_first"),
        F.aggregate(F.sort_array(F.collect_list(piece)), nothing, passed_on(size)).alias("_sums"),
    )
    by_span = Window.partitionBy(*keys).orderBy("_span")
    start = F.first("_first").over(by_span.rowsBetween(Window.unboundedPreceding, 0))
    seed = F.struct(*[start.alias(f"_s{p}") for p in emas], *[F.lit(0.0).alias(f"_g_{m.name}") for m in macds])
    earlier = F.collect_list("_sums").over(by_span.rowsBetween(Window.unboundedPreceding, -1))
    begins = ends.select(
        *keys, "_span", F.aggregate(earlier, seed, passed_on(size * _SPAN_BLOCKS)).alias("_begin")
    )
    inside = Window.partitionBy(*keys, "_span").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    listed = spans.withColumn("_pieces", F.collect_list(piece).over(inside)).join(begins, [*keys, "_span"])
    carried = F.aggregate("_pieces", F.col("_begin"), passed_on(size))
    return listed.select(*keys, BLOCK, carried.alias("_carry"))


def _scan(blocks: Blocks, value: Column, period: int, carry: Column) -> Column:
    """EMA inside a block, given the EMA at the end of the block before."""
    decay, place = _decay(period), blocks.place()
    weighted = F.when(~F.col(LEAD), value * _gain(period) * _power(decay, -place))
    own = F.sum(weighted).over(blocks.upto()) * _power(decay, place)
    # The first value of a series is its own average, to the last bit.
    return F.when(F.col(ROW) == 1, value).otherwise(own + carry * _power(decay, place + 1))


def ema_blocks(
    indexed: DataFrame,
    keys: list[str],
    value: str,
    emas: dict[str, int] | None = None,
    macds: list[Macd] | None = None,
    lookback: int = 0,
) -> Blocks:
    """Blocks with the requested averages as columns.

    ``emas`` maps column names to periods.  A ``Macd`` adds ``<name>``,
    ``<name>_signal`` and ``<name>_histogram``.  The columns are defined on the
    blocks' own rows only, not on context rows.
    """
    emas, macds = emas or {}, macds or []
    lines = sorted({*emas.values(), *[p for m in macds for p in (m.fast, m.slow)]})
    size = max(_block_rows(lines + [m.signal for m in macds]), lookback)
    if size != _block_rows(lines + [m.signal for m in macds]):
        raise ValueError(f"lookback {lookback} is longer than an EMA block")
    carries = _block_carries(indexed, keys, value, lines, macds, size)
    blocks = Blocks.cut(indexed, keys, lookback, size)
    # Left: the block past the end of a series holds context rows only.
    blocks = Blocks(blocks.df.join(carries, [*keys, BLOCK], "left"), keys, size)
    x = F.col(value)
    blocks = blocks.add({f"_e{p}": _scan(blocks, x, p, F.col(f"_carry._s{p}")) for p in lines})
    if macds:
        blocks = blocks.add({m.name: F.col(f"_e{m.fast}") - F.col(f"_e{m.slow}") for m in macds})
        blocks = blocks.add(
            {
                f"{m.name}_signal": _scan(blocks, F.col(m.name), m.signal, F.col(f"_carry._g_{m.name}"))
                for m in macds
            }
        )
        blocks = blocks.add({f"{m.name}_histogram": F.col(m.name) - F.col(f"{m.name}_signal") for m in macds})
    df = blocks.df.withColumns({name: F.col(f"_e{p}") for name, p in emas.items()})
    return Blocks(df.drop("_carry", *[f"_e{p}" for p in lines]), keys, size)


def with_ema(
    df: DataFrame, periods: list[int], value: str = "close", keys=KEYS, order=ORDER, span=CANDLE_CHUNK
) -> DataFrame:
    """EMA columns ``ema_<period>`` over the whole series, seeded by its first value."""
    indexed = index_rows(df, keys, order, span)
    return ema_blocks(indexed, keys, value, {f"ema_{p}": p for p in periods}).rows().drop(ROW)


def with_macd(
    df: DataFrame, macds: list[Macd] | None = None, value: str = "close", keys=KEYS, order=ORDER, span=CANDLE_CHUNK
) -> DataFrame:
    """MACD line, signal and histogram over the whole series."""
    macds = macds or [Macd("macd", 12, 26, 9)]
    indexed = index_rows(df, keys, order, span)
    return ema_blocks(indexed, keys, value, macds=macds).rows().drop(ROW)


# --- feature rows ------------------------------------------------------------------


def below_all(price: Column, *averages: Column) -> Column:
    """1 when the price is below every average; 0 when any of them is missing."""
    below = averages[0] > price
    for average in averages[1:]:
        below = below & (average > price)
    return F.coalesce(below, F.lit(False)).cast("int")


def feature_rows(df: DataFrame, keys=KEYS, order=ORDER, span=CANDLE_CHUNK) -> DataFrame:
    """The feature columns on every candle of every series.

    One shuffle to number the rows, one by block; every window below runs on the
    blocks as they are.
    """
    needed = df.select(*keys, *order, F.col("high"), F.col("close"))
    indexed = index_rows(needed, keys, order, span)
    blocks = ema_blocks(
        indexed, keys, "close", macds=[Macd("macd_12_26", 12, 26, 9), Macd("macd_5_35", 5, 35, 5)], lookback=199
    )
    blocks = blocks.add({"_return": simple_return(blocks, "close")})
    blocks = bollinger(blocks, "close", 20)
    blocks = blocks.add(
        {
            "sma_20": F.col("bb_middle"),
            "sma_50": sma(blocks, "close", 50),
            "sma_200": sma(blocks, "close", 200),
            "volatility_10d": volatility(blocks, "_return", 10),
            "volatility_14d": volatility(blocks, "_return", 14),
        }
    )
    out = blocks.rows().withColumn(
        "below_all_sma", below_all(F.col("close"), F.col("sma_20"), F.col("sma_50"), F.col("sma_200"))
    )
    return out.select(
        *keys, *order, "high", "sma_20", "sma_50", "sma_200", "bb_middle", "bb_upper", "bb_lower",
        "volatility_10d", "volatility_14d", "macd_12_26", "macd_5_35",
        F.col("macd_5_35_signal").alias("macd_signal_5_35"), "below_all_sma",
        F.col("close").alias("price"), F.col(ROW).alias("data_points"),
    )


def latest_features(df: DataFrame, n: int = 200, side: str = "newest", keys=KEYS, order=ORDER) -> DataFrame:
    """W9 as one row per symbol, from the newest (or, as the platform does, the
    oldest) ``n`` candles."""
    rows = feature_rows(slice_rows(df, keys, order, n, side).drop(ROW), keys, order)
    return last_row(rows, keys, "data_points")


def last_row(df: DataFrame, keys: list[str], rank: str) -> DataFrame:
    """The row with the highest rank of each series."""
    ranked = Window.partitionBy(*keys).orderBy(F.col(rank).desc())
    return df.withColumn("_last", F.row_number().over(ranked)).filter("_last = 1").drop("_last")


def indicator_summary(
    df: DataFrame,
    sma_period: int = 20,
    ema_period: int = 12,
    rsi_period: int = 14,
    n: int = 200,
    side: str = "newest",
    keys=KEYS,
    order=ORDER,
) -> DataFrame:
    """One row per symbol with the last SMA, EMA, MACD and the RSI of a slice
    of at most ``n`` candles.  The slice bounds every group below."""
    part = slice_rows(df.select(*keys, *order, "close"), keys, order, n, side)
    # `indexed` already: slice_rows numbers its rows.
    blocks = ema_blocks(part, keys, "close", {"ema": ema_period}, [Macd("macd", 12, 26, 9)], lookback=sma_period - 1)
    rows = blocks.add({"sma": sma(blocks, "close", sma_period)}).rows()
    newest = last_row(rows, keys, ROW).select(
        *keys,
        F.col("close").alias("current_price"),
        "sma",
        "ema",
        F.struct(
            F.col("macd").alias("macd"),
            F.col("macd_signal").alias("signal"),
            F.col("macd_histogram").alias("histogram"),
        ).alias("macd"),
        F.col(ROW).alias("data_points"),
    )
    rsi = first_rsi(part.drop(ROW), rsi_period, "close", keys, order)
    return newest.join(rsi, keys)


def feature_sequences(
    features: DataFrame, names: list[str], n: int, valid: Column | None = None, keys=KEYS, order=ORDER,
    span=CANDLE_CHUNK, row: str | None = None,
) -> DataFrame:
    """The last ``n`` feature rows of every row, oldest first; only full
    sequences, and with ``valid`` only those whose every step satisfies it."""
    blocks = Blocks.cut(numbered(features, keys, order, span, row), keys, n - 1)
    window = blocks.frame(1 - n, 0)
    usable = F.lit(True) if valid is None else valid
    blocks = blocks.add({"_step": F.struct(*names), "_ok": usable})
    blocks = blocks.add({"sequence": F.collect_list("_step").over(window), "_all": F.min("_ok").over(window)})
    return blocks.rows().filter((F.size("sequence") == n) & F.col("_all")).drop(ROW, "_step", "_ok", "_all")
