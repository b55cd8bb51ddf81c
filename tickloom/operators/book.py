"""Orders, trades, portfolios and balances with their reference data (J, A8-A11, O).

Joins carry no broadcast hints: reference tables are read from storage, so
Catalyst knows their size and broadcasts them below the session's threshold;
above it adaptive execution splits skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.functions.times import micros, span_micros
from tickloom.operators.series import LIMITED_RANK, index_rows
from tickloom.operators.stacking import stack
from tickloom.schemas import LIVE_STATUS, STABLECOINS


def symbol_candles(candles: DataFrame, symbols: DataFrame) -> DataFrame:
    """Candles keyed by symbol id, named by symbol, as the 1-minute view shows them."""
    named = symbols.select(F.col("id").alias("symbol_id"), "symbol")
    end = F.timestamp_micros(micros("open_ts") + span_micros("1 minute"))
    return candles.join(named, "symbol_id").select(
        "symbol", "exchange_id", F.col("open_ts").alias("open_time"), "open", "high", "low", "close", "volume",
        end.alias("close_time"), F.lit(1).cast("long").alias("trades_count"),
    )


def _named(rows: DataFrame, symbols: DataFrame, exchanges: DataFrame) -> DataFrame:
    names = symbols.select(F.col("id").alias("symbol_id"), "symbol")
    codes = exchanges.select(F.col("id").alias("exchange_id"), F.col("code").alias("exchange"))
    return rows.join(names, "symbol_id").join(codes, "exchange_id")


def order_history(orders: DataFrame, symbols: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Orders with symbol and exchange, all portfolios at once."""
    return _named(orders, symbols, exchanges).select(
        "portfolio_id", "id", "side", "type", "price", "quantity", "status", "created_ts", "updated_ts",
        "external_order_id", "symbol", "exchange",
    )


def trade_history(trades: DataFrame, symbols: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Trades with symbol and exchange."""
    return _named(trades, symbols, exchanges).select(
        "portfolio_id", "id", "side", "price", "quantity", "notional", "fee_amount", "trade_ts",
        "external_trade_id", "order_id", "symbol", "exchange",
    )


def transactions(trades: DataFrame, symbols: DataFrame, exchanges: DataFrame, kind: str | None = None) -> DataFrame:
    """The transaction view of the trades.  Only the type ``trade`` exists;
    any other asks for nothing."""
    rows = _named(trades, symbols, exchanges).select(
        "portfolio_id", F.lit("trade").alias("transaction_type"), "id", "side", "price", "quantity",
        F.col("notional").alias("amount"), "fee_amount", F.col("trade_ts").alias("created_at"), "symbol",
        "exchange", "order_id",
    )
    return rows if kind is None else rows.filter(F.col("transaction_type") == kind)


def executable_orders(
    orders: DataFrame, symbols: DataFrame, portfolios: DataFrame, exchanges: DataFrame, requests: DataFrame
) -> DataFrame:
    """Live orders named by an execution request of their owner.

    ``requests`` has order_id, user_id and execution_price.  An order executes once:
    of several requests of its owner the first one counts, by ``requested_at`` and
    ``request_id`` where the table has them, else the one with the lowest price.
    """
    live = orders.filter(F.col("status").isin(LIVE_STATUS))
    first = F.struct(*[c for c in ("requested_at", "request_id", "execution_price") if c in requests.columns])
    asked = requests.groupBy(F.col("order_id").alias("id"), "user_id").agg(
        F.min_by("execution_price", first).alias("execution_price")
    )
    owners = portfolios.select(F.col("id").alias("portfolio_id"), "user_id")
    pairs = symbols.select(F.col("id").alias("symbol_id"), "symbol", "base_asset_id", "quote_asset_id")
    codes = exchanges.select(F.col("id").alias("exchange_id"), F.col("code").alias("exchange_code"))
    return (
        live.join(asked, "id").join(owners, ["portfolio_id", "user_id"]).join(pairs, "symbol_id").join(codes, "exchange_id")
    )


def portfolio_list(portfolios: DataFrame, assets: DataFrame) -> DataFrame:
    """Portfolios with the code of their base currency."""
    codes = assets.select(F.col("id").alias("base_currency_id"), F.col("code").alias("base_currency_code"))
    return portfolios.join(codes, "base_currency_id").select("id", "user_id", "name", "base_currency_code", "created_at")


def named_balances(balances: DataFrame, assets: DataFrame, held_only: bool = False) -> DataFrame:
    """Balances with asset code and name; with ``held_only`` those above zero."""
    rows = balances.filter(F.col("qty") > 0) if held_only else balances
    names = assets.select(F.col("id").alias("asset_id"), F.col("code").alias("asset_code"), F.col("name").alias("asset_name"))
    return rows.join(names, "asset_id")


def owned(rows: DataFrame, portfolios: DataFrame) -> DataFrame:
    """Rows whose (portfolio_id, user_id) names a portfolio and its owner."""
    owners = portfolios.select(F.col("id").alias("portfolio_id"), "user_id")
    return rows.join(owners, ["portfolio_id", "user_id"], "left_semi")


def symbol_assets(symbols: DataFrame, assets: DataFrame) -> DataFrame:
    """Symbols with the codes of their base and quote assets."""
    base = assets.select(F.col("id").alias("base_asset_id"), F.col("code").alias("base_code"))
    quote = assets.select(F.col("id").alias("quote_asset_id"), F.col("code").alias("quote_code"))
    return symbols.join(base, "base_asset_id").join(quote, "quote_asset_id")


def symbols_from_codes(pairs: DataFrame, assets: DataFrame) -> DataFrame:
    """Symbol rows from (id, symbol, base_code, quote_code), ids looked up by code.

    Pairs of equal assets break the table's rule and are left out.
    """
    base = assets.select(F.col("id").alias("base_asset_id"), F.col("code").alias("base_code"))
    quote = assets.select(F.col("id").alias("quote_asset_id"), F.col("code").alias("quote_code"))
    return (
        pairs.filter(F.col("base_code") != F.col("quote_code"))
        .join(base, "base_code")
        .join(quote, "quote_code")
        .select("id", "symbol", "base_asset_id", "quote_asset_id", F.lit(True).alias("is_active"))
    )


# --- valuation -----------------------------------------------------------------------


def priced_balances(balances: DataFrame, prices: DataFrame) -> DataFrame:
    """Balances by asset code with price and value; stablecoins cost 1, an
    unknown price counts as 0.

    ``prices`` has symbol and price; the asset code is the symbol without USDT.
    Most portfolios hold a stablecoin, so these rows get join keys that match
    nothing and are spread: a shuffled join has no hot key.
    """
    quotes = prices.select(F.regexp_replace("symbol", "USDT", "").alias("_code"), F.col("price").alias("_quote"))
    stable = F.col("asset_code").isin(STABLECOINS)
    spread = F.concat(F.lit("~"), F.pmod(F.xxhash64("portfolio_id"), F.lit(4096)).cast("string"))
    code = F.when(stable, spread).otherwise(F.col("asset_code"))
    joined = balances.withColumn("_code", code).join(quotes, "_code", "left")
    price = F.when(stable, F.lit(1.0)).otherwise(F.coalesce("_quote", F.lit(0.0)))
    return joined.withColumn("price", price).withColumn(
        "value", F.col("price") * F.col("qty").cast("double")
    ).drop("_code", "_quote")


def portfolio_value(priced: DataFrame) -> DataFrame:
    """Total value and number of held assets per portfolio."""
    return priced.groupBy("portfolio_id").agg(
        F.sum("value").alias("total_value"), F.count_if(F.col("qty") > 0).alias("held_assets")
    )


def allocation(priced: DataFrame) -> DataFrame:
    """Each held balance's share of its portfolio's value in percent, with its position, largest value first.

    All shares are 0 where the portfolio is worth nothing.
    """
    whole = Window.partitionBy("portfolio_id")
    order = whole.orderBy(F.col("value").desc(), "asset_code")
    total = F.sum("value").over(whole)
    share = F.when(total > 0, F.col("value") / total * 100).otherwise(F.lit(0.0))
    return priced.filter(F.col("qty") > 0).withColumns({"share": share, "position": F.row_number().over(order)})


def nested_portfolios(portfolios: DataFrame, balances: DataFrame, assets: DataFrame) -> DataFrame:
    """Portfolios with their held balances as an array, empty when there are none.

    A portfolio has one balance per asset, so an array is no longer than the
    asset list.
    """
    held = named_balances(balances, assets, held_only=True)
    lists = held.groupBy(F.col("portfolio_id").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("asset_code", "asset_name", "qty"))).alias("balances")
    )
    kind = "array<struct<asset_code:string,asset_name:string,qty:decimal(38,18)>>"
    return (
        portfolio_list(portfolios, assets)
        .join(lists, "id", "left")
        .withColumn("balances", F.coalesce(F.col("balances").cast(kind), F.array().cast(kind)))
    )


def equity_snapshot(priced: DataFrame, as_of: Column) -> DataFrame:
    """Equity per portfolio at one time."""
    return portfolio_value(priced).select(
        "portfolio_id", as_of.alias("snapshot_ts"), F.col("total_value").alias("equity_base")
    )


def equity_history(balances: DataFrame, prices: DataFrame, start: Column, end: Column, step: str = "1 hour") -> DataFrame:
    """Equity of every portfolio at ``start`` and every ``step`` after it, up to ``end``.

    ``balances`` has portfolio_id, asset_code and qty; ``prices`` symbol, snapshot_ts and price, the price that was known at
    each of these times (``asof.as_of``).  An asset without a price counts nothing, a stablecoin 1.
    """
    times = F.explode(F.sequence(start, end, F.expr(f"INTERVAL {step}")))
    stable = F.col("asset_code").isin(STABLECOINS)
    # Cash needs no price, so it isn't joined; other assets are joined by code and time.
    cash = balances.where(stable).select("portfolio_id", times.alias("snapshot_ts"), F.col("qty").cast("double").alias("value"))
    quotes = prices.select(F.regexp_replace("symbol", "USDT$", "").alias("asset_code"), "snapshot_ts", "price")
    held = balances.where(~stable).select("portfolio_id", "asset_code", "qty", times.alias("snapshot_ts"))
    valued = held.join(quotes, ["asset_code", "snapshot_ts"], "left").select(
        "portfolio_id", "snapshot_ts", (F.col("qty").cast("double") * F.coalesce("price", F.lit(0.0))).alias("value")
    )
    return stack(cash, valued).groupBy("portfolio_id", "snapshot_ts").agg(F.sum("value").alias("equity_base"))


def size_orders(orders: DataFrame, prices: DataFrame, fee_rate: float = 0.001) -> DataFrame:
    """P10: quantity for an amount, amount for a quantity, fee and largest quantity.

    ``orders`` has symbol, side, amount, quantity, quote_qty and base_qty.
    """
    quotes = prices.select("symbol", F.col("price").alias("latest_price"))
    price = F.nullif("latest_price", F.lit(0.0))
    buying = (F.col("side") == "buy") & F.col("amount").isNotNull()
    quantity = F.when(buying, F.round(F.col("amount") / price, 8)).otherwise(F.col("quantity"))
    amount = F.when(buying, F.col("amount")).otherwise(F.round(F.col("quantity") * F.col("latest_price"), 2))
    most = F.when(F.col("side") == "buy", F.col("quote_qty") / price).otherwise(F.col("base_qty"))
    sized = orders.join(quotes, "symbol").withColumns({"_quantity": quantity, "_amount": amount, "max_quantity": most})
    return sized.drop("quantity", "amount").withColumnsRenamed(
        {"_quantity": "quantity", "_amount": "amount"}
    ).withColumn("fee", F.round(F.col("amount") * fee_rate, 2))


# --- order and paging ------------------------------------------------------------------


def page(
    rows: DataFrame, stamp: str, id_column: str = "id", keys=("portfolio_id",), limit: int = 100, offset: int = 0
) -> DataFrame:
    """O2: the newest rows of every portfolio from ``offset`` on, at most ``limit``.

    ``position`` counts from the newest row.  Up to ``LIMITED_RANK`` rows each input
    partition passes on that many per portfolio at most; further pages number the
    rows in two levels, so no task sorts a whole portfolio.
    """
    keys, until = list(keys), offset + limit
    if until > LIMITED_RANK:
        rows = index_rows(rows, keys, [stamp, id_column], span="1 day", name="_row")
        sizes = rows.groupBy(*keys).agg(F.max("_row").alias("_rows"))
        ranked = rows.join(sizes, keys).withColumn("position", (F.col("_rows") - F.col("_row") + 1).cast("int"))
        ranked = ranked.drop("_row", "_rows")
    else:
        newest = Window.partitionBy(*keys).orderBy(F.col(stamp).desc(), F.col(id_column).desc())
        ranked = rows.withColumn("position", F.row_number().over(newest))
    return ranked.filter(F.col("position") <= until).filter(F.col("position") > offset)


def single_page(rows: DataFrame, stamp: str, id_column: str = "id", limit: int = 100, offset: int = 0) -> DataFrame:
    """O2 for one result: newest first."""
    return rows.orderBy(F.col(stamp).desc(), F.col(id_column).desc()).offset(offset).limit(limit)


def sorted_balances(balances: DataFrame, assets: DataFrame) -> DataFrame:
    """The balances of every portfolio with their ``position``: by quantity, largest first, then by asset code.

    A portfolio has one balance per asset, so a window holds no more rows than there are assets.
    """
    order = Window.partitionBy("portfolio_id").orderBy(F.col("qty").desc(), "asset_code", "asset_id")
    return named_balances(balances, assets).withColumn("position", F.row_number().over(order))


def response_rows(bars: DataFrame, interval: str, fields: list[str], keys=("symbol",), time: str = "open_time") -> DataFrame:
    """One row per symbol with its bars in ascending order.

    For the result of ``slice_rows``, which bounds the arrays.
    """
    data = F.array_sort(F.collect_list(F.struct(time, *fields)))
    return bars.groupBy(*keys).agg(data.alias("data")).select(*keys, F.lit(interval).alias("interval"), "data")


# --- synthetic candles --------------------------------------------------------------------


def candle_grid(pairs: DataFrame, step: str = "1 minute") -> DataFrame:
    """A row per pair and step between its ``start`` and ``end``.

    Days are laid out first and spread over the cluster before the steps.
    """
    days = pairs.withColumn(
        "_day", F.explode(F.sequence(F.date_trunc("day", "start"), F.col("end"), F.expr("INTERVAL 1 DAY")))
    )
    days = days.repartition("symbol_id", "exchange_id", "_day")
    first = F.greatest(F.col("start"), F.col("_day"))
    last = F.least(F.col("end"), F.col("_day") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND"))
    # Steps are counted from `start`, so a day begins with the first step in it.
    width = F.lit(span_micros(step))
    shift = F.pmod(micros("start") - micros(first), width)
    begin = F.timestamp_micros(micros(first) + shift)
    points = F.when(begin <= last, F.sequence(begin, last, F.expr(f"INTERVAL {step}")))
    return days.withColumn("open_ts", F.explode(points)).drop("_day", "start", "end")


def synthetic_candles(grid: DataFrame, existing: DataFrame, base: float, width: float, seed: int = 7) -> DataFrame:
    """Random candles on a grid, skipping keys that exist.

    The numbers are hashes of the key, so a task that runs again gives the same
    rows.
    """

    def draw(label: str) -> Column:
        bits = F.pmod(F.xxhash64("symbol_id", "exchange_id", "open_ts", F.lit(label), F.lit(seed)), F.lit(1 << 52))
        return bits / float(1 << 52)

    key = ["symbol_id", "exchange_id", "open_ts"]
    rows = grid.select(
        *key,
        (base + draw("open") * width).alias("open"),
        (base + width / 2 + draw("high") * width).alias("high"),
        (base - width / 2 + draw("low") * width).alias("low"),
        (base + draw("close") * width).alias("close"),
        (draw("volume") * 100).alias("volume"),
    )
    return rows.join(existing.select(*key), key, "left_anti")
