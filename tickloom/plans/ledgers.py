"""Queries over the book: J2-J9, A8, A10, A11, O2, O4, O5, S12, L, P10, Q9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.operators import audit as U
from tickloom.operators import book as K
from tickloom.operators import candles as C
from tickloom.operators import ledger as L
from tickloom.operators.asof import as_of
from tickloom.operators.normalize import generated_columns
from tickloom.plans import views as V
from tickloom.plans.registry import query, r
from tickloom.schemas import EVENT_TYPES, ORDER_STATUS, ORDER_TYPES, QUANTITY
from tickloom.sources.staging import stage

_AT = "2024-03-01 12:00:00"


def _now():
    return F.lit(_AT).cast("timestamp")


# --- enriched history --------------------------------------------------------------------------

_ORDER_COLUMNS = f"""o.portfolio_id, o.id, o.side, o.type, {r("o.price", 2)} AS price, {r("o.quantity")} AS quantity, o.status,
       o.created_ts, o.external_order_id, s.symbol, e.code AS exchange"""
_NAMED_ORDERS = f"""WITH {V.ORDERS_SQL}, {V.SYMBOLS_SQL}, {V.EXCHANGES_SQL}, named AS (
  SELECT {_ORDER_COLUMNS} FROM orders_v o JOIN symbols s ON o.symbol_id = s.id JOIN exchanges e ON o.exchange_id = e.id)"""


def _history(spark: SparkSession, folder: str) -> DataFrame:
    named = K.order_history(V.orders(spark, folder), V.symbols(spark, folder), V.exchanges(spark, folder))
    return named.drop("updated_ts")


@query("J2_order_history", f"{_NAMED_ORDERS} SELECT * FROM named")
def j2(spark: SparkSession, folder: str) -> DataFrame:
    return _history(spark, folder)


def _generated(spark: SparkSession, folder: str) -> DataFrame:
    return generated_columns(V.trades(spark, folder))


_NAMED_TRADES = f"""WITH {V.TRADES_SQL}, {V.SYMBOLS_SQL}, {V.EXCHANGES_SQL}, named AS (
  SELECT t.*, s.symbol, e.code AS exchange FROM trades_v t JOIN symbols s ON t.symbol_id = s.id JOIN exchanges e ON t.exchange_id = e.id)"""


@query(
    "J3_trade_history",
    f"""{_NAMED_TRADES} SELECT portfolio_id, id, side, {r("price", 8)} AS price, {r("quantity")} AS quantity,
       {r("price * quantity", 2)} AS notional, {r("fee_amount", 4)} AS fee_amount, trade_ts, external_trade_id, order_id, symbol, exchange FROM named""",
    places=8,
)
def j3(spark: SparkSession, folder: str) -> DataFrame:
    rows = K.trade_history(_generated(spark, folder), V.symbols(spark, folder), V.exchanges(spark, folder))
    return rows.withColumns(
        {
            "notional": F.round(F.col("notional").cast("double"), 2),
            "fee_amount": F.round(F.col("fee_amount").cast("double"), 4),
        }
    )


def _transactions_sql(condition: str) -> str:
    return f"""{_NAMED_TRADES} SELECT portfolio_id, 'trade' AS transaction_type, id, side, {r("price * quantity", 2)} AS amount,
       trade_ts AS created_at, symbol, exchange, order_id FROM named WHERE {condition}"""


def _transactions(spark: SparkSession, folder: str, kind: str | None) -> DataFrame:
    rows = K.transactions(_generated(spark, folder), V.symbols(spark, folder), V.exchanges(spark, folder), kind)
    amount = F.round(F.col("amount").cast("double"), 2)
    return rows.withColumn("amount", amount).drop("price", "quantity", "fee_amount")


@query("J3_transactions", _transactions_sql("true"))
def j3_transactions(spark: SparkSession, folder: str) -> DataFrame:
    return _transactions(spark, folder, None)


@query("O5_type_filter", _transactions_sql("true"))
def o5(spark: SparkSession, folder: str) -> DataFrame:
    # Deposits do not exist as transactions, so this adds nothing.
    deposits = _transactions(spark, folder, "deposit")
    return _transactions(spark, folder, "trade").unionByName(deposits)


_EXECUTABLE = f"""WITH {V.ORDERS_SQL}, {V.SYMBOLS_SQL}, {V.EXCHANGES_SQL}, {V.PORTFOLIOS_SQL}, {V.REQUESTS_SQL}, executable AS (
  SELECT o.*, s.symbol, s.base_asset_id, s.quote_asset_id, p.user_id, e.code AS exchange_code, q.execution_price
  FROM orders_v o JOIN symbols s ON o.symbol_id = s.id JOIN portfolios p ON o.portfolio_id = p.id
  JOIN exchanges e ON o.exchange_id = e.id JOIN requests q ON q.order_id = o.id AND q.user_id = p.user_id
  WHERE o.status IN ('new', 'open'))"""


def _executable(spark: SparkSession, folder: str, requests=V.requests) -> DataFrame:
    return K.executable_orders(
        V.orders(spark, folder), V.symbols(spark, folder), V.portfolios(spark, folder), V.exchanges(spark, folder),
        requests(spark, folder),
    )


_EXECUTABLE_COLUMNS = f""" SELECT id, portfolio_id, user_id, symbol, base_asset_id, quote_asset_id, exchange_code, side, status,
       {r("execution_price")} AS execution_price FROM executable"""


@query("J4_executable_orders", _EXECUTABLE + _EXECUTABLE_COLUMNS)
def j4(spark: SparkSession, folder: str, requests=V.requests) -> DataFrame:
    return _executable(spark, folder, requests).select(
        "id", "portfolio_id", "user_id", "symbol", "base_asset_id", "quote_asset_id", "exchange_code", "side", "status",
        "execution_price",
    )


@query("J4_repeated_requests", _EXECUTABLE + _EXECUTABLE_COLUMNS)
def j4_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Requests delivered twice execute once, by the first delivery."""
    return j4(spark, folder, V.repeated_requests)


@query(
    "J5_portfolio_list",
    f"""WITH {V.PORTFOLIOS_SQL}, {V.ASSETS_SQL} SELECT p.id, p.user_id, p.name, a.code AS base_currency_code, p.created_at
FROM portfolios p JOIN assets a ON p.base_currency_id = a.id""",
)
def j5(spark: SparkSession, folder: str) -> DataFrame:
    return K.portfolio_list(V.portfolios(spark, folder), V.assets(spark, folder))


@query(
    "J5_held_balances",
    f"""WITH {V.BALANCES_SQL}, {V.ASSETS_SQL} SELECT b.portfolio_id, b.asset_id, {r("b.qty")} AS qty, a.code AS asset_code, a.name AS asset_name
FROM balances b JOIN assets a ON b.asset_id = a.id WHERE b.qty > 0""",
)
def j5_held(spark: SparkSession, folder: str) -> DataFrame:
    return K.named_balances(V.balances(spark, folder), V.assets(spark, folder), held_only=True)


@query(
    "J7_ownership",
    f"""WITH {V.PORTFOLIOS_SQL}, {V.REQUESTS_SQL} SELECT q.order_id, o.o_custkey AS portfolio_id, q.user_id
FROM requests q JOIN orders o ON o.o_orderkey = q.order_id JOIN portfolios p ON p.id = o.o_custkey AND p.user_id = q.user_id""",
)
def j7(spark: SparkSession, folder: str) -> DataFrame:
    asked = V.requests(spark, folder).join(
        V.orders(spark, folder).select(F.col("id").alias("order_id"), "portfolio_id"), "order_id"
    )
    return K.owned(asked, V.portfolios(spark, folder)).select("order_id", "portfolio_id", "user_id")


@query(
    "J9_symbol_assets",
    f"""WITH {V.SYMBOLS_SQL}, {V.ASSETS_SQL} SELECT s.id, s.symbol, b.code AS base_code, q.code AS quote_code
FROM symbols s JOIN assets b ON s.base_asset_id = b.id JOIN assets q ON s.quote_asset_id = q.id""",
)
def j9(spark: SparkSession, folder: str) -> DataFrame:
    rows = K.symbol_assets(V.symbols(spark, folder), V.assets(spark, folder))
    return rows.select("id", "symbol", "base_code", "quote_code")


@query(
    "S12_reference_load",
    f"""WITH {V.SYMBOLS_SQL}, {V.ASSETS_SQL} SELECT s.id, s.symbol, s.base_asset_id, s.quote_asset_id, true AS is_active
FROM symbols s JOIN assets b ON s.base_asset_id = b.id WHERE s.id % 10 <> 9""",
)
def s12(spark: SparkSession, folder: str) -> DataFrame:
    assets = V.assets(spark, folder)
    named = K.symbol_assets(V.symbols(spark, folder), assets)
    # Every tenth pair names the quote asset twice and breaks the rule.
    base = F.when(F.col("id") % 10 == 9, F.col("quote_code")).otherwise(F.col("base_code"))
    pairs = named.select("id", "symbol", base.alias("base_code"), "quote_code")
    return K.symbols_from_codes(pairs, assets)


# --- valuation -----------------------------------------------------------------------------------

_PRICED = f"""WITH {V.TICKS_SQL}, {V.BALANCES_SQL}, {V.ASSETS_SQL}, latest AS (
  SELECT replace(symbol, 'USDT', '') AS code, arg_max(price, "timestamp") AS price FROM ticks GROUP BY symbol), priced AS (
  SELECT b.portfolio_id, a.code AS asset_code, CAST(b.qty AS DOUBLE) AS qty,
         CASE WHEN a.code IN ('USDT', 'USDC', 'USD') THEN 1.0 ELSE coalesce(l.price, 0) END AS price
  FROM balances b JOIN assets a ON b.asset_id = a.id LEFT JOIN latest l ON l.code = a.code)"""


def _priced(spark: SparkSession, folder: str) -> DataFrame:
    # The published price table: one row per symbol, its size known to the planner.
    prices = stage(C.latest_price(V.ticks(spark, folder)), "latest-prices")
    balances = K.named_balances(V.balances(spark, folder), V.assets(spark, folder))
    return K.priced_balances(balances, prices)


@query(
    "J8_priced_balances",
    f"""{_PRICED} SELECT portfolio_id, asset_code, {r("qty")} AS qty, {r("price")} AS price, {r("qty * price")} AS value FROM priced""",
)
def j8(spark: SparkSession, folder: str) -> DataFrame:
    return _priced(spark, folder).select("portfolio_id", "asset_code", "qty", "price", "value")


@query("A8_portfolio_value", f"""{_PRICED} SELECT portfolio_id, {r("sum(qty * price)", 4)} AS total_value FROM priced GROUP BY portfolio_id""")
def a8(spark: SparkSession, folder: str) -> DataFrame:
    rows = K.portfolio_value(_priced(spark, folder))
    return rows.select("portfolio_id", F.round("total_value", 4).alias("total_value"))


@query(
    "A8_allocation",
    f"""{_PRICED} SELECT portfolio_id, asset_code,
       {r("coalesce(qty * price / nullif(sum(qty * price) OVER (PARTITION BY portfolio_id), 0), 0) * 100", 4)} AS share,
       row_number() OVER (PARTITION BY portfolio_id ORDER BY round(qty * price, 6) DESC, asset_code) AS position
FROM priced WHERE qty > 0""",
    places=4,
)
def a8_allocation(spark: SparkSession, folder: str) -> DataFrame:
    """Shares of a portfolio's value."""
    priced = _priced(spark, folder)
    return K.allocation(priced.withColumn("value", F.round("value", 6))).select("portfolio_id", "asset_code", "share", "position")


@query("A10_held_assets", f"""{_PRICED} SELECT portfolio_id, count(*) FILTER (WHERE qty > 0) AS held_assets FROM priced GROUP BY portfolio_id""")
def a10(spark: SparkSession, folder: str) -> DataFrame:
    return K.portfolio_value(_priced(spark, folder)).select("portfolio_id", "held_assets")


@query(
    "A11_nested_portfolios",
    f"""WITH {V.PORTFOLIOS_SQL}, {V.BALANCES_SQL}, {V.ASSETS_SQL}, held AS (
  SELECT b.portfolio_id, string_agg(a.code, ',' ORDER BY a.code) AS codes, count(*) AS n, {r("sum(b.qty)")} AS qty
  FROM balances b JOIN assets a ON b.asset_id = a.id WHERE b.qty > 0 GROUP BY b.portfolio_id)
SELECT p.id, p.name, c.code AS base_currency_code, coalesce(h.n, 0) AS balances, coalesce(h.codes, '') AS asset_codes, coalesce(h.qty, 0.0) AS total_qty
FROM portfolios p JOIN assets c ON p.base_currency_id = c.id LEFT JOIN held h ON h.portfolio_id = p.id""",
)
def a11(spark: SparkSession, folder: str) -> DataFrame:
    rows = K.nested_portfolios(V.portfolios(spark, folder), V.balances(spark, folder), V.assets(spark, folder))
    held = F.col("balances")
    total = F.aggregate(held, F.lit(0.0), lambda sum_, b: sum_ + b["qty"].cast("double"))
    return rows.select(
        "id", "name", "base_currency_code", F.size(held).alias("balances"),
        F.array_join(F.transform(held, lambda b: b["asset_code"]), ",").alias("asset_codes"), total.alias("total_qty"),
    )


@query(
    "L10_equity_snapshot",
    f"""{_PRICED} SELECT portfolio_id, TIMESTAMP '{_AT}' AS snapshot_ts, {r("sum(qty * price)", 4)} AS equity_base FROM priced GROUP BY portfolio_id""",
)
def l10(spark: SparkSession, folder: str) -> DataFrame:
    rows = K.equity_snapshot(_priced(spark, folder), _now())
    return rows.withColumn("equity_base", F.round("equity_base", 4))


_DAY = "INTERVAL 1 DAY"


@query(
    "L10_equity_history",
    f"""WITH {V.TICKS_SQL}, {V.BALANCES_SQL}, {V.ASSETS_SQL}, ends AS (
  SELECT date_trunc('day', min("timestamp")) + {_DAY} AS a, date_trunc('day', max("timestamp")) + {_DAY} AS b FROM ticks),
grid AS (SELECT unnest(generate_series(a, b, {_DAY})) AS snapshot_ts FROM ends),
points AS (SELECT symbol, snapshot_ts FROM (SELECT DISTINCT symbol FROM ticks) CROSS JOIN grid),
priced AS (SELECT p.symbol, p.snapshot_ts, t.price FROM points p ASOF JOIN ticks t ON p.symbol = t.symbol AND p.snapshot_ts >= t."timestamp")
SELECT b.portfolio_id, CAST(g.snapshot_ts AS TIMESTAMP) AS snapshot_ts,
       {r("sum(CAST(b.qty AS DOUBLE) * CASE WHEN a.code IN ('USDT', 'USDC', 'USD') THEN 1 ELSE coalesce(p.price, 0) END)", 4)} AS equity_base
FROM balances b JOIN assets a ON b.asset_id = a.id CROSS JOIN grid g
LEFT JOIN priced p ON p.symbol = a.code || 'USDT' AND p.snapshot_ts = g.snapshot_ts GROUP BY ALL""",
)
def l10_history(spark: SparkSession, folder: str) -> DataFrame:
    """Equity of every portfolio at every midnight that the trades reach."""
    ticks = V.ticks(spark, folder)
    day = F.expr(_DAY)
    first, last = ticks.agg(F.date_trunc("day", F.min("timestamp")) + day, F.date_trunc("day", F.max("timestamp")) + day).first()
    start, end = F.lit(first), F.lit(last)
    points = ticks.select("symbol").distinct().withColumn("timestamp", F.explode(F.sequence(start, end, day)))
    prices = as_of(points, ticks, ["symbol"], "timestamp", ["price"], ties=("trade_id",))
    prices = stage(prices.withColumnRenamed("timestamp", "snapshot_ts"), "daily-prices")
    held = K.named_balances(V.balances(spark, folder), V.assets(spark, folder))
    rows = K.equity_history(held, prices, start, end, "1 DAY")
    return rows.withColumn("equity_base", F.round("equity_base", 4))


_SIZING = """sizing AS (
  SELECT o_orderkey AS id, CASE o_orderkey % 5 WHEN 0 THEN 'ERRORUSDT' WHEN 1 THEN 'VIEWUSDT' WHEN 2 THEN 'PURCHASEUSDT'
           WHEN 3 THEN 'SIGNUPUSDT' ELSE 'CLICKUSDT' END AS symbol, CASE WHEN o_orderkey % 2 = 0 THEN 'buy' ELSE 'sell' END AS side,
         CASE WHEN o_orderkey % 3 = 0 THEN o_totalprice END AS amount, CAST(o_orderkey % 50 + 1 AS DOUBLE) AS quantity,
         o_totalprice * 2 AS quote_qty, (o_orderkey % 50 + 1) / 4.0 AS base_qty FROM orders)"""


@query(
    "P10_order_sizing",
    f"""WITH {V.TICKS_SQL}, {_SIZING}, latest AS (SELECT symbol, arg_max(price, "timestamp") AS price FROM ticks GROUP BY symbol), sized AS (
  SELECT id, s.symbol, side, l.price, quote_qty, base_qty, side = 'buy' AND amount IS NOT NULL AS buying, amount AS a, quantity AS q
  FROM sizing s JOIN latest l USING (symbol)), done AS (
  SELECT *, CASE WHEN buying THEN round(a / nullif(price, 0), 8) ELSE q END AS quantity,
         CASE WHEN buying THEN a ELSE round(q * price, 2) END AS amount FROM sized)
SELECT id, symbol, side, {r("quantity", 8)} AS quantity, {r("amount")} AS amount, {r("round(CAST(amount AS DECIMAL(18,2)) * 0.001, 2)")} AS fee,
       {r("CASE WHEN side = 'buy' THEN quote_qty / nullif(price, 0) ELSE base_qty END", 4)} AS max_quantity FROM done""",
    places=8,
)
def p10(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    names = ["ERRORUSDT", "VIEWUSDT", "PURCHASEUSDT", "SIGNUPUSDT", "CLICKUSDT"]
    asked = V.table(spark, folder, "orders").select(
        key.alias("id"),
        F.element_at(F.array(*[F.lit(n) for n in names]), (key % 5 + 1).cast("int")).alias("symbol"),
        F.when(key % 2 == 0, "buy").otherwise("sell").alias("side"),
        F.when(key % 3 == 0, F.col("o_totalprice")).alias("amount"),
        (key % 50 + 1).cast("double").alias("quantity"),
        (F.col("o_totalprice") * 2).alias("quote_qty"),
        ((key % 50 + 1) / 4).alias("base_qty"),
    )
    prices = stage(C.latest_price(V.ticks(spark, folder)), "latest-prices")
    sized = K.size_orders(asked, prices)
    return sized.select(
        "id", "symbol", "side", "quantity", "amount", "fee", F.round("max_quantity", 4).alias("max_quantity")
    )


# --- order and paging --------------------------------------------------------------------------------


@query(
    "O2_portfolio_pages",
    f"""{_NAMED_ORDERS}, ranked AS (
  SELECT *, row_number() OVER (PARTITION BY portfolio_id ORDER BY created_ts DESC, id DESC) AS position FROM named)
SELECT * FROM ranked WHERE position BETWEEN 3 AND 7""",
)
def o2(spark: SparkSession, folder: str) -> DataFrame:
    return K.page(_history(spark, folder), "created_ts", limit=5, offset=2)


@query("O2_single_page", f"{_NAMED_ORDERS} SELECT * FROM named ORDER BY created_ts DESC, id DESC LIMIT 100 OFFSET 50")
def o2_single(spark: SparkSession, folder: str) -> DataFrame:
    return K.single_page(_history(spark, folder), "created_ts", limit=100, offset=50)


@query(
    "O4_sorted_balances",
    f"""WITH {V.BALANCES_SQL}, {V.ASSETS_SQL} SELECT b.portfolio_id, b.asset_id, {r("b.qty")} AS qty, a.code AS asset_code, a.name AS asset_name,
       row_number() OVER (PARTITION BY b.portfolio_id ORDER BY b.qty DESC, a.code, b.asset_id) AS position
FROM balances b JOIN assets a ON b.asset_id = a.id""",
)
def o4(spark: SparkSession, folder: str) -> DataFrame:
    return K.sorted_balances(V.balances(spark, folder), V.assets(spark, folder))


# --- execution ------------------------------------------------------------------------------------------

_FILLS = f"""{_EXECUTABLE}, fills AS (
  SELECT id, portfolio_id, symbol_id, exchange_id, side, created_ts, quantity, fill_price,
         CAST(fill_price * CAST(quantity AS DECIMAL(17,10)) AS DECIMAL(38,18)) AS notional,
         CASE WHEN side = 'buy' THEN quote_asset_id ELSE base_asset_id END AS pay_asset,
         CASE WHEN side = 'buy' THEN base_asset_id ELSE quote_asset_id END AS get_asset
  FROM (SELECT *, coalesce(nullif(execution_price, 0), nullif(price, 0), 0) AS fill_price FROM executable))"""


def _fills(spark: SparkSession, folder: str, requests=V.requests) -> DataFrame:
    # Settlement passes over the fills several times; the joins behind them run once.
    return stage(L.fills(_executable(spark, folder, requests)), "fills")


@query(
    "L1_postings",
    f"""{_FILLS} SELECT portfolio_id, created_ts, id, CAST(0 AS BIGINT) AS leg, pay_asset AS asset_id,
       {r("-CASE WHEN side = 'buy' THEN notional ELSE quantity END")} AS delta FROM fills
UNION ALL SELECT portfolio_id, created_ts, id, 1, get_asset, {r("CASE WHEN side = 'buy' THEN quantity ELSE notional END")} FROM fills""",
)
def l1(spark: SparkSession, folder: str) -> DataFrame:
    return L.postings(L.fills(_executable(spark, folder)))


@query(
    "L2_screening",
    f"""{_FILLS}, {V.BALANCES_SQL}, moves AS (
  SELECT portfolio_id, asset_id, TIMESTAMP '1970-01-01' AS created_ts, CAST(-1 AS BIGINT) AS id, 0 AS leg, qty AS delta FROM balances
  UNION ALL SELECT portfolio_id, pay_asset, created_ts, id, 0, -CASE WHEN side = 'buy' THEN notional ELSE quantity END FROM fills
  UNION ALL SELECT portfolio_id, get_asset, created_ts, id, 1, CASE WHEN side = 'buy' THEN quantity ELSE notional END FROM fills)
SELECT portfolio_id, asset_id, id, CAST(leg AS BIGINT) AS leg,
       {r("sum(delta) OVER (PARTITION BY portfolio_id, asset_id ORDER BY created_ts, id, leg ROWS UNBOUNDED PRECEDING)")} AS balance FROM moves""",
)
def l2_screening(spark: SparkSession, folder: str) -> DataFrame:
    rows = L.running_balances(_fills(spark, folder), V.balances(spark, folder))
    return rows.select("portfolio_id", "asset_id", "id", "leg", "balance")


# The fold over each portfolio's fills, as a loop would do it: the state is a map.
_SETTLED = (
    _FILLS.replace("WITH ", "WITH RECURSIVE ", 1)
    + f""", {V.BALANCES_SQL}, legs AS MATERIALIZED (
  SELECT *, CASE WHEN side = 'buy' THEN notional ELSE quantity END AS pay,
         CASE WHEN side = 'buy' THEN quantity ELSE notional END AS get,
         row_number() OVER (PARTITION BY portfolio_id ORDER BY created_ts, id) AS k FROM fills),
opening AS (SELECT portfolio_id, map_from_entries(list((asset_id, qty))) AS held FROM balances GROUP BY portfolio_id),
fold AS (
  SELECT portfolio_id, CAST(0 AS BIGINT) AS k, held, CAST(NULL AS BIGINT) AS id, CAST(NULL AS DECIMAL(38,18)) AS pay,
         CAST(NULL AS DECIMAL(38,18)) AS available, CAST(NULL AS BOOLEAN) AS accepted FROM opening
  UNION ALL
  SELECT portfolio_id, k, CASE WHEN available >= pay THEN map_concat(held, MAP {{pay_asset: CAST(available - pay AS DECIMAL(38,18)),
           get_asset: CAST(coalesce(map_extract(held, get_asset)[1], 0) + get AS DECIMAL(38,18))}}) ELSE held END,
         id, pay, available, available >= pay
  FROM (SELECT f.portfolio_id, l.k, f.held, l.id, CAST(l.pay AS DECIMAL(38,18)) AS pay, l.pay_asset, l.get_asset, l.get,
               CAST(coalesce(map_extract(f.held, l.pay_asset)[1], 0) AS DECIMAL(38,18)) AS available
        FROM fold f JOIN legs l ON l.portfolio_id = f.portfolio_id AND l.k = f.k + 1)),
settled AS (SELECT * FROM fold WHERE k > 0)"""
)


_SETTLEMENT = (
    f"""{_SETTLED} SELECT portfolio_id, id, accepted, {r("pay")} AS required, {r("available")} AS available FROM settled"""
)


@query("L2_settlement", _SETTLEMENT)
def l2(spark: SparkSession, folder: str) -> DataFrame:
    return L.settle(_fills(spark, folder), V.balances(spark, folder))


@query("L2_repeated_requests", _SETTLEMENT)
def l2_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """Requests delivered twice settle once."""
    return L.settle(_fills(spark, folder, V.repeated_requests), V.balances(spark, folder))


@query(
    "L2_closing_balances",
    f"""{_SETTLED}, last AS (SELECT portfolio_id, arg_max(held, k) AS held FROM fold GROUP BY portfolio_id), entries AS (
  SELECT portfolio_id, unnest(map_entries(held)) AS e FROM last)
SELECT portfolio_id, e.key AS asset_id, {r("e.value")} AS qty FROM entries""",
)
def l2_closing(spark: SparkSession, folder: str) -> DataFrame:
    filled, balances = _fills(spark, folder), V.balances(spark, folder)
    return L.closing_balances(filled, L.settle(filled, balances), balances)


@query(
    "L3_filled_orders",
    f"""{_SETTLED} SELECT o.id, CASE WHEN s.accepted THEN 'filled' ELSE o.status END AS status,
       CASE WHEN s.accepted THEN TIMESTAMP '{_AT}' ELSE o.updated_ts END AS updated_ts
FROM orders_v o LEFT JOIN settled s ON s.id = o.id""",
)
def l3(spark: SparkSession, folder: str) -> DataFrame:
    settled = stage(L.settle(_fills(spark, folder), V.balances(spark, folder)), "settled")
    return L.filled_orders(V.orders(spark, folder), settled, _now()).select("id", "status", "updated_ts")


@query(
    "L3_new_trades",
    f"""{_SETTLED} SELECT f.portfolio_id, f.symbol_id, f.exchange_id, f.id AS order_id,
       'exec_' || f.id || '_' || epoch_ms(TIMESTAMP '{_AT}') AS external_trade_id, f.side, {r("f.fill_price")} AS price,
       {r("f.quantity")} AS quantity, {r("f.notional")} AS notional, TIMESTAMP '{_AT}' AS trade_ts
FROM fills f JOIN settled s ON s.id = f.id WHERE s.accepted""",
)
def l3_trades(spark: SparkSession, folder: str) -> DataFrame:
    filled = _fills(spark, folder)
    settled = stage(L.settle(filled, V.balances(spark, folder)), "settled")
    return L.new_trades(filled, settled, _now())


@query(
    "L3_repeated_requests",
    f"""{_SETTLED} SELECT f.id AS order_id, {r("f.quantity")} AS quantity, {r("f.notional")} AS notional
FROM fills f JOIN settled s ON s.id = f.id WHERE s.accepted""",
)
def l3_repeated(spark: SparkSession, folder: str) -> DataFrame:
    """One trade for an order whose request came twice."""
    filled = _fills(spark, folder, V.repeated_requests)
    settled = stage(L.settle(filled, V.balances(spark, folder)), "settled")
    return L.new_trades(filled, settled, _now()).select("order_id", "quantity", "notional")


@query(
    "L4_cancel",
    f"""WITH {V.ORDERS_SQL}, {V.REQUESTS_SQL}, {V.PORTFOLIOS_SQL}, hits AS (
  SELECT o.id FROM orders_v o JOIN requests q ON q.order_id = o.id JOIN portfolios p ON p.id = o.portfolio_id AND p.user_id = q.user_id
  WHERE o.status IN ('new', 'open'))
SELECT id, CASE WHEN h.id IS NOT NULL THEN 'canceled' ELSE status END AS status,
       CASE WHEN h.id IS NOT NULL THEN TIMESTAMP '{_AT}' ELSE updated_ts END AS updated_ts FROM orders_v LEFT JOIN hits h USING (id)""",
)
def l4(spark: SparkSession, folder: str) -> DataFrame:
    done = L.cancel_orders(V.orders(spark, folder), V.requests(spark, folder), V.portfolios(spark, folder), _now())
    return done.select("id", "status", "updated_ts")


# --- deposits, upserts, intake ----------------------------------------------------------------------------


def _transfers(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("o_orderkey")
    amount = F.col("o_totalprice").cast("decimal(12,2)").cast(QUANTITY)
    return V.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("portfolio_id"),
        (key % 2).alias("asset_id"),
        key.alias("id"),
        F.col("o_orderdate").cast("timestamp").alias("created_ts"),
        F.when(key % 31 == 0, -amount).otherwise(amount).alias("qty"),
        F.when(key % 29 == 0, "move").when(key % 3 == 1, "add").otherwise("subtract").alias("operation"),
    )


@query(
    "L5_transfers",
    f"""WITH RECURSIVE {V.BALANCES_SQL}, moves AS MATERIALIZED (
  SELECT o_custkey AS portfolio_id, o_orderkey % 2 AS asset_id, o_orderkey AS id, o_orderdate AS created_ts,
         CAST(o_totalprice AS DECIMAL(12,2)) AS qty, o_orderkey % 3 = 1 AS is_add,
         row_number() OVER (PARTITION BY o_custkey, o_orderkey % 2 ORDER BY o_orderdate, o_orderkey) AS k
  FROM orders WHERE o_orderkey % 31 <> 0 AND o_orderkey % 29 <> 0), fold AS (
  SELECT m.portfolio_id, m.asset_id, m.id, m.created_ts, m.k, m.qty, m.is_add,
         CAST(CASE WHEN is_add THEN coalesce(b.qty, 0) + m.qty ELSE greatest(coalesce(b.qty, 0) - m.qty, 0) END AS DECIMAL(38,18)) AS balance
  FROM moves m LEFT JOIN balances b ON b.portfolio_id = m.portfolio_id AND b.asset_id = m.asset_id AND b.qty > 0 WHERE m.k = 1
  UNION ALL
  SELECT m.portfolio_id, m.asset_id, m.id, m.created_ts, m.k, m.qty, m.is_add,
         CAST(CASE WHEN m.is_add THEN f.balance + m.qty ELSE greatest(f.balance - m.qty, 0) END AS DECIMAL(38,18))
  FROM fold f JOIN moves m ON m.portfolio_id = f.portfolio_id AND m.asset_id = f.asset_id AND m.k = f.k + 1)
SELECT portfolio_id, asset_id, created_ts, id, {r("CASE WHEN is_add THEN qty ELSE -qty END")} AS delta, {r("balance", 2)} AS balance FROM fold""",
)
def l5(spark: SparkSession, folder: str) -> DataFrame:
    held = V.balances(spark, folder).filter(F.col("qty") > 0)
    rows = L.apply_transfers(_transfers(spark, folder), held)
    return rows.withColumn("balance", F.round(F.col("balance").cast("double"), 2))


@query(
    "L5_refused",
    """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 31 = 0 THEN 'Quantity must be positive'
       ELSE 'Operation must be "add" or "subtract"' END AS reason FROM orders WHERE o_orderkey % 31 = 0 OR o_orderkey % 29 = 0""",
)
def l5_refused(spark: SparkSession, folder: str) -> DataFrame:
    rows = _transfers(spark, folder).withColumn("reason", L.transfer_error())
    return rows.filter(F.col("reason").isNotNull()).select("id", "reason")


def _versions(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """All orders, and a newer or an older version of each plus one new order per order."""
    current = V.orders(spark, folder).select("id", "status", "updated_ts")
    days = F.when(F.col("id") % 3 == 0, 1).otherwise(-1)
    moved = current.withColumns(
        {"status": F.lit("expired"), "updated_ts": F.col("updated_ts") + days * F.expr("INTERVAL 1 DAY")}
    )
    fresh = moved.withColumn("id", -F.col("id") - 1)
    return current, moved.unionByName(fresh)


_MOVED = "updated_ts + CASE WHEN id % 3 = 0 THEN INTERVAL 1 DAY ELSE INTERVAL '-1' DAY END"


@query(
    "L6_upsert_latest",
    f"""WITH {V.ORDERS_SQL} SELECT id, CASE WHEN id % 3 = 0 THEN 'expired' ELSE status END AS status,
       CASE WHEN id % 3 = 0 THEN {_MOVED} ELSE updated_ts END AS updated_ts FROM orders_v
UNION ALL SELECT -id - 1, 'expired', {_MOVED} FROM orders_v""",
)
def l6(spark: SparkSession, folder: str) -> DataFrame:
    current, updates = _versions(spark, folder)
    return L.upsert_latest(current, updates, ["id"], ["updated_ts"])


@query(
    "L6_insert_missing",
    f"""WITH {V.ORDERS_SQL} SELECT id, status, updated_ts FROM orders_v UNION ALL SELECT -id - 1, 'expired', {_MOVED} FROM orders_v""",
)
def l6_missing(spark: SparkSession, folder: str) -> DataFrame:
    current, updates = _versions(spark, folder)
    return L.insert_missing(current, updates, ["id"])


def _intake(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("id")
    names = V.symbols(spark, folder).select(F.col("id").alias("symbol_id"), F.col("symbol").alias("_name"))
    rows = V.orders(spark, folder).join(names, "symbol_id")
    return rows.select(
        key.alias("request_id"), "portfolio_id",
        F.when(key % 7 == 0, F.col("portfolio_id") + 1).otherwise(F.col("portfolio_id")).alias("user_id"),
        F.when(key % 13 == 0, "NOPE").otherwise(F.col("_name")).alias("symbol"),
        F.when(key % 17 == 0, "NOWHERE").when(key % 3 == 0, "KRAKEN").when(key % 3 == 1, "").alias("exchange_code"),
        "side", "type", "price", "quantity", "created_ts", key.alias("order_id"),
        F.when(key % 2 == 0, "USDT").when(key % 5 == 0, "DOGE").alias("fee_asset_code"),
        (key % 10).cast("double").alias("fee_amount"), F.when(key % 4 == 0, F.col("created_ts")).alias("trade_ts"),
    )


_INTAKE_REASON = """CASE WHEN o.id % 7 = 0 THEN 'Portfolio not found or access denied' WHEN o.id % 13 = 0 THEN 'Symbol NOPE not found'
       WHEN o.id % 17 = 0 THEN 'Exchange not found' END"""


@query(
    "L7_order_intake",
    f"""WITH {V.ORDERS_SQL} SELECT id AS request_id, portfolio_id,
       coalesce(CASE WHEN id % 13 <> 0 THEN symbol_id END, -1) AS symbol_id,
       coalesce(CASE WHEN id % 17 <> 0 THEN CASE WHEN id % 3 = 0 THEN 2 ELSE 0 END END, -1) AS exchange_id, side, type,
       CASE WHEN reason IS NULL THEN 'new' END AS status,
       CASE WHEN reason IS NULL THEN portfolio_id || '_' || epoch_ms(created_ts) || '_' || id END AS external_order_id, reason AS reject_reason
FROM (SELECT o.*, {_INTAKE_REASON} AS reason FROM orders_v o)""",
)
def l7(spark: SparkSession, folder: str) -> DataFrame:
    rows = L.order_intake(
        _intake(spark, folder), V.portfolios(spark, folder), V.symbols(spark, folder), V.exchanges(spark, folder)
    )
    return rows.drop("price", "quantity", "created_ts").fillna(-1, ["symbol_id", "exchange_id"])


@query(
    "L8_trade_intake",
    f"""WITH {V.ORDERS_SQL} SELECT id AS request_id, id AS order_id, portfolio_id,
       CASE WHEN reason IS NULL THEN 'manual_' || epoch_ms(TIMESTAMP '{_AT}') || '_' || id END AS external_trade_id, side,
       CASE WHEN id % 2 = 0 THEN 0 ELSE -1 END AS fee_asset_id, {r("id % 10")} AS fee_amount,
       CASE WHEN id % 4 = 0 THEN created_ts ELSE TIMESTAMP '{_AT}' END AS trade_ts, reason AS reject_reason
FROM (SELECT o.*, {_INTAKE_REASON} AS reason FROM orders_v o)""",
)
def l8(spark: SparkSession, folder: str) -> DataFrame:
    rows = L.trade_intake(
        _intake(spark, folder), V.portfolios(spark, folder), V.symbols(spark, folder), V.exchanges(spark, folder),
        V.assets(spark, folder), _now(),
    )
    return rows.drop("symbol_id", "exchange_id", "price", "quantity").fillna(-1, ["fee_asset_id"])


# --- positions and events -----------------------------------------------------------------------------------


@query(
    "L9_positions",
    f"""WITH {V.TRADES_SQL} SELECT portfolio_id, symbol_id, {r("sum(CASE WHEN side = 'buy' THEN quantity ELSE -quantity END)")} AS qty,
       {r("sum(price * quantity) FILTER (WHERE side = 'buy') / nullif(sum(quantity) FILTER (WHERE side = 'buy'), 0)", 8)} AS avg_price
FROM trades_v GROUP BY portfolio_id, symbol_id""",
    places=8,
)
def l9(spark: SparkSession, folder: str) -> DataFrame:
    return L.positions(V.trades(spark, folder))


def _order_events(spark: SparkSession, folder: str) -> DataFrame:
    kind = F.col("event_type")
    return V.table(spark, folder, "events").select(
        F.col("event_id").alias("id"),
        F.col("user_id").alias("order_id"),
        F.when(kind == "click", "order.created").when(kind == "view", "order.submitted")
        .when(kind == "purchase", "order.filled").when(kind == "error", "order.rejected").otherwise(kind)
        .alias("event_type"),
        F.col("ts").cast("timestamp").alias("created_at"),
    )


_EVENTS = """order_events AS (SELECT event_id AS id, user_id AS order_id, ts AS created_at,
  CASE event_type WHEN 'click' THEN 'order.created' WHEN 'view' THEN 'order.submitted' WHEN 'purchase' THEN 'order.filled'
       WHEN 'error' THEN 'order.rejected' ELSE event_type END AS event_type FROM events)"""


@query(
    "L11_current_state",
    f"""WITH {_EVENTS} SELECT order_id, arg_max(event_type, created_at) AS last_event, max(created_at) AS last_at, count(*) AS events
FROM order_events GROUP BY order_id""",
)
def l11(spark: SparkSession, folder: str) -> DataFrame:
    return L.current_state(_order_events(spark, folder), "order_id")


@query(
    "L11_event_counts",
    f"""WITH {_EVENTS} SELECT event_type, count(*) AS events, event_type LIKE 'order.%' AS known FROM order_events GROUP BY event_type""",
)
def l11_counts(spark: SparkSession, folder: str) -> DataFrame:
    return L.event_counts(_order_events(spark, folder), EVENT_TYPES)


_NEXT = """CASE WHEN e.event_type = 'order.created' AND {s} = 'none' THEN 'pending'
  WHEN e.event_type = 'order.submitted' AND {s} = 'pending' THEN 'open'
  WHEN e.event_type = 'order.filled' AND {s} IN ('pending', 'open', 'partially_filled') THEN 'filled'
  WHEN e.event_type = 'order.rejected' AND {s} IN ('pending', 'open') THEN 'rejected' END"""


@query(
    "L11_replay",
    f"""WITH RECURSIVE {_EVENTS}, numbered AS (
  SELECT order_id, event_type, row_number() OVER (PARTITION BY order_id ORDER BY created_at, id) AS n FROM order_events), walk AS (
  SELECT e.order_id, n, coalesce({_NEXT.format(s="'none'")}, 'none') AS s, {_NEXT.format(s="'none'")} IS NOT NULL AS accepted
  FROM numbered e WHERE n = 1
  UNION ALL
  SELECT e.order_id, e.n, coalesce({_NEXT.format(s="w.s")}, w.s), {_NEXT.format(s="w.s")} IS NOT NULL
  FROM walk w JOIN numbered e ON e.order_id = w.order_id AND e.n = w.n + 1)
SELECT order_id, nullif(arg_max(s, n), 'none') AS status, count(*) FILTER (accepted) AS accepted, count(*) FILTER (NOT accepted) AS rejected,
       CASE nullif(arg_max(s, n), 'none') WHEN 'pending' THEN 'new' WHEN 'expired' THEN 'canceled' ELSE nullif(arg_max(s, n), 'none') END AS platform_status
FROM walk GROUP BY order_id""",
)
def l11_replay(spark: SparkSession, folder: str) -> DataFrame:
    return L.replayed_state(L.replay_orders(_order_events(spark, folder)))


# --- audit ---------------------------------------------------------------------------------------------------


@query(
    "Q9_constraint_audit",
    f"""WITH {V.BALANCES_SQL}, {V.ORDERS_SQL}, {V.TRADES_SQL}, {V.SYMBOLS_SQL}, {V.PORTFOLIOS_SQL}, {V.EXCHANGES_SQL}
SELECT 'balances_qty' AS rule, count(*) AS violations FROM balances WHERE NOT qty >= 0
UNION ALL SELECT 'balances_unique', count(*) - count(DISTINCT (portfolio_id, asset_id)) FROM balances
UNION ALL SELECT 'orders_quantity', count(*) FROM orders_v WHERE NOT quantity > 0
UNION ALL SELECT 'orders_price', count(*) FROM orders_v WHERE NOT (type = 'market' OR price > 0)
UNION ALL SELECT 'orders_status', count(*) FROM orders_v WHERE status NOT IN ('new', 'open', 'filled', 'partially_filled')
UNION ALL SELECT 'orders_type', count(*) FROM orders_v WHERE type NOT IN ('market', 'limit', 'stop', 'stop_limit')
UNION ALL SELECT 'orders_portfolio', count(*) FROM orders_v WHERE portfolio_id NOT IN (SELECT id FROM portfolios)
UNION ALL SELECT 'symbols_assets', count(*) FROM symbols WHERE base_asset_id = quote_asset_id
UNION ALL SELECT 'trades_price', count(*) FROM trades_v WHERE NOT price > 0
UNION ALL SELECT 'trades_unique', count(*) - count(DISTINCT (exchange_id, external_trade_id, trade_ts)) FROM trades_v
UNION ALL SELECT 'trades_symbol', count(*) FROM trades_v WHERE symbol_id NOT IN (SELECT id FROM symbols)
UNION ALL SELECT 'trades_exchange', count(*) FROM trades_v WHERE exchange_id NOT IN (SELECT id FROM exchanges)
UNION ALL SELECT 'trades_order', count(*) FROM trades_v WHERE order_id NOT IN (SELECT id FROM orders_v)""",
)
def q9(spark: SparkSession, folder: str) -> DataFrame:
    balances, orders, trades = V.balances(spark, folder), V.orders(spark, folder), V.trades(spark, folder)
    symbols, exchanges = V.symbols(spark, folder), V.exchanges(spark, folder)
    return U.audit(
        [
            U.check_rule(balances, "balances_qty", F.col("qty") >= 0),
            U.unique_rule(balances, "balances_unique", ["portfolio_id", "asset_id"]),
            U.check_rule(orders, "orders_quantity", F.col("quantity") > 0),
            U.check_rule(orders, "orders_price", (F.col("type") == "market") | (F.col("price") > 0)),
            U.vocabulary_rule(orders, "orders_status", "status", ORDER_STATUS),
            U.vocabulary_rule(orders, "orders_type", "type", ORDER_TYPES),
            U.foreign_rule(orders, "orders_portfolio", "portfolio_id", V.portfolios(spark, folder), "id"),
            U.check_rule(symbols, "symbols_assets", F.col("base_asset_id") != F.col("quote_asset_id")),
            U.check_rule(trades, "trades_price", F.col("price") > 0),
            U.unique_rule(trades, "trades_unique", ["exchange_id", "external_trade_id", "trade_ts"]),
            U.foreign_rule(trades, "trades_symbol", "symbol_id", symbols, "id"),
            U.foreign_rule(trades, "trades_exchange", "exchange_id", exchanges, "id"),
            U.foreign_rule(trades, "trades_order", "order_id", orders, "id"),
        ]
    )
