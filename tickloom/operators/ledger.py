"""Executions, settlement, transfers, intake, positions and event state."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Context, Decimal

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.operators.normalize import exact_product
from tickloom.operators.series import BLOCK, BLOCK_ROWS, ROW, number_rows, running
from tickloom.operators.stacking import stack
from tickloom.schemas import (
    BAD_OPERATION, BAD_QUANTITY, DEFAULT_EXCHANGE, LIVE_STATUS, NO_EXCHANGE, NOT_OWNED, ORDER_TRANSITIONS, PLATFORM_STATUS,
    PRICE, QUANTITY,
)
from tickloom.sources.staging import stage

# One account may hold a third of all postings; a day of it is one task's work.
LEDGER_CHUNK = "1 day"


def _wide(amount: Column) -> Column:
    """One digit less, so that a sum or difference keeps scale 18."""
    return amount.cast(T.DecimalType(37, 18))


def fills(executable: DataFrame) -> DataFrame:
    """Fill price and notional of every order to execute: the execution price,
    else the order's, else 0; a price of 0 counts as not given."""

    def given(column: str) -> Column:
        return F.nullif(F.col(column).cast(PRICE), F.lit(0).cast(PRICE))

    fill = F.coalesce(given("execution_price"), given("price"), F.lit(0).cast(PRICE))
    priced = executable.withColumns({"fill_price": fill, "quantity": F.col("quantity").cast(QUANTITY)})
    return priced.withColumn("notional", exact_product(F.col("fill_price"), F.col("quantity")))


def postings(filled: DataFrame) -> DataFrame:
    """L1: two postings per fill.  A buy pays the notional in the quote asset and
    gets the quantity of the base asset, a sell the other way round.  The paying
    side comes first."""
    buy = F.col("side") == "buy"

    def posting(leg: int, asset: Column, delta: Column) -> Column:
        return F.struct(F.lit(leg).alias("leg"), asset.alias("asset_id"), delta.cast(QUANTITY).alias("delta"))

    base, quote = F.col("base_asset_id"), F.col("quote_asset_id")
    pay = posting(0, F.when(buy, quote).otherwise(base), F.when(buy, -F.col("notional")).otherwise(-F.col("quantity")))
    get = posting(1, F.when(buy, base).otherwise(quote), F.when(buy, F.col("quantity")).otherwise(F.col("notional")))
    return filled.withColumn("_p", F.explode(F.array(pay, get))).select("portfolio_id", "created_ts", "id", "_p.*")


def running_balances(filled: DataFrame, balances: DataFrame, span: str = LEDGER_CHUNK) -> DataFrame:
    """L2, screening: the balance after every posting if all fills were accepted.

    A negative ``balance`` marks a shortfall.  Two-level running sums, so one
    account may hold any share of the postings.
    """
    # Opening balances stand before every fill.
    opening = balances.select(
        "portfolio_id", F.timestamp_micros(F.lit(0)).alias("created_ts"), F.lit(-1).cast("long").alias("id"),
        F.lit(0).alias("leg"), "asset_id", F.col("qty").cast(QUANTITY).alias("delta"),
    )
    moves = stack(opening, postings(filled).withColumn("created_ts", F.col("created_ts").cast("timestamp")))
    return running(
        moves, ["portfolio_id", "asset_id"], ["created_ts", "id", "leg"], {"balance": ("sum", "delta")}, span
    )


_SETTLED = "portfolio_id long, id long, accepted boolean, required decimal(38,18), available decimal(38,18)"
_EXACT = Context(prec=60)


def _fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Accepts or rejects fills in order.  Input is sorted by portfolio, opening
    balances first; only one portfolio's balances are held at a time."""
    owner, held = None, {}
    for batch in batches:
        rows = []
        for portfolio, opening, order, pay_asset, cost, gain_asset, gain in zip(
            batch.portfolio_id, batch.opening, batch.id, batch.pay_asset, batch.cost, batch.gain_asset, batch.gain
        ):
            if portfolio != owner:
                owner, held = portfolio, {}
            if opening:
                held[pay_asset] = cost
                continue
            available = held.get(pay_asset, Decimal(0))
            accepted = available >= cost
            if accepted:
                held[pay_asset] = _EXACT.subtract(available, cost)
                held[gain_asset] = _EXACT.add(held.get(gain_asset, Decimal(0)), gain)
            rows.append((portfolio, order, accepted, cost, available))
        yield pd.DataFrame(rows, columns=["portfolio_id", "id", "accepted", "required", "available"])


#: Blocks of long portfolios are folded side by side for so many rounds at most, and as long as a round leaves no more than
#: this share of the blocks open that the one before left; what is open then is folded in order.
ROUNDS, STILL_OPEN = 16, 0.75
_BLOCK_FOLD = (
    f"portfolio_id long, {BLOCK} long, asset_id long, id long, accepted boolean, required decimal(38,18), "
    "available decimal(38,18), start decimal(38,18), delta decimal(38,18), slack decimal(38,18), lack decimal(38,18)"
)


def _fold_block(fills: pd.DataFrame, starts: pd.DataFrame) -> pd.DataFrame:
    """The fills of one block in order, from given balances.

    A row for every fill, and one for every asset: what it began with and gained, the least an accepted fill left
    (``slack``) and the least a rejected one lacked (``lack``).
    """
    names = [field.split()[0] for field in _BLOCK_FOLD.split(", ")]
    if fills.empty:
        return pd.DataFrame([], columns=names, dtype=object)
    fills = fills.sort_values(ROW)
    place = (int(fills.portfolio_id.iloc[0]), int(fills[BLOCK].iloc[0]))
    begun = {int(asset): start for asset, start in zip(starts.asset_id, starts.start)}
    held, slack, lack, rows = dict(begun), {}, {}, []
    for order, pay, cost, asset, gain in zip(fills.id, fills.pay_asset, fills.cost, fills.gain_asset, fills.gain):
        available = held[pay]
        left = _EXACT.subtract(available, cost)
        if left >= 0:
            held[pay] = left
            held[asset] = _EXACT.add(held[asset], gain)
            slack[pay] = min(left, slack.get(pay, left))
        else:
            lack[pay] = min(-left, lack.get(pay, -left))
        rows.append((*place, int(pay), int(order), left >= 0, cost, available, None, None, None, None))
    for asset, start in begun.items():
        moved = _EXACT.subtract(held[asset], start)
        rows.append((*place, asset, None, None, None, None, start, moved, slack.get(asset), lack.get(asset)))
    return pd.DataFrame(rows, columns=names, dtype=object)


def _settle_blocks(legs: DataFrame, balances: DataFrame, size: int) -> DataFrame:
    """L2 for long portfolios: blocks of ``size`` fills folded side by side, in rounds.

    The first round guesses the balances at the start of a block.  What the folded blocks add up to gives new starts.  A
    block keeps its verdicts as long as every asset's start moved by no more than its accepted fills left and by less than
    its rejected ones lacked; only the other blocks are folded again, the first of them from its true start.  Scattered
    shortfalls are settled in a few rounds.  In a portfolio that is short all the time every verdict hangs on the one
    before, so a round settles little more than one block; its rest goes through one task in order, as does no other.
    """
    block, place, nothing = ["portfolio_id", BLOCK], ["portfolio_id", BLOCK, "asset_id"], F.lit(0).cast(QUANTITY)
    numbered = number_rows(legs, ["portfolio_id"], ["created_ts", "id"])
    own = F.floor((F.col(ROW) - 1) / F.lit(size)).cast("long")
    fills = stage(numbered.withColumn(BLOCK, own), "fills")
    opening = balances.groupBy("portfolio_id", "asset_id").agg(F.sum(F.col("qty").cast(QUANTITY)).cast(QUANTITY).alias("_opening"))
    before = Window.partitionBy("portfolio_id", "asset_id").orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)

    def starts(deltas: DataFrame) -> DataFrame:
        """Every asset a block touches and its balance at the start, given what the blocks add."""
        moved = F.coalesce(F.sum("delta").over(before).cast(QUANTITY), nothing)
        known = deltas.withColumn("_moved", moved).join(opening, ["portfolio_id", "asset_id"], "left")
        start = _wide(F.coalesce("_opening", nothing)) + _wide(F.col("_moved"))
        return known.select(*place, start.cast(QUANTITY).alias("start"))

    def move(asset: str, amount: Column) -> Column:
        return F.struct(F.col(asset).alias("asset_id"), amount.cast(QUANTITY).alias("delta"))

    both = F.explode(F.array(move("pay_asset", -F.col("cost")), move("gain_asset", F.col("gain"))))
    all_accepted = fills.select(*block, both.alias("_m")).select(*block, "_m.*").groupBy(*place).agg(
        F.sum("delta").cast(QUANTITY).alias("delta")
    )
    guess = F.when(F.col(BLOCK) == 0, F.col("start")).otherwise(F.greatest("start", nothing))
    todo = stage(starts(all_accepted).withColumn("start", guess), "starts")
    rounds, waiting = [], fills.select(*block).distinct().count()
    for turn in range(ROUNDS):
        again = fills if turn == 0 else fills.join(todo.select(*block).distinct(), block, "left_semi")
        folded = again.groupBy(*block).cogroup(todo.groupBy(*block)).applyInPandas(_fold_block, _BLOCK_FOLD)
        rounds.append(stage(folded.withColumn("_turn", F.lit(turn)), "folded"))
        every = stack(*rounds) if turn else rounds[0]
        newest = every.where(F.col("id").isNull()).groupBy(*block).agg(F.max("_turn").alias("_turn"))
        current = every.join(newest, [*block, "_turn"])
        assets = current.where(F.col("id").isNull()).select(*place, "delta", "slack", "lack", F.col("start").alias("_from"))
        shifted = assets.join(starts(assets.select(*place, "delta")), place)
        shift = _wide(F.col("start")) - _wide(F.col("_from"))
        broken = F.coalesce(shift + F.col("slack") < 0, F.lit(False)) | F.coalesce(shift >= F.col("lack"), F.lit(False))
        checked = stage(shifted.withColumns({"_shift": shift.cast(QUANTITY), "_broken": broken}), "checked")
        open_blocks = checked.where("_broken").select(*block).distinct()
        todo = stage(checked.join(open_blocks, block, "left_semi").select(*place, "start"), "starts")
        before_it, waiting = waiting, todo.select(*block).distinct().count()
        if waiting == 0 or waiting > STILL_OPEN * before_it:
            break
    by_pay = checked.select(*place, "_shift")
    # The balances moved without changing a verdict.
    right = current.where(F.col("id").isNotNull()).join(by_pay, place).withColumn(
        "available", (_wide(F.col("available")) + _wide(F.col("_shift"))).cast(QUANTITY)
    )
    names = ["portfolio_id", "id", "accepted", "required", "available"]
    if waiting == 0:
        return right.select(*names)
    first = stage(todo.groupBy("portfolio_id").agg(F.min(BLOCK).alias("_first")), "open")
    settled = right.join(first, "portfolio_id", "left").where(F.col("_first").isNull() | (F.col(BLOCK) < F.col("_first")))
    moved = checked.join(first, "portfolio_id").where(F.col(BLOCK) < F.col("_first")).select("portfolio_id", "asset_id", "delta")
    held = stack(opening.withColumnRenamed("_opening", "delta").select(*moved.columns), moved).groupBy("portfolio_id", "asset_id").agg(
        F.sum("delta").cast(QUANTITY).alias("qty")
    )
    rest = fills.join(first, "portfolio_id").where(F.col(BLOCK) >= F.col("_first"))
    in_order = _folded(rest.select(*legs.columns), held.join(first, "portfolio_id", "left_semi"))
    return stack(settled.select(*names), in_order)


def _folded(legs: DataFrame, balances: DataFrame) -> DataFrame:
    """Whole portfolios in order, streamed through one task each."""
    opening = balances.select(
        "portfolio_id", F.lit(True).alias("opening"), F.lit(-1).cast("long").alias("id"),
        F.timestamp_micros(F.lit(0)).alias("created_ts"),
        F.col("asset_id").alias("pay_asset"), F.col("qty").cast(QUANTITY).alias("cost"),
        F.col("asset_id").alias("gain_asset"), F.lit(0).cast(QUANTITY).alias("gain"),
    )
    stream = stack(opening, legs.withColumn("opening", F.lit(False)).select(*opening.columns))
    return (
        stream.repartition("portfolio_id")
        .sortWithinPartitions("portfolio_id", F.col("opening").desc(), "created_ts", "id")
        .select("portfolio_id", "opening", "id", "pay_asset", "cost", "gain_asset", "gain")
        .mapInPandas(_fold, _SETTLED)
    )


def settle(filled: DataFrame, balances: DataFrame, span: str = LEDGER_CHUNK, size: int = BLOCK_ROWS) -> DataFrame:
    """L2: whether each fill finds enough of the asset it pays with, in
    (created_ts, id) order, each acceptance changing the balances of the next.

    Portfolios in which no shortfall occurs even if everything is accepted are
    settled by their running balances.  Of the others, those of at most ``size``
    fills are folded in order, many in a task; longer ones are cut into blocks that
    are folded side by side until their starts fit (``_settle_blocks``).
    """
    buy = F.col("side") == "buy"
    sides = {
        "pay_asset": F.when(buy, F.col("quote_asset_id")).otherwise(F.col("base_asset_id")),
        "cost": F.when(buy, F.col("notional")).otherwise(F.col("quantity")).cast(QUANTITY),
        "gain_asset": F.when(buy, F.col("base_asset_id")).otherwise(F.col("quote_asset_id")),
        "gain": F.when(buy, F.col("quantity")).otherwise(F.col("notional")).cast(QUANTITY),
        "created_ts": F.col("created_ts").cast("timestamp"),
    }
    legs = filled.withColumns(sides).select("portfolio_id", "id", "created_ts", "pay_asset", "cost", "gain_asset", "gain")
    screened = stage(running_balances(filled, balances, span), "screened")
    paying = (F.col("id") >= 0) & (F.col("leg") == 0)
    portfolios = screened.groupBy("portfolio_id").agg(F.min("balance").alias("_least"), F.count_if(paying).alias("_fills"))
    short = stage(portfolios.where(F.col("_least") < 0).select("portfolio_id", (F.col("_fills") > size).alias("_long")), "short")

    fine = screened.filter(paying).join(short, "portfolio_id", "left_anti")
    parallel = fine.select(
        "portfolio_id", "id", F.lit(True).alias("accepted"), (-F.col("delta")).cast(QUANTITY).alias("required"),
        (_wide(F.col("balance")) - _wide(F.col("delta"))).cast(QUANTITY).alias("available"),
    )

    def of(rows: DataFrame, chosen: Column) -> DataFrame:
        return rows.join(short.where(chosen), "portfolio_id", "left_semi")

    parts = [parallel, _folded(of(legs, ~F.col("_long")), of(balances, ~F.col("_long")))]
    if short.where("_long").take(1):
        parts.append(_settle_blocks(of(legs, F.col("_long")), of(balances, F.col("_long")), size))
    return stack(*parts)


def closing_balances(filled: DataFrame, settled: DataFrame, balances: DataFrame) -> DataFrame:
    """L2: balances after the accepted fills."""
    done = filled.join(settled.filter("accepted").select("portfolio_id", "id"), ["portfolio_id", "id"], "left_semi")
    moves = postings(done).select("portfolio_id", "asset_id", "delta")
    opening = balances.select("portfolio_id", "asset_id", F.col("qty").cast(QUANTITY).alias("delta"))
    return (
        stack(opening, moves)
        .groupBy("portfolio_id", "asset_id")
        .agg(F.sum("delta").cast(QUANTITY).alias("qty"))
    )


def filled_orders(orders: DataFrame, settled: DataFrame, at: Column) -> DataFrame:
    """L3: orders with the accepted ones set to filled."""
    done = settled.filter("accepted").select("id", F.lit(True).alias("_done"))
    hit = F.coalesce("_done", F.lit(False))
    return (
        orders.join(done, "id", "left")
        .withColumns(
            {
                "status": F.when(hit, "filled").otherwise(F.col("status")),
                "updated_ts": F.when(hit, at.cast("timestamp")).otherwise(F.col("updated_ts").cast("timestamp")),
            }
        )
        .drop("_done")
    )


def new_trades(filled: DataFrame, settled: DataFrame, at: Column) -> DataFrame:
    """L3: a trade for every accepted fill."""
    done = settled.filter("accepted").select("id")
    return filled.join(done, "id", "left_semi").select(
        "portfolio_id", "symbol_id", "exchange_id", F.col("id").alias("order_id"),
        F.concat(F.lit("exec_"), F.col("id").cast("string"), F.lit("_"), F.unix_millis(at.cast("timestamp"))).alias(
            "external_trade_id"
        ),
        "side", F.col("fill_price").alias("price"), "quantity", "notional", at.alias("trade_ts"),
    )


def cancel_orders(orders: DataFrame, requests: DataFrame, portfolios: DataFrame, at: Column) -> DataFrame:
    """L4: live orders whose owner asks for it become canceled; the others stay."""
    owners = portfolios.select(F.col("id").alias("portfolio_id"), "user_id")
    asked = requests.select(F.col("order_id").alias("id"), "user_id").distinct()
    hits = (
        orders.filter(F.col("status").isin(LIVE_STATUS))
        .select("id", "portfolio_id")
        .join(asked, "id")
        .join(owners, ["portfolio_id", "user_id"], "left_semi")
        .select("id", F.lit(True).alias("_hit"))
    )
    hit = F.coalesce("_hit", F.lit(False))
    return (
        orders.join(hits, "id", "left")
        .withColumns(
            {
                "status": F.when(hit, "canceled").otherwise(F.col("status")),
                "updated_ts": F.when(hit, at.cast("timestamp")).otherwise(F.col("updated_ts").cast("timestamp")),
            }
        )
        .drop("_hit")
    )


# --- deposits and withdrawals -------------------------------------------------------------


def transfer_error() -> Column:
    """Reason why a deposit or withdrawal is refused, or null."""
    return F.when(~F.coalesce(F.col("qty") > 0, F.lit(False)), BAD_QUANTITY).when(
        ~F.coalesce(F.col("operation").isin("add", "subtract"), F.lit(False)),
        BAD_OPERATION,
    )


def apply_transfers(
    transfers: DataFrame, balances: DataFrame | None = None, span: str = LEDGER_CHUNK
) -> DataFrame:
    """The balance after every accepted deposit or withdrawal; a withdrawal
    takes at most what is there.

    With S the running sum of the signed amounts, the floored balance is
    S - min(0, running minimum of S).
    """
    good = transfers.filter(transfer_error().isNull())
    amount = F.col("qty").cast(QUANTITY)
    moves = good.select(
        "portfolio_id", "asset_id", F.col("created_ts").cast("timestamp").alias("created_ts"), "id",
        F.when(F.col("operation") == "add", amount).otherwise(-amount).cast(QUANTITY).alias("delta"),
    )
    if balances is not None:
        opening = balances.select(
            "portfolio_id", "asset_id", F.timestamp_micros(F.lit(0)).alias("created_ts"),
            F.lit(-1).cast("long").alias("id"), F.col("qty").cast(QUANTITY).alias("delta"),
        )
        moves = stack(opening, moves)
    keys, order = ["portfolio_id", "asset_id"], ["created_ts", "id"]
    summed = running(moves, keys, order, {"_sum": ("sum", "delta")}, span)
    lowest = running(summed, keys, order, {"_low": ("min", "_sum")}, span)
    floor = F.least(F.col("_low"), F.lit(0).cast(QUANTITY))
    balance = _wide(F.col("_sum")) - _wide(floor)
    return lowest.filter(F.col("id") >= 0).select(
        *keys, *order, "delta", balance.cast(QUANTITY).alias("balance")
    )


# --- upserts --------------------------------------------------------------------------------


def upsert_latest(current: DataFrame, updates: DataFrame, keys: list[str], version: list[str]) -> DataFrame:
    """L6, DO UPDATE: the row with the highest version of every key.

    Spark keeps one row per key and input partition before the shuffle.  The
    version has to tell the rows of a key apart.
    """
    newest = Window.partitionBy(*keys).orderBy(*[F.col(v).desc() for v in version])
    return stack(current, updates).withColumn("_n", F.row_number().over(newest)).filter("_n = 1").drop("_n")


def insert_missing(current: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """L6, DO NOTHING: the current rows, and the updates whose key is new."""
    fresh = updates.join(current.select(*keys), keys, "left_anti").dropDuplicates(keys)
    return stack(current, fresh)


# --- intake ---------------------------------------------------------------------------------


def _looked_up(requests: DataFrame, portfolios: DataFrame, symbols: DataFrame, exchanges: DataFrame) -> DataFrame:
    owners = portfolios.select(F.col("id").alias("portfolio_id"), "user_id", F.lit(True).alias("_owned"))
    pairs = symbols.select(F.col("id").alias("symbol_id"), "symbol")
    codes = exchanges.select(F.col("id").alias("exchange_id"), F.col("code").alias("exchange_code"))
    # An empty code counts as not given.
    named = requests.withColumn(
        "exchange_code", F.coalesce(F.nullif("exchange_code", F.lit("")), F.lit(DEFAULT_EXCHANGE))
    )
    return (
        named.join(owners, ["portfolio_id", "user_id"], "left")
        .join(pairs, "symbol", "left")
        .join(codes, "exchange_code", "left")
        .withColumn(
            "reject_reason",
            F.when(F.col("_owned").isNull(), NOT_OWNED)
            .when(F.col("symbol_id").isNull(), F.concat(F.lit("Symbol "), F.col("symbol"), F.lit(" not found")))
            .when(F.col("exchange_id").isNull(), NO_EXCHANGE),
        )
        .drop("_owned")
    )


def order_intake(requests: DataFrame, portfolios: DataFrame, symbols: DataFrame, exchanges: DataFrame) -> DataFrame:
    """Order requests with ids resolved, status ``new``, or the reason of refusal.

    ``requests`` has request_id, portfolio_id, user_id, symbol, exchange_code,
    side, type, price, quantity, created_ts.
    """
    rows = _looked_up(requests, portfolios, symbols, exchanges)
    known = F.col("reject_reason").isNull()
    external = F.concat_ws(
        "_", F.col("user_id").cast("string"), F.unix_millis(F.col("created_ts").cast("timestamp")).cast("string"),
        F.col("request_id").cast("string"),
    )
    return rows.select(
        "request_id", "portfolio_id", "symbol_id", "exchange_id", "side", "type", "price", "quantity",
        F.when(known, "new").alias("status"), F.when(known, external).alias("external_order_id"),
        "created_ts", "reject_reason",
    )


def trade_intake(
    requests: DataFrame, portfolios: DataFrame, symbols: DataFrame, exchanges: DataFrame, assets: DataFrame, now: Column
) -> DataFrame:
    """Manual trades with ids resolved; an unknown fee asset is left empty, a
    missing trade time is ``now``."""
    fees = assets.select(F.col("id").alias("fee_asset_id"), F.col("code").alias("fee_asset_code"))
    rows = _looked_up(requests, portfolios, symbols, exchanges).join(fees, "fee_asset_code", "left")
    return rows.select(
        "request_id", "portfolio_id", "symbol_id", "exchange_id", "order_id",
        F.when(
            F.col("reject_reason").isNull(),
            F.concat(F.lit("manual_"), F.unix_millis(now.cast("timestamp")), F.lit("_"), F.col("request_id")),
        ).alias("external_trade_id"),
        "side", "price", "quantity", "fee_asset_id", "fee_amount",
        F.coalesce(F.col("trade_ts").cast("timestamp"), now.cast("timestamp")).alias("trade_ts"), "reject_reason",
    )


# --- positions and events ---------------------------------------------------------------------


def positions(trades: DataFrame) -> DataFrame:
    """Net quantity and average buy price per portfolio and symbol, in decimals; the average is divided last."""
    buy = F.col("side") == "buy"
    quantity, price = F.col("quantity").cast(QUANTITY), F.col("price").cast(PRICE)
    bought = F.sum(F.when(buy, quantity))
    paid = F.sum(F.when(buy, exact_product(price, quantity)))
    return trades.groupBy("portfolio_id", "symbol_id").agg(
        F.sum(F.when(buy, quantity).otherwise(-quantity)).cast(QUANTITY).alias("qty"),
        (paid.cast("double") / F.nullif(bought.cast("double"), F.lit(0.0))).alias("avg_price"),
    )


def current_state(events: DataFrame, key: str, stamp: str = "created_at", id_column: str = "id") -> DataFrame:
    """The last event of every key and the number of its events, in one aggregate."""
    last = F.max_by(F.struct("event_type", stamp), F.struct(stamp, id_column))
    grouped = events.groupBy(key).agg(last.alias("_last"), F.count(F.lit(1)).alias("events"))
    return grouped.select(
        key, F.col("_last.event_type").alias("last_event"), F.col(f"_last.{stamp}").alias("last_at"), "events"
    )


def event_counts(events: DataFrame, vocabulary: list[str] | None = None) -> DataFrame:
    """Events per type, and whether the type is in the vocabulary."""
    counts = events.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"))
    if vocabulary is None:
        return counts
    return counts.withColumn("known", F.col("event_type").isin(vocabulary))


def platform_status(status: Column) -> Column:
    """The platform's name of an order service's status; other names are the same."""
    pairs = [F.lit(x) for pair in PLATFORM_STATUS.items() for x in pair]
    return F.coalesce(F.element_at(F.create_map(*pairs), status), status)


def service_status(status: Column) -> Column:
    """The order service's name of a platform's status."""
    return F.when(status == PLATFORM_STATUS["pending"], "pending").otherwise(status)


def replay_orders(
    events: DataFrame, key: str = "order_id", stamp: str = "created_at", id_column: str = "id", size: int = BLOCK_ROWS
) -> DataFrame:
    """Every event with the order's ``status`` after it and whether it was ``accepted``.

    Events are taken in the order of (time, id).  One that the status doesn't allow, or of an unknown type, changes
    nothing.  An event maps statuses to statuses, and such maps can be put together: every chunk of ``size`` events of an
    order becomes one map, the maps give each chunk the status it starts from, and the chunks are replayed side by side.
    """
    names = list(dict.fromkeys(status for status, _ in ORDER_TRANSITIONS.values()))
    states: list[str | None] = [None, *names]
    kinds = list(ORDER_TRANSITIONS)
    # What follows each status (by row) on each event, and on an unknown one; -1 where that is not allowed.
    follows = [
        states.index(ORDER_TRANSITIONS[k][0]) if s in ORDER_TRANSITIONS[k][1] else -1 for s in states for k in kinds
    ]
    table = F.array(*[F.lit(f) for f in follows])

    def allowed(state: Column, kind: Column) -> Column:
        at = F.element_at(table, (state * len(kinds) + kind + 1).cast("int"))
        return F.when(kind < len(kinds), at).otherwise(F.lit(-1))

    def after(state: Column, kind: Column) -> Column:
        following = allowed(state, kind)
        return F.when(following >= 0, following).otherwise(state)

    kind = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(i)) for i, k in enumerate(kinds)], F.lit(len(kinds)))
    rows = events.select(key, stamp, F.col(id_column).alias("_id"), kind.alias("_kind"))
    numbered = number_rows(rows, [key], [stamp, "_id"])
    chunk = F.floor((F.col(ROW) - 1) / F.lit(size)).cast("long").alias("_chunk")
    steps = F.array_sort(F.collect_list(F.struct(F.col(ROW).alias("row"), F.col("_id").alias("id"), F.col("_kind").alias("kind"))))
    chunks = numbered.groupBy(key, chunk).agg(steps.alias("_steps"))
    mapped = F.transform(
        F.sequence(F.lit(0), F.lit(len(states) - 1)),
        lambda s: F.aggregate("_steps", s, lambda state, step: after(state, step["kind"])),
    )
    chunks = chunks.withColumn("_map", mapped)
    # One small row for each chunk of an order.
    starts = chunks.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("_chunk", "_map"))).alias("_maps")).select(
        key,
        F.inline(
            F.aggregate(
                "_maps",
                F.struct(F.lit(0).alias("now"), F.expr("cast(array() as array<struct<_chunk: bigint, _start: int>>)").alias("seen")),
                lambda all_, m: F.struct(
                    F.element_at(m["_map"], all_["now"] + 1).alias("now"),
                    F.concat(all_["seen"], F.array(F.struct(m["_chunk"].alias("_chunk"), all_["now"].alias("_start")))).alias("seen"),
                ),
            )["seen"]
        ),
    )
    out = f"array<struct<row: bigint, id: {events.schema[id_column].dataType.simpleString()}, state: int, accepted: boolean>>"
    replayed = F.aggregate(
        "_steps",
        F.struct(F.col("_start").alias("now"), F.expr(f"cast(array() as {out})").alias("seen")),
        lambda all_, step: F.struct(
            after(all_["now"], step["kind"]).alias("now"),
            F.concat(
                all_["seen"],
                F.array(
                    F.struct(
                        step["row"].alias("row"), step["id"].alias("id"), after(all_["now"], step["kind"]).alias("state"),
                        (allowed(all_["now"], step["kind"]) >= 0).alias("accepted"),
                    )
                ),
            ).alias("seen"),
        ),
    )["seen"]
    found = chunks.select(key, "_chunk", "_steps").join(starts, [key, "_chunk"]).select(key, F.inline(replayed))
    named = F.array(*[F.lit(s).cast("string") for s in states])
    return found.select(
        key, F.col("row").alias("number"), F.col("id").alias(id_column), F.element_at(named, F.col("state") + 1).alias("status"), "accepted"
    )


def replayed_state(replayed: DataFrame, key: str = "order_id") -> DataFrame:
    """Status of every order after its replay, in both vocabularies, and its accepted and rejected events."""
    grouped = replayed.groupBy(key).agg(
        F.max_by("status", "number").alias("status"),
        F.count_if("accepted").alias("accepted"),
        F.count_if(~F.col("accepted")).alias("rejected"),
    )
    return grouped.withColumn("platform_status", platform_status(F.col("status")))
