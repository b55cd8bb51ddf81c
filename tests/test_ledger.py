"""Settlement, transfers and the rest of the book against plain loops."""

import random
from decimal import Decimal

import pytest
from pyspark.errors import ArithmeticException
from pyspark.sql import functions as F

from helpers import at
from tickloom.operators import audit as U
from tickloom.operators import book as K
from tickloom.operators import ledger as L

FILL_DDL = (
    "id long, portfolio_id long, symbol_id long, exchange_id long, side string, price decimal(20,8), quantity decimal(38,18), "
    "created_ts timestamp, base_asset_id long, quote_asset_id long, execution_price decimal(20,8)"
)
BALANCE_DDL = "portfolio_id long, asset_id long, qty decimal(38,18)"
D = Decimal


def order(i, portfolio, side, price, quantity, second=None, base=1, execution=None):
    return (i, portfolio, base, 0, side, D(price), D(quantity), at(second if second is not None else i), base, 0, None if execution is None else D(execution))


def loop(orders, balances):
    held = {(p, a): q for p, a, q in balances}
    out = {}
    for o in sorted(orders, key=lambda o: (o[7], o[0])):
        i, portfolio, _, _, side, price, quantity, _, base, quote, execution = o
        fill = execution or price or D(0)
        pay, cost, get, gain = (quote, fill * quantity, base, quantity) if side == "buy" else (base, quantity, quote, fill * quantity)
        free = held.get((portfolio, pay), D(0))
        out[i] = free >= cost
        if out[i]:
            held[portfolio, pay] = free - cost
            held[portfolio, get] = held.get((portfolio, get), D(0)) + gain
    return out, held


def settled(spark, orders, balances):
    fills = L.fills(spark.createDataFrame(orders, FILL_DDL))
    held = spark.createDataFrame(balances, BALANCE_DDL)
    done = L.settle(fills, held)
    closing = {(r.portfolio_id, r.asset_id): r.qty for r in L.closing_balances(fills, done, held).collect()}
    return {r.id: r.accepted for r in done.collect()}, closing


def test_settlement_equals_the_loop(spark):
    rng = random.Random(5)
    balances = [(p, 0, D(rng.randint(0, 4000))) for p in range(12)] + [(p, 1, D(rng.randint(0, 5))) for p in range(0, 12, 2)]
    # Portfolio 0 holds a third of the orders; portfolio 11 is rich and never short.
    balances = [b for b in balances if b[0] != 11] + [(11, 0, D(10**9)), (11, 1, D(10**6)), (11, 2, D(10**6))]
    orders = [
        order(i, 0 if i % 3 == 0 else rng.randint(1, 11), rng.choice(["buy", "sell"]), str(rng.randint(1, 900)),
              str(rng.randint(1, 400) / 100), second=rng.randint(0, 400000), base=rng.choice([1, 2]),
              execution=rng.choice([None, "0", "17.5"]))
        for i in range(1, 400)
    ]
    expected, held = loop(orders, balances)
    got, closing = settled(spark, orders, balances)
    assert got == expected
    assert {k: v for k, v in closing.items() if v} == {k: v for k, v in held.items() if v}
    assert len(set(expected.values())) == 2


def free_balances(orders, balances):
    """What every order finds of the asset it pays with."""
    held, free = {(p, a): q for p, a, q in balances}, {}
    for o in sorted(orders, key=lambda o: (o[7], o[0])):
        pay = o[9] if o[4] == "buy" else o[8]
        cost, gain = (o[5] * o[6], o[6]) if o[4] == "buy" else (o[6], o[5] * o[6])
        free[o[0]] = held.get((o[1], pay), D(0))
        if free[o[0]] >= cost:
            held[o[1], pay] = free[o[0]] - cost
            got = (o[1], o[8] if o[4] == "buy" else o[9])
            held[got] = held.get(got, D(0)) + gain
    return free


@pytest.mark.parametrize("cash,stock,rounds", [("90000", 60, 16), ("3000", 3, 16), ("3000", 3, 3), ("90000", 60, 1)])
def test_long_portfolios_are_settled_in_blocks(spark, monkeypatch, cash, stock, rounds):
    """Half of all orders in one portfolio, many at one instant, in blocks of sixteen: scattered shortfalls are settled by the
    rounds alone, what they leave open is folded in order."""
    monkeypatch.setattr(L, "ROUNDS", rounds)
    monkeypatch.setattr(L, "STILL_OPEN", 0.75 if rounds == 16 else 1.0)
    sequential, calls = L._folded, []
    monkeypatch.setattr(L, "_folded", lambda *given: calls.append(1) or sequential(*given))
    rng = random.Random(11)
    balances = [(p, 0, D(cash)) for p in range(5)] + [(p, a, D(stock)) for p in (0, 1, 3) for a in (1, 2, 3)] + [(9, 0, D(5))]
    orders = [
        order(i, 0 if i % 2 == 0 else rng.randint(1, 7), rng.choice(["buy", "buy", "sell"]), str(rng.randint(1, 900)),
              str(rng.randint(1, 400) / 100), second=3600 * rng.randint(0, 40), base=rng.choice([1, 2, 3]))
        for i in range(1, 700)
    ]
    expected, _ = loop(orders, balances)
    held = spark.createDataFrame(balances, BALANCE_DDL)
    got = L.settle(L.fills(spark.createDataFrame(orders, FILL_DDL)), held, size=16).collect()
    assert len(got) == len(orders) and {r.id: r.accepted for r in got} == expected
    assert {r.id: r.available for r in got} == free_balances(orders, balances)
    assert len({ok for i, ok in expected.items() if i % 2 == 0}) == 2
    assert len(calls) == 2 if stock == 3 else len(calls) == 1 or rounds == 1


@pytest.mark.parametrize("cash,accepted", [("100", True), ("99.999999999999999999", False), ("100.000000000000000001", True)])
def test_exact_balance(spark, cash, accepted):
    got, _ = settled(spark, [order(1, 1, "buy", "50", "2")], [(1, 0, D(cash))])
    assert got == {1: accepted}


def test_two_sells_against_one_holding(spark):
    got, closing = settled(spark, [order(1, 1, "sell", "10", "3"), order(2, 1, "sell", "10", "3")], [(1, 1, D(4))])
    assert got == {1: True, 2: False}
    assert closing == {(1, 1): D(1), (1, 0): D(30)}


def test_proceeds_pay_for_the_next(spark):
    got, _ = settled(spark, [order(1, 1, "buy", "10", "5"), order(2, 1, "sell", "10", "5"), order(3, 1, "buy", "10", "5")], [(1, 0, D(50))])
    assert got == {1: True, 2: True, 3: True}


def test_order_and_trade_outputs(spark):
    orders = [order(1, 1, "buy", "10", "5"), order(2, 1, "buy", "10", "5")]
    fills = L.fills(spark.createDataFrame(orders, FILL_DDL))
    done = L.settle(fills, spark.createDataFrame([(1, 0, D(60))], BALANCE_DDL))
    book = fills.select("id", F.lit("open").alias("status"), F.col("created_ts").alias("updated_ts"))
    now = F.lit(at(999))
    assert {r.id: r.status for r in L.filled_orders(book, done, now).collect()} == {1: "filled", 2: "open"}
    trades = L.new_trades(fills, done, now).collect()
    assert [(t.order_id, t.notional) for t in trades] == [(1, D(50))]


def test_transfers_equal_the_loop(spark):
    rng = random.Random(9)
    ddl = "portfolio_id long, asset_id long, id long, created_ts timestamp, qty decimal(38,18), operation string"
    rows = [
        (0 if i % 3 == 0 else rng.randint(1, 5), rng.randint(0, 1), i, at(rng.randint(0, 10) * 43200), D(rng.randint(-2, 100)),
         rng.choice(["add", "subtract", "subtract", "burn"]))
        for i in range(400)
    ]
    opening = [(p, 0, D(50)) for p in range(3)]
    held, expected = {(p, a): q for p, a, q in opening}, {}
    for p, a, i, _, qty, operation in sorted(rows, key=lambda r: (r[3], r[2])):
        if qty <= 0 or operation == "burn":
            continue
        now = held.get((p, a), D(0))
        held[p, a] = expected[i] = now + qty if operation == "add" else max(now - qty, D(0))
    out = L.apply_transfers(spark.createDataFrame(rows, ddl), spark.createDataFrame(opening, BALANCE_DDL))
    assert {r.id: r.balance for r in out.collect()} == expected


def test_cancel(spark):
    ddl = "id long, portfolio_id long, status string, updated_ts timestamp"
    orders = spark.createDataFrame([(1, 1, "new", at(0)), (2, 1, "filled", at(0)), (3, 2, "open", at(0)), (4, 1, "open", at(0))], ddl)
    asked = spark.createDataFrame([(1, 7), (1, 7), (2, 7), (3, 7)], "order_id long, user_id long")
    owners = spark.createDataFrame([(1, 7), (2, 8)], "id long, user_id long")
    out = {r.id: (r.status, r.updated_ts) for r in L.cancel_orders(orders, asked, owners, F.lit(at(5))).collect()}
    assert out == {1: ("canceled", at(5)), 2: ("filled", at(0)), 3: ("open", at(0)), 4: ("open", at(0))}


def test_upserts(spark):
    ddl = "k long, v long, note string"
    current, updates = spark.createDataFrame([(1, 5, "old"), (2, 5, "old")], ddl), spark.createDataFrame([(1, 9, "new"), (2, 1, "new"), (3, 1, "new")], ddl)
    assert {r.k: r.note for r in L.upsert_latest(current, updates, ["k"], ["v"]).collect()} == {1: "new", 2: "old", 3: "new"}
    assert {r.k: r.note for r in L.insert_missing(current, updates, ["k"]).collect()} == {1: "old", 2: "old", 3: "new"}


def test_seed_positions(spark):
    rows = [(1, 1, "buy", 89000.0, 0.05), (1, 1, "buy", 88500.0, 0.05), (1, 2, "buy", 3200.0, 1.0), (1, 2, "sell", 9999.0, 0.25)]
    out = {r.symbol_id: (float(r.qty), r.avg_price) for r in L.positions(spark.createDataFrame(rows, "portfolio_id long, symbol_id long, side string, price double, quantity double")).collect()}
    assert out[1] == (pytest.approx(0.1), pytest.approx(88750.0)) and out[2] == (0.75, 3200.0)


def test_valuation(spark):
    balances = spark.createDataFrame([(1, "USDT", 10000.0), (1, "BTC", 0.1), (1, "DOGE", 5.0), (2, "USDC", 0.0)], "portfolio_id long, asset_code string, qty double")
    prices = spark.createDataFrame([("BTCUSDT", 90000.0), ("ETHUSDT", 3000.0)], "symbol string, price double")
    out = {r.portfolio_id: (r.total_value, r.held_assets) for r in K.portfolio_value(K.priced_balances(balances, prices)).collect()}
    assert out == {1: (pytest.approx(19000.0), 3), 2: (0.0, 0)}


def test_portfolio_without_balances(spark):
    portfolios = spark.createDataFrame([(1, 1, "p", 3, at(0)), (2, 1, "q", 3, at(0))], "id long, user_id long, name string, base_currency_id long, created_at timestamp")
    assets = spark.createDataFrame([(1, "BTC", "Bitcoin"), (3, "USDT", "Tether")], "id long, code string, name string")
    balances = spark.createDataFrame([(1, 3, D(5)), (1, 1, D(1)), (2, 1, D(0))], BALANCE_DDL)
    rows = {r.id: r for r in K.nested_portfolios(portfolios, balances, assets).collect()}
    assert [b.asset_code for b in rows[1].balances] == ["BTC", "USDT"] and rows[2].balances == []


def test_pages(spark):
    rows = spark.createDataFrame([(p, i, at(i)) for p in (1, 2) for i in range(10)], "portfolio_id long, id long, ts timestamp")
    out = K.page(rows, "ts", limit=3, offset=2).collect()
    assert sorted((r.portfolio_id, r.id) for r in out) == [(p, i) for p in (1, 2) for i in (5, 6, 7)]
    assert [r.ts for r in K.single_page(rows, "ts", limit=2, offset=19).collect()] == [at(0)]


def test_order_sizing(spark):
    rows = [("BTCUSDT", "buy", 100.0, 9.0, 500.0, 2.0), ("BTCUSDT", "sell", 100.0, 0.5, 500.0, 2.0)]
    orders = spark.createDataFrame(rows, "symbol string, side string, amount double, quantity double, quote_qty double, base_qty double")
    prices = spark.createDataFrame([("BTCUSDT", 300.0)], "symbol string, price double")
    out = {r.side: r for r in K.size_orders(orders, prices).collect()}
    assert (out["buy"].quantity, out["buy"].amount, out["buy"].fee) == (0.33333333, 100.0, 0.1)
    assert (out["sell"].quantity, out["sell"].amount, out["sell"].max_quantity) == (0.5, 150.0, 2.0)


def test_audit_counts(spark):
    rows = spark.createDataFrame([(1, 5), (1, -1), (None, 2), (None, 3), (9, None)], "k long, v long")
    parent = spark.createDataFrame([(1,)], "id long")
    rules = U.audit([U.check_rule(rows, "c", F.col("v") >= 0), U.unique_rule(rows, "u", ["k"]), U.foreign_rule(rows, "f", "k", parent, "id")])
    assert {r.rule: r.violations for r in rules.collect()} == {"c": 1, "u": 1, "f": 1}


def test_event_replay(spark):
    rows = [(1, 1, "order.created", at(0)), (2, 1, "order.filled", at(5)), (3, 1, "order.submitted", at(5)), (4, 2, "odd", at(1))]
    events = spark.createDataFrame(rows, "id long, order_id long, event_type string, created_at timestamp")
    assert {r.order_id: (r.last_event, r.events) for r in L.current_state(events, "order_id").collect()} == {1: ("order.submitted", 3), 2: ("odd", 1)}
    assert {r.event_type: r.known for r in L.event_counts(events, ["order.created", "order.filled", "order.submitted"]).collect()}["odd"] is False


def test_products_keep_eighteen_digits(spark):
    """Literal products; the second needs the quantity's last digits, the third its size."""
    from tickloom.operators.normalize import exact_product

    cases = [
        ("50000.12345678", "0.123456789012345678", "6172.854692194924503578"),
        ("9000000", "123456789.123456789012", "1111111102111111.101108000000000000"),
        ("99999.99999999", "1000000000.000000000000000001", "99999999999990.000000000000100000"),
        ("0.5", "-0.000000000000000002", "-0.000000000000000001"),
    ]
    rows = spark.createDataFrame(cases, "price string, quantity string, product string")
    product = exact_product(F.col("price").cast("decimal(20,8)"), F.col("quantity").cast("decimal(38,18)"))
    for row in rows.select("product", product.alias("got")).collect():
        assert row.got == Decimal(row["product"])
    with pytest.raises(ArithmeticException):
        rows.limit(1).select(
            exact_product(F.lit(9000000).cast("decimal(20,8)"), F.lit("99999999999999").cast("decimal(38,18)"))
        ).collect()


def test_positions_add_decimals(spark):
    rows = [(1, 1, "buy", "1", "100000000.000000000000000001"), (1, 1, "sell", "1", "0.000000000000000003")]
    frame = spark.createDataFrame(rows, "portfolio_id long, symbol_id long, side string, price string, quantity string")
    assert str(L.positions(frame).first().qty) == "99999999.999999999999999998"
