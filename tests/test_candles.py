import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import TRADE_DDL, at, trade
from tickloom.operators import book
from tickloom.operators import candles as C
from tickloom.operators.refresh import refresh_rollups


def made(spark, rows):
    return spark.createDataFrame(rows, TRADE_DDL)


def test_open_and_close_follow_event_time(spark):
    late_first = [trade(second=50, price=3.0, trade_id="c"), trade(second=1, price=1.0, trade_id="a"), trade(second=30, price=9.0, trade_id="b")]
    row = C.trade_candles(made(spark, late_first)).first()
    assert (row.open, row.high, row.low, row.close, row.volume, row.trades_count) == (1.0, 9.0, 1.0, 3.0, 3.0, 3)
    assert row.open_time == at(0) and row.close_time == at(60)


def test_inclusive_close_time(spark):
    row = C.trade_candles(made(spark, [trade(second=61)]), inclusive=True).first()
    assert row.close_time == at(119.999999)


def test_ties_do_not_depend_on_the_layout(spark):
    rows = [trade(second=5, price=float(i), trade_id=str(i)) for i in range(50)]
    seen = {
        tuple(C.trade_candles(made(spark, rows[::step]).repartition(parts)).select("open", "close").first())
        for step, parts in ((1, 1), (-1, 3), (1, 4))
    }
    assert len(seen) == 1


def test_unfinished_candles_wait(spark):
    rows = made(spark, [trade(second=59), trade(second=60), trade(second=119)])
    as_of = F.lit("2024-01-01 00:01:30").cast("timestamp")
    assert [r.open_time for r in C.trade_candles(rows, as_of=as_of).collect()] == [at(0)]
    assert C.trade_candles(rows).count() == 2


def test_aggregation_hashes_on_both_sides(spark):
    plan = C.trade_candles(made(spark, [trade()]))._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan and "partial_min_by" in plan


@pytest.mark.parametrize("span,minutes", [("5 minutes", 5), ("15 minutes", 15), ("1 hour", 60)])
def test_rollup_equals_direct_candles(spark, span, minutes):
    rows = made(spark, [trade(second=37 * i, price=100.0 + (i * 7 % 13), trade_id=str(i)) for i in range(500)])
    columns = ["symbol", "open_time", "open", "high", "low", "close", "volume", "trades_count"]
    rolled = C.rollup_candles(C.trade_candles(rows), span)
    direct = C.trade_candles(rows, span)
    assert rolled.select(columns).exceptAll(direct.select(columns)).count() == 0
    assert rolled.count() == direct.count() == -(-500 * 37 // (minutes * 60))


def test_merged_exchanges_tie_by_exchange(spark):
    ddl = "symbol_id long, exchange_id long, open_ts timestamp, open double, high double, low double, close double, volume double"
    rows = [(1, 2, at(0), 20.0, 21.0, 19.0, 20.5, 1.0), (1, 1, at(0), 10.0, 11.0, 9.0, 10.5, 1.0)]
    symbols = spark.createDataFrame([(1, "BTCUSDT")], "id long, symbol string")
    named = book.symbol_candles(spark.createDataFrame(rows, ddl), symbols)
    row = C.rollup_candles(named, "5 minutes", tiebreak="exchange_id").first()
    assert (row.open, row.close, row.high, row.low, row.candles_count) == (10.0, 20.5, 21.0, 9.0, 2)


def test_latest_price(spark):
    rows = made(spark, [trade(second=7300, price=5.0), trade(second=10, price=9.0), trade("ETHUSDT", 3, 2.0)])
    got = {r.symbol: (r.price, r.price_time) for r in C.latest_price(rows).collect()}
    assert got == {"BTCUSDT": (5.0, at(7300)), "ETHUSDT": (2.0, at(3))}


def test_incremental_refresh_replaces_only_touched_days(spark, tmp_path):
    day = 86400
    rows = [trade(second=day * d + 600 * i, price=100.0 + d, trade_id=f"{d}-{i}") for d in range(3) for i in range(20)]
    candles = C.trade_candles(made(spark, rows))
    refresh_rollups(candles, str(tmp_path))
    changed = candles.withColumn("close", F.col("close") + 1000)
    touched = spark.createDataFrame([(dt.date(2024, 1, 2),)], "open_date date")
    hours = refresh_rollups(changed, str(tmp_path), touched)["1h"]
    got = {r.d: (r.n, r.c > 1000) for r in hours.groupBy(F.to_date("open_time").alias("d")).agg(F.count("*").alias("n"), F.max("close").alias("c")).collect()}
    assert got == {dt.date(2024, 1, 1): (4, False), dt.date(2024, 1, 2): (4, True), dt.date(2024, 1, 3): (4, False)}


def test_grid_and_synthetic_candles(spark):
    pairs = spark.createDataFrame([(1, 0, at(86400 - 90), at(86400 + 150))], "symbol_id long, exchange_id long, start timestamp, end timestamp")
    grid = book.candle_grid(pairs, "1 minute")
    assert sorted(r.open_ts for r in grid.collect()) == [at(86400 - 90 + 60 * i) for i in range(5)]
    existing = grid.limit(1).select("symbol_id", "exchange_id", "open_ts")
    first = book.synthetic_candles(grid, existing, 100.0, 10.0)
    assert first.count() == 4
    assert first.exceptAll(book.synthetic_candles(grid.repartition(3), existing, 100.0, 10.0)).count() == 0
    assert first.filter(~F.col("close").between(100, 110)).count() == 0


def test_ties_are_settled_by_id(spark):
    """Trades of one instant, in any partitioning: the least id opens, the greatest closes."""
    from tickloom.streaming.jobs import latest_price_stream

    rows = [trade(price=float(i), trade_id=str(i)) for i in (11, 3, 9, 10, 5)]
    for parts in (1, 2, 4):
        frame = spark.createDataFrame(rows, TRADE_DDL).repartition(parts)
        candle = C.trade_candles(frame).first()
        assert (candle.open, candle.close) == (3.0, 11.0)
        assert C.latest_price(frame).first().price == latest_price_stream(frame).first().price == 11.0
    named = [trade(price=1.0, trade_id="b-2"), trade(price=2.0, trade_id="a-9"), trade(price=3.0, trade_id="7")]
    candle = C.trade_candles(spark.createDataFrame(named, TRADE_DDL)).first()
    assert (candle.open, candle.close) == (3.0, 1.0)


def id_key(text):
    """Whole numbers by value, then other texts, then null."""
    if text is None:
        return (2, 0, "")
    return (0, int(text), "") if text == "0" or (text.isdigit() and text[0] != "0") else (1, 0, text)


def test_long_ids_are_compared_whole(spark):
    """UUIDs, ids of equal first bytes, of 20 digits, signed, padded and null ones at the same instants."""
    ids = [f"aaaaaaaa-{i}" for i in range(1, 9)] + ["aaaaaaaa", "aaaaaaaa-10", "9" * 20, "1" + "0" * 20, "-5", "007", " 8", "é", None]
    ids += ["12", "9", "10", str(2**63 - 1), str(2**63), "12345678901234567890123456789012345678901234567890"]
    rows = [trade(second=s, price=float(100 * s + i), trade_id=t) for s in (3, 9) for i, t in enumerate(ids)]
    # One candle of numbers only, one of names only, and one each whose ends are of the other kind.
    rows += [trade(second=60 + i, price=float(i), trade_id=str(9 - i)) for i in range(4)]
    rows += [trade(second=120, price=float(i), trade_id=f"x{i}") for i in range(12)]
    rows += [trade(second=180, price=1.0, trade_id="b"), trade(second=181, price=2.0, trade_id="4"), trade(second=182, price=3.0, trade_id="a")]
    rows += [trade(second=240, price=1.0, trade_id="5"), trade(second=240, price=2.0, trade_id="b"), trade(second=241, price=3.0, trade_id="4")]
    frame, place = spark.createDataFrame(rows, TRADE_DDL), {n: i for i, n in enumerate(f.strip().split()[0] for f in TRADE_DDL.split(","))}
    groups = {}
    for row in rows:
        row = row if isinstance(row, tuple) else tuple(row.values())
        stamp = row[place["timestamp"]]
        groups.setdefault(stamp.replace(second=0), []).append((stamp, id_key(row[place["trade_id"]]), row[place["price"]]))
    expected = {minute: (min(events)[2], max(events)[2], len(events)) for minute, events in groups.items()}
    latest = max(e for events in groups.values() for e in events)[2]
    for parts in (1, 3, 7):
        dealt = frame.repartition(parts)
        got = {r.open_time: (r.open, r.close, r.trades_count) for r in C.trade_candles(dealt).collect()}
        assert got == expected
        assert [r.price for r in C.latest_price(dealt).collect()] == [latest]
    from tickloom.streaming.jobs import candle_stream

    streamed = candle_stream(frame).collect()
    assert {r.window.start: (r.open, r.close, r.trades_count) for r in streamed} == expected
