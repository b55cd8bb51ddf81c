import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from helpers import TRADE_DDL, at, trade
from tickloom.functions import checks
from tickloom.operators import normalize as N
from tickloom.operators import quality as Q
from tickloom.sources.decode import decode_messages, kline_frames, kline_rows

def now():
    return F.lit("2024-01-01 01:00:00").cast("timestamp")


def made(spark, rows):
    return spark.createDataFrame(rows, TRADE_DDL)


def failure(spark, **fields):
    row = trade(**{"second": 3600, **fields})
    return made(spark, [row]).select(Q.row_failure(now()).alias("f")).first().f


@pytest.mark.parametrize(
    "fields,expected",
    [
        ({}, None),
        ({"symbol": None}, "completeness"),
        ({"price": 0.00001}, None),
        ({"price": 0.000009}, "validity"),
        ({"price": 10_000_000.0}, None),
        ({"price": 10_000_000.01}, "validity"),
        ({"price": float("nan")}, "validity"),
        ({"volume": 0.000001}, None),
        ({"volume": 0.0}, "validity"),
        ({"volume": 1_000_000.0}, None),
        ({"side": "Buy"}, "validity"),
        ({"source": "ByBit"}, None),
        ({"source": "kraken"}, "validity"),
        ({"trade_id": ""}, "validity"),
        ({"trade_id": "0"}, "consistency"),
        ({"symbol": "btcusdt"}, None),
        ({"symbol": "USDT"}, "consistency"),
        ({"symbol": "BTCUSD"}, "consistency"),
        ({"second": 3300}, None),
        ({"second": 3299}, "timeliness"),
        ({"second": 3610}, None),
        ({"second": 3611}, "timeliness"),
        # The first dimension that fails is the one reported.
        ({"symbol": "X", "side": "hold", "second": 0}, "validity"),
    ],
)
def test_row_dimensions(spark, fields, expected):
    assert failure(spark, **fields) == expected


def test_accuracy_needs_ten_trades_and_more_than_half(spark):
    def last(prior, price):
        rows = [trade(second=i, price=100.0, trade_id=str(i + 1)) for i in range(prior)]
        rows.append(trade(second=prior, price=price, trade_id="last"))
        return Q.gate(made(spark, rows), F.lit(at(60)).cast("timestamp")).filter("trade_id = 'last'").first().failed_dimension

    assert last(9, 1000.0) is None
    assert last(10, 1000.0) == "accuracy"
    assert last(10, 150.0) is None
    assert last(10, 150.01) == "accuracy"
    assert last(10, 49.99) == "accuracy"


def test_gate_keeps_every_record_and_reports(spark):
    rows = [trade(second=i, price=100.0, trade_id=str(i + 1)) for i in range(30)]
    rows += [trade(second=31, price=900.0, trade_id="a"), trade(second=1, side="hold"), trade(second=1, symbol=None)]
    judged = Q.gate(made(spark, rows), F.lit(at(60)).cast("timestamp"))
    report = Q.quality_report(judged).first()
    assert (report.all_records, report.accepted_records) == (33, 30)
    assert (report.failed_completeness, report.failed_validity, report.failed_accuracy) == (1, 1, 1)
    assert (report.score, report.score_ref, report.failure_rate_ref) == (90.91, 90.0, 10.0)
    assert Q.accepted(judged).count() == 30 and Q.rejected(judged).count() == 3


def test_report_of_nothing_and_negative_score(spark):
    empty = made(spark, []).withColumn("failed_dimension", F.lit(None).cast("string"))
    assert Q.quality_report(empty).first().score == 100.0
    judged = made(spark, [trade()] * 4).withColumn("failed_dimension", F.when(F.monotonically_increasing_id() % 2 == 0, "x"))
    bad = made(spark, [trade()] * 3).withColumn("failed_dimension", F.lit("validity"))
    one = made(spark, [trade()]).withColumn("failed_dimension", F.lit(None).cast("string"))
    assert Q.quality_report(bad.unionByName(one)).first().score_ref == -200.0
    assert judged.count() == 4


# --- order requests ---------------------------------------------------------------------------

UUID = "550e8400-e29b-41d4-a716-446655440000"
GOOD = {"portfolio_id": UUID, "symbol": "BTCUSDT", "type": "limit", "side": "buy", "quantity": 0.5, "price": 50000.0, "exchange_code": None}
REQUEST_DDL = "portfolio_id string, symbol string, type string, side string, quantity double, price double, exchange_code string, note string"


@pytest.mark.parametrize(
    "change,fields",
    [
        ({}, []),
        ({"portfolio_id": "invalid-uuid"}, ["portfolio_id"]),
        ({"symbol": "BTC"}, ["symbol"]),
        ({"quantity": -0.5}, ["quantity"]),
        ({"quantity": 1500.0}, ["quantity"]),
        ({"quantity": 1000.0}, []),
        ({"price": None}, ["price"]),
        ({"type": "stop_limit", "price": None}, ["price"]),
        ({"type": "market", "price": None}, []),
        ({"type": "market", "price": -1.0}, ["price"]),
        ({"exchange_code": "BYBIT"}, []),
        ({"exchange_code": "KRAKEN"}, ["exchange_code"]),
        ({"side": None, "type": None, "symbol": "x"}, ["symbol", "type", "side"]),
    ],
)
def test_order_requests(spark, change, fields):
    row = {**GOOD, **change, "note": "dropped"}
    out = Q.check_order_requests(spark.createDataFrame([tuple(row[k.split()[0]] for k in REQUEST_DDL.split(", "))], REQUEST_DDL))
    got = out.first()
    assert [e.field for e in got.errors] == fields
    assert got.is_valid == (not fields) and "note" not in out.columns
    if row["exchange_code"] is None:
        assert got.exchange_code == "BINANCE"


# --- wire formats -------------------------------------------------------------------------------


def decoded(spark, *values, topic="ethusdt-bybit"):
    rows = [(b"k", None if v is None else json.dumps(v).encode(), topic) for v in values]
    return decode_messages(spark.createDataFrame(rows, "key binary, value binary, topic string"))


def normal(spark, value, topic="ethusdt-bybit"):
    return N.normalise(decoded(spark, value, topic=topic), now()).first()


def test_canonical_record(spark):
    row = normal(spark, {"symbol": "BTCUSDT", "timestamp": "2024-01-01T00:00:01.5Z", "price": 1.5, "volume": "2", "side": "sell", "trade_id": 7, "source": "binance"})
    assert (row.symbol, row.timestamp, row.price, row.volume, row.side, row.trade_id, row.source) == ("BTCUSDT", at(1.5), 1.5, 2.0, "sell", "7", "binance")


def test_canonical_defaults_and_zones(spark):
    row = normal(spark, {"timestamp": "2024-01-01T02:00:00+02:00", "side": "buy"})
    assert (row.symbol, row.timestamp, row.price, row.volume, row.trade_id, row.source) == ("BTCUSDT", at(0), 0.0, 0.0, "", "bybit")
    assert normal(spark, {"timestamp": 1704067201500, "side": "buy"}).timestamp == at(1.5)


def test_raw_record(spark):
    row = normal(spark, {"T": 1704067201500, "p": "3.5", "v": "4", "S": "Sell", "i": "id-1"})
    assert (row.symbol, row.timestamp, row.price, row.volume, row.side, row.trade_id, row.source) == ("ETHUSDT", at(1.5), 3.5, 4.0, "sell", "id-1", "bybit")
    assert str(row.date_partition) == "2024-01-01"


def test_empty_message_and_plain_topic(spark):
    row = normal(spark, None, topic="trades")
    assert (row.symbol, row.timestamp, row.price, row.side, row.trade_id) == ("BTCUSDT", at(3600), 0.0, "unknown", "")


def test_broken_values_become_null(spark):
    row = normal(spark, {"timestamp": "yesterday", "side": "buy", "price": "n/a"})
    assert row.timestamp is None and row.price is None


@pytest.mark.parametrize(
    "value,ok",
    [
        ({"T": 1, "p": "1", "v": "2", "S": "Buy"}, True),
        ({"T": "17", "p": 1, "v": 2, "S": "Sell"}, True),
        ({"T": 1, "p": "1", "v": "2"}, False),
        ({"T": 1, "p": "x", "v": "2", "S": "Buy"}, False),
        ({"T": "1.5", "p": "1", "v": "2", "S": "Buy"}, False),
        ({"T": 1, "p": "1", "v": "2", "S": "buy"}, False),
        (None, False),
    ],
)
def test_raw_check(spark, value, ok):
    assert decoded(spark, value).select(checks.raw_trade_ok().alias("ok")).first().ok is ok


def test_present_null_is_complete(spark):
    keys = {k: None for k in ("symbol", "timestamp", "price", "volume", "side", "trade_id", "source")}
    rows = decoded(spark, keys, {"symbol": "x"})
    assert [r.ok for r in rows.select(checks.complete_keys(F.col("present")).alias("ok")).collect()] == [True, False]


def test_message_keys(spark):
    rows = made(spark, [trade(trade_id="abc"), trade(trade_id="")]).select(N.message_key().alias("k")).collect()
    assert rows[0].k == "abc" and 0 <= int(rows[1].k) <= 999


def test_klines(spark):
    text = spark.createDataFrame([('[[1704067200999,"1","2","0.5","1.5","9"],[1704070800000,"x","2","1","2","9"]]',)], "value string")
    rows = kline_rows(text).collect()
    assert (rows[0].time, rows[0].open, rows[0].close) == (1704067200, 1.0, 1.5) and rows[1].open is None
    frames = spark.createDataFrame([('{"k":{"t":1704067200999,"s":"BTCUSDT","i":"1m","o":"1","h":"2","l":"0.5","c":"1.5","x":true}}',), ('{"result":null}',)], "value string")
    rows = kline_frames(frames).collect()
    assert len(rows) == 1 and rows[0].is_final and rows[0].interval == "1m"


def test_epoch_units(spark):
    rows = spark.createDataFrame([("1704067200",)], "t string")
    assert rows.select(checks.instant("t", "s").alias("x")).first().x == at(0)


def test_exact_notional(spark):
    rows = spark.createDataFrame([("89000.12345678", "0.0500000001"), ("1.00000001", "0.000000000000000001")], "p string, q string")
    price, quantity = F.col("p").cast("decimal(20,8)"), F.col("q").cast("decimal(38,18)")
    got = [r.n for r in rows.select(N.exact_product(price, quantity).alias("n")).collect()]
    assert got == [Decimal("4450.006181739012345678"), Decimal("1E-18")]


def test_accuracy_counts_accepted_prices_only(spark):
    """Outliers, at the edges of blocks too, and a lasting step that is never accepted: as the rule in order."""
    from collections import deque

    import numpy as np

    rng = np.random.default_rng(2)
    series = {name: 100 * np.exp(np.cumsum(rng.normal(0, 0.003, n))) for name, n in (("~A", 700), ("B", 300), ("C", 500))}
    for i in (150, 151, 199, 200, 290, 305, 620):
        series["~A"][i] *= 10
    series["C"][250:] *= 5
    rows = [(name, at(i), float(p), f"{i:05d}") for name, prices in series.items() for i, p in enumerate(prices)]
    frame = spark.createDataFrame(rows, "symbol string, timestamp timestamp, price double, trade_id string")
    found = {(r.symbol, int(r.trade_id)): r.accepted for r in Q.with_accepted(frame, size=100).collect()}
    for name, prices in series.items():
        expected = Q.judge_prices(deque(maxlen=100), prices)
        assert [found[name, i] for i in range(len(prices))] == expected
    assert sum(not ok for ok in found.values()) > 250


def test_one_outlier_rejects_one_trade(spark):
    rows = [("X", at(i), 100000.0 if i == 15 else 100.0, f"{i:03d}") for i in range(40)]
    frame = spark.createDataFrame(rows, "symbol string, timestamp timestamp, price double, trade_id string")
    assert [r.trade_id for r in Q.with_accepted(frame).where("not accepted").collect()] == ["015"]


def test_lasting_steps_need_no_pass_in_order(spark, monkeypatch):
    """A level that stays threefold for forty blocks and comes back, beside prices that are often rejected."""
    from collections import deque

    import numpy as np
    from pyspark.sql import DataFrame

    def in_order(*_):
        raise AssertionError("a series was judged in order")

    monkeypatch.setattr(DataFrame, "mapInPandas", in_order)
    rng = np.random.default_rng(5)
    step = 100 * np.exp(rng.normal(0, 0.01, 5000))
    step[333:4350] *= 3
    wild = 100 * np.exp(rng.normal(0, 0.4, 1500))
    series = {"STEP": step, "WILD": wild}
    rows = [(name, at(i), float(p), f"{i:05d}") for name, prices in series.items() for i, p in enumerate(prices)]
    frame = spark.createDataFrame(rows, "symbol string, timestamp timestamp, price double, trade_id string")
    found = {(r.symbol, int(r.trade_id)): r.accepted for r in Q.with_accepted(frame, size=100).collect()}
    for name, prices in series.items():
        expected = Q.judge_prices(deque(maxlen=100), prices)
        assert [found[name, i] for i in range(len(prices))] == expected


def test_gate_orders_one_instant_by_id(spark):
    """Ids 9 and 10 in the order of their values, in the batch gate and in the stream's groups."""
    from collections import deque

    import numpy as np
    import pandas as pd

    from tickloom.streaming.jobs import _judged

    class State:
        exists = False

        def update(self, _):
            pass

    prices = 100 * np.exp(np.random.default_rng(8).normal(0, 0.6, 40))
    rows = [trade(second=5, price=float(p), trade_id=str(i + 1)) for i, p in enumerate(prices)]
    expected = Q.judge_prices(deque(maxlen=100), prices)
    judged = Q.gate(made(spark, rows[::-1]).repartition(3), F.lit(at(60)).cast("timestamp")).collect()
    assert [r.failed_dimension is None for r in sorted(judged, key=lambda r: int(r.trade_id))] == expected
    frame = pd.DataFrame(rows[::-1], columns=["symbol", "timestamp", "price", "volume", "side", "trade_id", "source"])
    ordered, verdicts = _judged(iter([frame]), State())
    assert verdicts == expected and ordered["trade_id"].tolist() == [r[5] for r in rows]
