"""The crossover report against a series worked by hand and whole-column arithmetic."""

import math

import numpy as np
import pandas as pd
import pytest

from helpers import CANDLE_DDL, closes, walk
from tickloom.operators import backtest as B


def expected(prices):
    """The report from whole columns: positions by filling signs forward, money by a cumulative product."""
    close = pd.Series(prices, dtype=float)
    gap = close.rolling(10).mean().shift() - close.rolling(30).mean().shift()
    # Equal averages may differ in the last digits of a rolling sum.
    state = np.sign(gap.where(gap.abs() > 1e-9)).ffill().fillna(-1).clip(lower=0)
    turns = state.diff().fillna(state)
    buys, sells = close[turns > 0].to_numpy(), close[turns < 0].to_numpy()
    growth = sells / buys[: len(sells)]
    equity = 10000 * np.cumprod(growth)
    peaks = np.maximum.accumulate(np.concatenate(([10000.0], equity)))[1:]
    final = (equity[-1] if len(equity) else 10000.0) * (close.iloc[-1] / buys[-1] if len(buys) > len(sells) else 1.0)
    spread = growth.std() if len(growth) > 1 else 0.0
    wins = int((growth > 1).sum())
    return {
        "total_return": (final / 10000 - 1) * 100,
        "final_equity": final,
        "max_drawdown": ((1 - equity / peaks) * 100).max() if len(equity) else 0.0,
        "sharpe_ratio": (growth.mean() - 1) / spread * math.sqrt(250) if spread > 0 else 0.0,
        "trades": len(growth),
        "winning_trades": wins,
        "losing_trades": len(growth) - wins,
        "win_rate": 100 * wins / len(growth) if len(growth) else 0.0,
        "data_points": len(close),
    }


def test_a_series_worked_by_hand(spark):
    """31 flat bars, then 110, 120, 90 ...: the fast average is above the slow one from bar 33 on, below it from 44."""
    prices = [100.0] * 31 + [110.0, 120.0] + [90.0] * 12 + [99.0]
    candles = spark.createDataFrame(closes({"X": prices}), CANDLE_DDL)
    trips = B.round_trips(B.backtest_bars(candles)).collect()
    assert [(t.trip, t.buy_price, t.sell_price) for t in trips] == [(1, 120.0, 90.0)]
    report = B.backtest_report(candles).first()
    assert (report.trades, report.winning_trades, report.final_equity, report.max_drawdown) == (1, 0, 7500.0, 25.0)
    assert (report.total_return, report.total_return_abs, report.sharpe_ratio) == (-25.0, -2500.0, 0.0)


@pytest.fixture(scope="module")
def series():
    data = {f"R{i}": walk(n, i, 50000.0) for i, n in enumerate([1, 10, 30, 31, 32, 60, 200, 400, 700, 1000])}
    data["SINE"] = [50000 + math.sin(i / 10) * 2000 for i in range(720)]
    data["FLAT"] = [50000.0] * 720
    data["OPEN"] = [100.0] * 40 + [100.0 + i for i in range(20)]
    data["FALLS"] = [100.0 - 0.01 * i + 3 * math.sin(i / 5) for i in range(300)]
    return data


def test_report(spark, series):
    candles = spark.createDataFrame(closes(series), CANDLE_DDL)
    rows = {r.symbol: r for r in B.backtest_report(candles).collect()}
    for symbol, prices in series.items():
        for name, value in expected(prices).items():
            assert rows[symbol][name] == pytest.approx(value, abs=0.0051), (symbol, name)
        assert rows[symbol].winning_trades + rows[symbol].losing_trades == rows[symbol].trades
    assert rows["FLAT"].trades == 0 and rows["OPEN"].trades == 0 and rows["OPEN"].final_equity > 10000
    assert rows["SINE"].trades > 3


def test_only_the_newest_bars_count(spark):
    prices = walk(900, 77)
    candles = spark.createDataFrame(closes({"X": prices}), CANDLE_DDL)
    row = B.backtest_report(candles, bars=500).first()
    assert row.data_points == 500
    assert row.final_equity == pytest.approx(expected(prices[-500:])["final_equity"], abs=0.0051)


def test_long_series_count_whole(spark):
    series = {"A": walk(1001, 5, 100.0), "B": walk(9000, 6, 100.0)}
    candles = spark.createDataFrame(closes(series), CANDLE_DDL)
    for row in B.backtest_report(candles).collect():
        want = expected(series[row.symbol])
        assert row.data_points == len(series[row.symbol]) and row.trades == want["trades"] > 10
        assert row.final_equity == pytest.approx(want["final_equity"], abs=0.0051)
        assert row.max_drawdown == pytest.approx(want["max_drawdown"], abs=0.0051)
    newest = B.scaled_series(candles, 5000).groupBy("symbol").count().collect()
    assert {r.symbol: r["count"] for r in newest} == {"A": 1001, "B": 5000}


def test_symbol_without_candles(spark):
    candles = spark.createDataFrame(closes({"X": walk(50, 1)}), CANDLE_DDL)
    asked = spark.createDataFrame([("X",), ("GONE",)], "symbol string")
    row = {r.symbol: r for r in B.backtest_report(candles, symbols=asked).collect()}["GONE"]
    assert (row.trades, row.total_return, row.sharpe_ratio, row.max_drawdown, row.win_rate) == (0, 0, 0, 0, 0)


def test_trend_limits(spark):
    data = {"UP": [100.0] * 23 + [102.01], "EDGE": [100.0] * 23 + [102.0], "DOWN": [100.0] * 23 + [97.9], "OLD": [1.0] + [100.0] * 24}
    rows = {r.symbol: r.trend for r in B.trend(spark.createDataFrame(closes(data), CANDLE_DDL)).collect()}
    assert rows == {"UP": "up", "EDGE": "flat", "DOWN": "down", "OLD": "flat"}


def test_scaled_series_of_equal_values(spark):
    rows = spark.createDataFrame(closes({"FLAT": [5.0] * 4, "LINE": [0.0, 5.0, 10.0]}), CANDLE_DDL)
    out = B.scaled_series(rows, 10).toPandas()
    assert out[out.symbol == "FLAT"][["x", "y"]].isna().all().all()
    line = out[out.symbol == "LINE"].sort_values("open_time")
    assert list(line.x) == [0, 30, 60] and list(line.y) == [20, 10, 0]
