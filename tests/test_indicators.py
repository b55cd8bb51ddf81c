"""Indicators against the plain loops they stand for."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import CANDLE_DDL, by_symbol, closes, walk
from tickloom.operators import indicators as I

LENGTHS = [1, 2, 9, 10, 19, 20, 34, 35, 199, 200, 201, 1500]


@pytest.fixture(scope="module")
def series():
    data = {f"S{n}": walk(n, n) for n in LENGTHS}
    data["FLAT"] = [50000.0] * 100
    data["RISING"] = [float(i) for i in range(1, 61)]
    return data


@pytest.fixture(scope="module")
def candles(spark, series):
    return spark.createDataFrame(closes(series), CANDLE_DDL)


def ema(values, period):
    k, out = 2 / (period + 1), [values[0]]
    for x in values[1:]:
        out.append(x * k + out[-1] * (1 - k))
    return out


def test_sma_and_bands(candles, series):
    sma = by_symbol(I.with_sma(candles, [20, 200]))
    bands = by_symbol(I.with_bollinger(candles))
    for symbol, values in series.items():
        for i in range(len(values)):
            for p in (20, 200):
                got = sma[symbol][f"sma_{p}"][i]
                if i + 1 < p:
                    assert math.isnan(got)
                else:
                    assert got == pytest.approx(np.mean(values[i + 1 - p : i + 1]), rel=1e-12)
            row = bands[symbol].loc[i]
            if i + 1 < 20:
                assert math.isnan(row.bb_middle)
            else:
                part = values[i - 19 : i + 1]
                assert row.bb_upper == pytest.approx(np.mean(part) + 2 * np.std(part), rel=1e-9)
                assert row.bb_lower == pytest.approx(np.mean(part) - 2 * np.std(part), rel=1e-9)


@pytest.mark.parametrize("period", [2, 3, 12, 200])
def test_ema(candles, series, period):
    got = by_symbol(I.with_ema(candles, [period]))
    for symbol, values in series.items():
        np.testing.assert_allclose(got[symbol][f"ema_{period}"], ema(values, period), rtol=1e-12)


def test_averages_pass_over_many_spans(spark, monkeypatch):
    """Small blocks and spans, so that the start of a series has to pass through dozens of both."""
    monkeypatch.setattr(I, "_MAX_EMA_BLOCK", 8)
    monkeypatch.setattr(I, "_SPAN_BLOCKS", 4)
    # What the first value leaves after 1500 rows is far above everything else.
    values = [1e300, *walk(1499, 8)]
    frame = spark.createDataFrame(closes({"S": values, "SHORT": values[:33], "ONE": values[:1]}), CANDLE_DDL)
    got = by_symbol(I.with_ema(frame, [12, 2000]))
    for symbol, n in (("S", 1500), ("SHORT", 33), ("ONE", 1)):
        for period in (12, 2000):
            np.testing.assert_allclose(got[symbol][f"ema_{period}"], ema(values[:n], period), rtol=1e-11)
    line = [x - y for x, y in zip(ema(values[1:], 12), ema(values[1:], 26))]
    tail = spark.createDataFrame(closes({"S": values[1:]}), CANDLE_DDL)
    macd = by_symbol(I.with_macd(tail))["S"]
    np.testing.assert_allclose(macd["macd"], line, atol=1e-11 * max(values[1:]))
    np.testing.assert_allclose(macd["macd_signal"], ema(line, 9), atol=1e-11 * max(values[1:]))


def test_macd(candles, series):
    got = by_symbol(I.with_macd(candles, [I.Macd("a", 12, 26, 9), I.Macd("b", 9, 35, 9)]))
    for symbol, values in series.items():
        for name, fast, slow, signal in (("a", 12, 26, 9), ("b", 9, 35, 9)):
            line = [x - y for x, y in zip(ema(values, fast), ema(values, slow))]
            scale = max(values)
            np.testing.assert_allclose(got[symbol][name], line, atol=1e-12 * scale)
            np.testing.assert_allclose(got[symbol][f"{name}_signal"], ema(line, signal), atol=1e-12 * scale)
    first = [part.loc[0] for part in got.values()]
    assert all(row.a == 0 and row.a_signal == 0 for row in first)


def test_volatility_and_returns(candles, series):
    vol, ret = by_symbol(I.with_volatility(candles, [10, 14])), by_symbol(I.with_returns(candles))
    for symbol, values in series.items():
        returns = [(b - a) / a for a, b in zip(values, values[1:])]
        np.testing.assert_allclose(ret[symbol].simple_return[1:], returns, rtol=1e-12, atol=1e-15)
        for p in (10, 14):
            for i in range(len(values)):
                expected = np.std(returns[i - p : i]) * math.sqrt(p) if i >= p else 0.0
                assert vol[symbol][f"volatility_{p}"][i] == pytest.approx(expected, rel=1e-7, abs=1e-12)


def rsi(values, period):
    diffs = [b - a for a, b in zip(values, values[1:])]
    if len(diffs) < period:
        return 50
    gain = sum(max(d, 0) for d in diffs[:period]) / period
    loss = sum(max(-d, 0) for d in diffs[:period]) / period
    return 100 if loss == 0 else 100 - 100 / (1 + gain / loss)


def test_rsi(candles, series):
    first = {row.symbol: row.rsi for row in I.first_rsi(candles, 14).collect()}
    rolling = by_symbol(I.with_rsi(candles, 14))
    for symbol, values in series.items():
        assert first[symbol] == pytest.approx(rsi(values, 14))
        for i in range(len(values)):
            expected = rsi(values[i - 14 : i + 1], 14) if i >= 14 else 50
            assert rolling[symbol].rsi[i] == pytest.approx(expected, rel=1e-9)
    assert first["RISING"] == 100 and first["FLAT"] == 100 and first["S10"] == 50


def test_return_after_zero_is_missing(spark):
    rows = spark.createDataFrame(closes({"Z": [1.0, 0.0, 2.0]}), CANDLE_DDL)
    got = by_symbol(I.with_returns(rows))["Z"].simple_return
    assert got[1] == -1 and math.isnan(got[2])


def test_feature_rows(candles, series):
    got = by_symbol(I.feature_rows(candles))
    for symbol, values in series.items():
        row, n = got[symbol].iloc[-1], len(values)
        assert row.data_points == n and row.price == values[-1]
        averages = [np.mean(values[-p:]) if n >= p else None for p in (20, 50, 200)]
        below = all(a is not None and values[-1] < a for a in averages)
        assert row.below_all_sma == int(below)
        line = np.array(ema(values, 5)) - np.array(ema(values, 35))
        assert row.macd_signal_5_35 == pytest.approx(ema(list(line), 5)[-1], abs=1e-9 * max(values))


@pytest.mark.parametrize("side", ["oldest", "newest"])
def test_summary_of_a_slice(candles, series, side):
    rows = {r.symbol: r for r in I.indicator_summary(candles, n=200, side=side).collect()}
    for symbol, values in series.items():
        part = values[:200] if side == "oldest" else values[-200:]
        row = rows[symbol]
        assert row.data_points == len(part) and row.current_price == part[-1]
        assert row.ema == pytest.approx(ema(part, 12)[-1], rel=1e-12)
        assert row.rsi == pytest.approx(rsi(part, 14))
        assert (row.sma is None) == (len(part) < 20)


def test_sequences(candles, series):
    rows = I.feature_sequences(candles, ["close"], 7)
    counts = {r.symbol: r["count"] for r in rows.groupBy("symbol").count().collect()}
    assert counts == {s: len(v) - 6 for s, v in series.items() if len(v) >= 7}
    last = rows.filter("symbol = 'RISING'").orderBy(F.desc("open_time")).first()
    assert [step.close for step in last.sequence] == [54.0, 55.0, 56.0, 57.0, 58.0, 59.0, 60.0]


def test_no_task_holds_a_series(candles):
    """Rows meet in windows only by (symbol, chunk) or (symbol, block)."""
    plan = I.feature_rows(candles)._jdf.queryExecution().optimizedPlan().toString()
    for line in plan.splitlines():
        if "Window [" in line and "close" in line:
            assert "_block" in line or "_chunk" in line
