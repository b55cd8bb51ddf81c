"""Small inputs shared by the tests."""

from __future__ import annotations

import datetime as dt

import numpy as np
import pandas as pd

START = pd.Timestamp("2024-01-01")


def closes(series: dict[str, list[float]], step: str = "1h") -> pd.DataFrame:
    """Candles with high = close + 1, one series per symbol."""
    parts = [
        pd.DataFrame(
            {
                "symbol": symbol,
                "open_time": pd.date_range(START, periods=len(values), freq=step),
                "close": np.asarray(values, dtype=float),
            }
        )
        for symbol, values in series.items()
        if len(values)
    ]
    out = pd.concat(parts, ignore_index=True)
    out["high"] = out["close"] + 1
    return out


def walk(n: int, seed: int, start: float = 100.0) -> list[float]:
    rng = np.random.default_rng(seed)
    return list(start * np.exp(np.cumsum(rng.normal(0, 0.02, n))))


def at(seconds: float) -> dt.datetime:
    return dt.datetime(2024, 1, 1) + dt.timedelta(seconds=seconds)


CANDLE_DDL = "symbol string, open_time timestamp, close double, high double"
TRADE_DDL = "symbol string, timestamp timestamp, price double, volume double, side string, trade_id string, source string"


def trade(symbol="BTCUSDT", second=0.0, price=100.0, volume=1.0, side="buy", trade_id="1", source="bybit"):
    return (symbol, at(second), price, volume, side, trade_id, source)


def by_symbol(df, order="open_time"):
    frame = df.toPandas().sort_values(["symbol", order])
    return {symbol: part.reset_index(drop=True) for symbol, part in frame.groupby("symbol")}
