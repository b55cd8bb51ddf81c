"""Argument checks made before a plan is built."""

from __future__ import annotations

import re

from pyspark.sql import Column

from tickloom.schemas import DEFAULT_HORIZON, DEFAULT_INTERVAL, INTERVALS, MAX_BARS, MAX_HORIZON, SYMBOL_PATTERN


def valid_symbol(symbol: Column) -> Column:
    """2 to 20 upper-case letters or digits."""
    return symbol.rlike(SYMBOL_PATTERN)


def check_symbol(symbol: str) -> str:
    if not re.fullmatch(SYMBOL_PATTERN, symbol or ""):
        raise ValueError("a symbol is 2 to 20 upper-case letters or digits")
    return symbol


def interval_span(interval: str | None = None) -> str:
    """Time span of an interval name; 1h when none is given."""
    name = interval or DEFAULT_INTERVAL
    if name not in INTERVALS:
        raise ValueError(f"interval must be one of {', '.join(INTERVALS)}")
    return INTERVALS[name]


def check_limit(limit: int | str | None = None, default: int = 100) -> int:
    """A row limit: ``default`` when absent, an error outside 1 to 1000."""
    if limit is None or limit == "":
        return default
    try:
        number = int(limit)
    except ValueError:
        raise ValueError("limit must be a number") from None
    if not 1 <= number <= MAX_BARS:
        raise ValueError(f"limit must lie between 1 and {MAX_BARS}")
    return number


def _clamped(value, default: int, low: int, high: int) -> int:
    try:
        number = int(value) if value is not None else default
    except (TypeError, ValueError):
        number = default
    # Zero counts as absent.
    return min(max(number or default, low), high)


def sma_period(value=None) -> int:
    return _clamped(value, 20, 2, 200)


def ema_period(value=None) -> int:
    return _clamped(value, 12, 2, 200)


def rsi_period(value=None) -> int:
    return _clamped(value, 14, 2, 100)


def lookback_bars(days: int, interval: str) -> int:
    """Bars in ``days`` days, at most 1000.

    15m counts 288 bars a day like 5m does; the platform's reports rely on it.
    """
    per_day = {"1h": 24, "1m": 1440}.get(interval, 288)
    return min(days * per_day, MAX_BARS)


def horizon_minutes(value: int | str | None = None) -> int:
    """Minutes a prediction looks ahead: ``DEFAULT_HORIZON`` when absent, an error outside 1 to ``MAX_HORIZON``."""
    if value is None or value == "":
        return DEFAULT_HORIZON
    try:
        number = int(value)
    except ValueError:
        raise ValueError("horizon must be a number") from None
    if number < 1:
        raise ValueError("horizon must be at least 1 minute")
    if number > MAX_HORIZON:
        raise ValueError(f"horizon cannot exceed {MAX_HORIZON} minutes (24 hours)")
    return number
