"""Quality rules as boolean columns that are never null."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickloom.functions.times import micros
from tickloom.schemas import (
    MAX_AGE_SECONDS, MAX_PRICE, MAX_SKEW_SECONDS, MAX_VOLUME, MIN_PRICE, MIN_VOLUME,
    REQUIRED_FIELDS, TRADE_SIDES, TRADE_SOURCES,
)


def sure(condition: Column) -> Column:
    """Null counts as failed."""
    return F.coalesce(condition, F.lit(False))


def every(*conditions: Column) -> Column:
    return sure(reduce(and_, conditions))


def has_keys(present: Column, keys: list[str]) -> Column:
    """All of ``keys`` occur in an array of the keys of a JSON object."""
    return sure(F.size(F.array_except(F.array(*[F.lit(k) for k in keys]), present)) == 0)


def number(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.try_cast("double")


def filled(value: str | Column) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.isNotNull() & (column != "")


def complete(fields: list[str] = REQUIRED_FIELDS) -> Column:
    """Q1 for tables: every required column is set."""
    return every(*[F.col(field).isNotNull() for field in fields])


def complete_keys(present: Column, fields: list[str] = REQUIRED_FIELDS) -> Column:
    """Q1 for wire records: every required key is present; a null value passes."""
    return has_keys(present, fields)


def valid() -> Column:
    """Q2: types, ranges and vocabularies.  NaN is above every range, so it fails."""
    return every(
        number("price").between(MIN_PRICE, MAX_PRICE),
        number("volume").between(MIN_VOLUME, MAX_VOLUME),
        F.col("side").isin(TRADE_SIDES),
        F.lower("source").isin(TRADE_SOURCES),
        filled("symbol"),
        filled("trade_id"),
    )


def consistent() -> Column:
    """Q3: a USDT pair and a real trade id."""
    symbol = F.upper("symbol")
    return every(symbol.endswith("USDT"), F.length(symbol) >= 5, filled("trade_id"), F.col("trade_id") != "0")


def instant(value: str | Column, epoch_unit: str = "ms") -> Column:
    """Timestamp from ISO text or from an epoch number given as text."""
    text = (F.col(value) if isinstance(value, str) else value).cast("string")
    scale = {"ms": 1000, "s": 1_000_000}[epoch_unit]
    epoch = F.timestamp_micros((text.try_cast("double") * scale).try_cast("long"))
    return F.coalesce(epoch, text.try_cast("timestamp"))


def timely(as_of: Column, stamp: str | Column = "timestamp") -> Column:
    """Q4: at most 300 s old and at most 10 s ahead of ``as_of``, as instants."""
    age = micros(as_of) - micros(stamp)
    return sure(age.between(-MAX_SKEW_SECONDS * 1_000_000, MAX_AGE_SECONDS * 1_000_000))


def finite(value: str) -> Column:
    column = F.col(value).cast("double")
    return sure(~F.isnan(column) & (F.abs(column) != float("inf")))


def valid_features(names: list[str], flag: str = "below_all_sma") -> Column:
    """Q10 for one step: every feature is a finite number, the flag is 0 or 1."""
    numeric = [finite(name) for name in names if name != flag]
    return every(*numeric, F.col(flag).isin(0, 1))


def valid_sequence(sequence: str, n: int) -> Column:
    return sure(F.size(sequence) == n)


def valid_model_symbol(symbol: str = "symbol") -> Column:
    return sure(F.length(symbol).between(1, 20))


def raw_trade_ok(record: str = "record", present: str = "present") -> Column:
    """The keys T, p, v, S are present and hold an integer, two numbers and a side."""
    return every(
        has_keys(F.col(present), ["T", "p", "v", "S"]),
        number(F.col(f"{record}.p")).isNotNull(),
        number(F.col(f"{record}.v")).isNotNull(),
        F.col(f"{record}.T").try_cast("long").isNotNull(),
        F.col(f"{record}.S").isin("Buy", "Sell"),
    )
