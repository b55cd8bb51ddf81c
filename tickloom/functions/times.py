"""Epoch-aligned time buckets as integer arithmetic on microseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def span_micros(span: str) -> int:
    """Microseconds of a fixed span such as ``"5 minutes"``."""
    amount, unit = span.split()
    return int(amount) * _UNIT_SECONDS[unit.rstrip("s")] * 1_000_000


def micros(stamp: str | Column) -> Column:
    column = F.col(stamp) if isinstance(stamp, str) else stamp
    return F.unix_micros(column.cast("timestamp"))


def bucket_start(stamp: str | Column, span: str) -> Column:
    """First instant of the bucket that holds ``stamp``; buckets start at the epoch,
    which for 1, 5, 15 and 60 minutes is the same as flooring the minute."""
    at = micros(stamp)
    return F.timestamp_micros(at - F.pmod(at, F.lit(span_micros(span))))


def minute_floor(stamp: str | Column) -> Column:
    """Event time floored to its minute, in UTC."""
    column = F.col(stamp) if isinstance(stamp, str) else stamp
    return F.date_trunc("minute", column.cast("timestamp"))
