"""Registered queries: a Spark callable per key and, where SQL can say it, an oracle."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, places: int = 6) -> Callable[[Query], Query]:
    """Registers a query; its result is brought to plain comparable types."""

    def register(build: Query) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return comparable(build(spark, folder), places)

        QUERIES[name] = run
        if oracle:
            ORACLES[name] = oracle
        return build

    return register


def comparable(df: DataFrame, places: int = 6) -> DataFrame:
    """Zone-free times, text dates, bigint integers, doubles rounded to ``places``."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.TimestampType):
            column = column.cast("timestamp_ntz")
        elif isinstance(kind, T.DateType):
            column = column.cast("string")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.DecimalType, T.DoubleType, T.FloatType)):
            column = F.round(column.cast("double"), places) + F.lit(0.0)
        columns.append(column.alias(field.name))
    return df.select(*columns)


def r(expression: str, places: int = 6) -> str:
    """DuckDB text that rounds as ``comparable`` does."""
    return f"(round(CAST({expression} AS DOUBLE), {places}) + 0.0)"
