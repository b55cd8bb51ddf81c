"""Stored rollups, refreshed from the 1-minute candles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.candles import ROLLUPS, rollup_candles
from tickloom.sources.staging import stage


def refresh_rollups(candles: DataFrame, folder: str, touched: DataFrame | None = None) -> dict[str, DataFrame]:
    """The 5m, 15m and 1h tables under ``folder``, by day.

    With ``touched``, a table of open_date values, only those days are rolled up
    and replaced.  Buckets never cross a day, so a day is complete on its own.
    The day's candles are staged once for the three tables, and a day is written
    by one task unless it outgrows the advisory partition size.
    """
    spark = candles.sparkSession
    dated = candles.withColumn("open_date", F.to_date("open_time"))
    if touched is not None:
        dated = dated.join(touched.select("open_date").distinct(), "open_date", "left_semi")
    base = stage(dated, "rollup-input")
    tables = {}
    for name, span in ROLLUPS.items():
        path = f"{folder.rstrip('/')}/candles_{name}"
        rolled = rollup_candles(base, span).withColumn("open_date", F.to_date("open_time"))
        rolled.hint("rebalance", "open_date").write.partitionBy("open_date").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        tables[name] = spark.read.parquet(path)
    return tables
