"""Wire formats to columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.schemas import KLINE_FRAME, WIRE_TRADE


def decode_messages(messages: DataFrame) -> DataFrame:
    """Key and value bytes to text and a typed record; an empty value is ``{}``.

    ``present`` lists the record's keys: an absent key differs from a null value.
    """
    text = F.col("value").cast("string")
    text = F.when(text.isNull() | (text == ""), "{}").otherwise(text)
    return (
        messages.withColumns({"key": F.col("key").cast("string"), "text": text})
        .withColumns({"record": F.from_json("text", WIRE_TRADE), "present": F.json_object_keys("text")})
        .drop("value")
    )


def kline_rows(responses: DataFrame, text: str = "value") -> DataFrame:
    """A JSON array of positional klines to one row per candle."""
    rows = responses.withColumn("_k", F.explode(F.from_json(text, "array<array<string>>"))).drop(text)
    at = F.col("_k").getItem(0).try_cast("long")
    prices = {name: F.col("_k").getItem(i + 1).try_cast("double") for i, name in enumerate(["open", "high", "low", "close"])}
    return rows.withColumns({"time": F.floor(at / 1000).cast("long"), **prices}).drop("_k")


def kline_frames(frames: DataFrame, text: str = "value") -> DataFrame:
    """Stream frames with a nested ``k`` object to candle updates; other frames are dropped."""
    parsed = frames.withColumn("_k", F.from_json(text, KLINE_FRAME)["k"]).filter(F.col("_k").isNotNull())
    k = F.col("_k")
    return parsed.withColumns(
        {
            "time": F.floor(k["t"] / 1000).cast("long"),
            "open": k["o"].try_cast("double"),
            "high": k["h"].try_cast("double"),
            "low": k["l"].try_cast("double"),
            "close": k["c"].try_cast("double"),
            "is_final": F.coalesce(k["x"], F.lit(False)),
            "interval": k["i"],
            "symbol": k["s"],
        }
    ).drop("_k", text)
