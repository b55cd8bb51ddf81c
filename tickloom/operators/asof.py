"""As-of joins: the last known value at given times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.operators.series import number_rows, running_rows
from tickloom.operators.stacking import stack


def as_of(points: DataFrame, facts: DataFrame, keys: list[str], stamp: str, columns: list[str], ties: tuple[str, ...] = ()) -> DataFrame:
    """Every point with ``columns`` of the last fact of its key at or before its time; null where there is none.

    ``points`` has the keys and ``stamp``; facts of one time are ordered by ``ties``.  Facts and points are put in one
    order, and each point gets the last fact before it by a running value in blocks, so no task holds a key.
    """
    fact = F.struct(*columns)
    both = stack(
        facts.select(*keys, stamp, F.lit(0).alias("_side"), *[F.col(t).alias(f"_tie_{t}") for t in ties], fact.alias("_fact")),
        points.select(
            *keys, stamp, F.lit(1).alias("_side"), *[F.lit(None).cast(facts.schema[t].dataType).alias(f"_tie_{t}") for t in ties],
            F.lit(None).cast(facts.select(fact.alias("f")).schema["f"].dataType).alias("_fact"),
        ),
    )
    numbered = number_rows(both, keys, [stamp, "_side", *[f"_tie_{t}" for t in ties]])
    known = running_rows(numbered, keys, {"_last": ("last", "_fact")})
    return known.where("_side = 1").select(*keys, stamp, *[F.col(f"_last.{c}").alias(c) for c in columns])
