"""Unions that later operators may rely on."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

UNION_PARTITIONING = "spark.sql.unionOutputPartitioning"


def stack(*frames: DataFrame) -> DataFrame:
    """Union by column name, safe under adaptive execution.

    Spark 4.1 takes a union of equally partitioned inputs for partitioned and
    leaves out the shuffle after it.  Adaptive execution can then read one of the
    inputs by another layout, and rows of one key end up in different tasks: a
    settlement came out wrong that way.  So the session is told to shuffle after
    a union.
    """
    frames[0].sparkSession.conf.set(UNION_PARTITIONING, "false")
    return reduce(DataFrame.unionByName, frames)
