"""Constraint audit of the relational tables (Q9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.operators.stacking import stack


def check_rule(table: DataFrame, name: str, rule: Column) -> DataFrame:
    """CHECK: rows for which the rule is false; as in SQL, a null passes."""
    return table.agg(F.count_if(~rule).alias("violations")).select(F.lit(name).alias("rule"), "violations")


def unique_rule(table: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """UNIQUE: surplus rows of keys that occur more than once; null keys never clash."""
    present = table.dropna(subset=keys)
    sizes = present.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    surplus = F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0))
    return sizes.agg(surplus.alias("violations")).select(F.lit(name).alias("rule"), "violations")


def foreign_rule(table: DataFrame, name: str, column: str, parent: DataFrame, key: str) -> DataFrame:
    """FOREIGN KEY: rows whose value is not in the parent table; a null passes.

    Rows are counted per value first, so a value that a third of the rows hold
    crosses the shuffle as one row.
    """
    counted = table.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("_v")).agg(
        F.count(F.lit(1)).alias("_n")
    )
    orphans = counted.join(parent.select(F.col(key).alias("_v")), "_v", "left_anti")
    total = F.coalesce(F.sum("_n"), F.lit(0))
    return orphans.agg(total.alias("violations")).select(F.lit(name).alias("rule"), "violations")


def vocabulary_rule(table: DataFrame, name: str, column: str, allowed: list[str]) -> DataFrame:
    """Enum: rows whose value is not in the vocabulary."""
    return check_rule(table, name, F.col(column).isin(allowed))


def audit(rules: list[DataFrame]) -> DataFrame:
    """One row (rule, violations) per rule."""
    return stack(*rules)
