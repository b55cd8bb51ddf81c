"""Row-indexed time series without a per-series task.

A window over ``partitionBy(symbol)`` sends a whole symbol to one task, and one
symbol may hold a third of all rows.  The helpers here cut every series into
pieces of bounded size instead:

* ``index_rows`` numbers the rows of each series from 1, exactly.  Rows are
  sorted inside (series, time chunk); the chunk sizes, one small row per chunk,
  turn local numbers into global ones.
* ``Blocks`` groups indexed rows into equal blocks by row number.  Each block
  also receives the last rows of the block before it, so a bounded frame
  (``ROWS k PRECEDING``) sees what it would see in the whole series.
* ``running`` and ``running_rows`` are the two-level form of an unbounded running
  aggregate, by time and by row number.
* ``number_rows`` numbers rows by ranges of equal size instead of time chunks, so a
  series may have all its rows at one time.
* ``slice_rows`` takes the newest or oldest n rows of every series.

Key and order columns must not be null, as in the candle and trade tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions.times import micros, span_micros
from tickloom.sources.staging import stage

CHUNK = "_chunk"
ROW = "_row"
BLOCK = "_block"
LEAD = "_lead"

# A week of 1-minute candles is 10 080 rows; raw trades want a shorter chunk.
CANDLE_CHUNK = "7 days"
TICK_CHUNK = "1 hour"
BLOCK_ROWS = 4096


def with_chunk(df: DataFrame, stamp: str, span: str) -> DataFrame:
    """Adds the number of the time chunk each row falls in.

    Never null: for a nullable join key Spark would repeat the whole expression
    behind it in a null filter next to the scan.
    """
    at = micros(stamp)
    width = F.lit(span_micros(span))
    chunk = ((at - F.pmod(at, width)) / width).cast("long")
    return df.withColumn(CHUNK, F.coalesce(chunk, F.lit(0)))


def index_rows(
    df: DataFrame, keys: list[str], order: list[str], span: str = CANDLE_CHUNK, name: str = ROW
) -> DataFrame:
    """Numbers the rows of each series from 1 in ``order`` (time column first).

    The rows are shuffled once, by (keys, chunk), and the join with the chunk
    offsets needs that same partitioning.
    """
    chunked = with_chunk(df, order[0], span)
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        chunked.groupBy(*keys, CHUNK)
        .agg(F.count(F.lit(1)).alias("_size"))
        .select(*keys, CHUNK, F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order)
    return (
        chunked.withColumn("_local", F.row_number().over(inside))
        .join(offsets, [*keys, CHUNK])
        .withColumn(name, F.col("_offset") + F.col("_local"))
        .drop(CHUNK, "_local", "_offset")
    )


def number_rows(df: DataFrame, keys: list[str], order: list[str], name: str = ROW) -> DataFrame:
    """Numbers the rows of each series from 1 in ``order``, however they are spread over keys and times.

    The rows are dealt into sorted ranges of about equal size, so a series with many rows fills several of them.  Rows
    that agree in keys and order are dealt out too; which of them comes first is not defined.  The ranges are staged;
    the counts of each series in each range give the offsets.
    """
    ranged = df.withColumn("_salt", F.monotonically_increasing_id())
    by = [*keys, *order, "_salt"]
    ranged = ranged.repartitionByRange(*by).sortWithinPartitions(*by).drop("_salt")
    placed = stage(
        ranged.withColumns({"_range": F.spark_partition_id(), "_at": F.monotonically_increasing_id()}), "ranges"
    )
    runs = placed.groupBy(*keys, "_range").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_size"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = runs.select(*keys, "_range", "_first", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    return (
        placed.join(offsets, [*keys, "_range"])
        .withColumn(name, F.col("_at") - F.col("_first") + F.col("_offset") + 1)
        .drop("_range", "_at", "_first", "_offset")
    )


@dataclass(frozen=True)
class Blocks:
    """Indexed rows in blocks of ``size`` rows, with leading context rows."""

    df: DataFrame
    keys: list[str]
    size: int

    @staticmethod
    def cut(indexed: DataFrame, keys: list[str], lookback: int, size: int = BLOCK_ROWS) -> Blocks:
        size = max(size, lookback)
        own = F.floor((F.col(ROW) - 1) / F.lit(size)).cast("long")
        place = F.pmod(F.col(ROW) - 1, F.lit(size))
        # The last `lookback` rows of a block are also context for the next one.
        homes = F.when(place >= size - lookback, F.array(own, own + 1)).otherwise(F.array(own))
        df = indexed.withColumn("_own", own).withColumn(BLOCK, F.explode(homes))
        df = df.withColumn(LEAD, F.col(BLOCK) != F.col("_own")).drop("_own")
        return Blocks(df, keys, size)

    def frame(self, first: int, last: int) -> WindowSpec:
        return self.ordered().rowsBetween(first, last)

    def upto(self) -> WindowSpec:
        """From the start of the block (context included) to the current row."""
        return self.ordered().rowsBetween(Window.unboundedPreceding, 0)

    def ordered(self) -> WindowSpec:
        return Window.partitionBy(*self.keys, BLOCK).orderBy(ROW)

    def place(self) -> Column:
        """Position in the block from 0; negative on context rows."""
        return F.col(ROW) - 1 - F.col(BLOCK) * self.size

    def add(self, columns: dict[str, Column]) -> Blocks:
        return Blocks(self.df.withColumns(columns), self.keys, self.size)

    def rows(self) -> DataFrame:
        """The blocks' own rows, with the row number kept."""
        return self.df.filter(~F.col(LEAD)).drop(BLOCK, LEAD)


def numbered(
    df: DataFrame, keys: list[str], order: list[str], span: str = CANDLE_CHUNK, row: str | None = None
) -> DataFrame:
    """Indexed rows: by an existing row number when ``row`` names one, which costs
    nothing, else by ``index_rows``."""
    return df.withColumn(ROW, F.col(row)) if row else index_rows(df, keys, order, span)


def _merged(kind: str, pre: Column, own: Column, data_type: T.DataType) -> Column:
    """Earlier chunks and own chunk together; a missing part counts as nothing."""
    if kind == "last":
        return F.coalesce(own, pre)
    if kind in ("min", "max"):
        return F.least(pre, own) if kind == "min" else F.greatest(pre, own)
    if kind == "xor":
        return F.coalesce(pre.bitwiseXOR(own), own, pre)
    if isinstance(data_type, T.DecimalType):
        # Adding two decimal(38, s) would give up a digit of scale.
        narrow = T.DecimalType(min(data_type.precision, 37), data_type.scale)
        pre, own = pre.cast(narrow), own.cast(narrow)
    both = pre * own if kind == "product" else pre + own
    return F.coalesce(both, own, pre).cast(data_type)


_KINDS = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "product": F.product,
    "xor": F.bit_xor,
    "last": lambda column: F.last(column, ignorenulls=True),
}


def _running_chunks(
    chunked: DataFrame, keys: list[str], order: list[str], columns: dict[str, tuple[str, str]], end: int = 0
) -> DataFrame:
    """Running aggregates of rows that know their chunk, up to ``end`` rows after the current one (0 or -1)."""

    def summed(name: str, kind: str, source: str) -> Column:
        if kind == "last":
            by = F.struct(*order) if len(order) > 1 else F.col(order[0])
            return F.max_by(source, F.when(F.col(source).isNotNull(), by)).alias(f"_all_{name}")
        return _KINDS[kind](source).alias(f"_all_{name}")

    summary = chunked.groupBy(*keys, CHUNK).agg(*[summed(name, *spec) for name, spec in columns.items()])
    earlier = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carried = summary.select(
        *keys,
        CHUNK,
        *[_KINDS[kind](f"_all_{name}").over(earlier).alias(f"_pre_{name}") for name, (kind, _) in columns.items()],
    )
    inside = Window.partitionBy(*keys, CHUNK).orderBy(*order).rowsBetween(Window.unboundedPreceding, end)
    local = chunked.withColumns(
        {f"_in_{name}": _KINDS[kind](source).over(inside) for name, (kind, source) in columns.items()}
    )
    joined = local.join(carried, [*keys, CHUNK])
    out = joined.withColumns(
        {
            name: _merged(kind, F.col(f"_pre_{name}"), F.col(f"_in_{name}"), joined.schema[f"_in_{name}"].dataType)
            for name, (kind, _) in columns.items()
        }
    )
    spent = [f"_{part}_{name}" for name in columns for part in ("pre", "in")]
    return out.drop(CHUNK, *spent)


def running(
    df: DataFrame, keys: list[str], order: list[str], columns: dict[str, tuple[str, str]], span: str
) -> DataFrame:
    """Unbounded running aggregates, in two levels.

    ``columns`` maps an output name to ``(kind, input)`` with kind sum, min, max,
    product, xor (of integers) or last (not null).  Each (keys, chunk) is scanned on its own; the
    totals of the earlier chunks come from the per-chunk summary.  ``order``
    starts with a timestamp and has to be total for the result to be
    deterministic.
    """
    return _running_chunks(with_chunk(df, order[0], span), keys, order, columns)


def running_rows(
    df: DataFrame, keys: list[str], columns: dict[str, tuple[str, str]], row: str = ROW, end: int = 0,
    size: int = BLOCK_ROWS,
) -> DataFrame:
    """``running`` over numbered rows, in chunks of ``size`` numbers; ``end`` -1 leaves the row itself out."""
    chunk = F.floor((F.col(row) - 1) / F.lit(size)).cast("long")
    return _running_chunks(df.withColumn(CHUNK, F.coalesce(chunk, F.lit(0))), keys, [row], columns, end)


#: Spark limits rank bounds up to this before the shuffle.
LIMITED_RANK = 1000


def slice_rows(
    df: DataFrame, keys: list[str], order: list[str], n: int, side: str = "newest", name: str = ROW,
    span: str = CANDLE_CHUNK,
) -> DataFrame:
    """The newest or oldest ``n`` rows of each series, numbered from 1 in
    ascending order.

    Up to ``LIMITED_RANK`` Spark limits each input partition to n rows per series
    before the shuffle; for more the rows are numbered in two levels.  Either way
    no task sorts a hot series.
    """
    if side not in ("newest", "oldest"):
        raise ValueError(f"side must be newest or oldest, got {side!r}")
    if n > LIMITED_RANK:
        indexed = index_rows(df, keys, order, span, name)
        if side == "oldest":
            return indexed.filter(F.col(name) <= n)
        sizes = indexed.groupBy(*keys).agg(F.greatest(F.max(name) - n, F.lit(0)).alias("_skipped"))
        newest = indexed.join(sizes, keys).withColumn(name, F.col(name) - F.col("_skipped"))
        return newest.filter(F.col(name) > 0).drop("_skipped")
    ranked = [F.col(c).desc() for c in order] if side == "newest" else [F.col(c) for c in order]
    picked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*ranked)))
    picked = picked.filter(F.col("_rank") <= n)
    if side == "oldest":
        return picked.withColumnRenamed("_rank", name)
    # n rows per series at most from here on.
    ascending = Window.partitionBy(*keys).orderBy(F.col("_rank").desc())
    return picked.withColumn(name, F.row_number().over(ascending)).drop("_rank")
