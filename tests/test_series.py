import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from helpers import CANDLE_DDL, closes, walk
from tickloom.operators.series import BLOCK, LEAD, ROW, Blocks, index_rows, number_rows, running, running_rows, slice_rows


@pytest.fixture(scope="module")
def candles(spark):
    # One symbol holds most rows; gaps leave some chunks empty.
    frame = closes({"HOT": walk(3000, 1), "B": walk(37, 2), "C": [5.0]})
    frame = frame[~((frame.symbol == "HOT") & frame.open_time.between("2024-02-01", "2024-03-05"))]
    return spark.createDataFrame(frame, CANDLE_DDL).repartition(7)


def test_row_numbers_equal_a_window(candles):
    indexed = index_rows(candles, ["symbol"], ["open_time"], "3 days")
    expected = F.row_number().over(Window.partitionBy("symbol").orderBy("open_time"))
    assert indexed.withColumn("n", expected).filter(F.col("n") != F.col(ROW)).count() == 0
    assert indexed.count() == candles.count()


def test_numbers_by_ranges_equal_a_window(candles):
    numbered = number_rows(candles, ["symbol"], ["open_time"])
    expected = F.row_number().over(Window.partitionBy("symbol").orderBy("open_time"))
    assert numbered.withColumn("n", expected).filter(F.col("n") != F.col(ROW)).count() == 0
    assert numbered.count() == candles.count()


def test_equal_rows_are_dealt_to_several_ranges(spark):
    # Nine tenths of all rows stand at one time of one symbol.
    rows = spark.range(40_000).select(
        F.when(F.col("id") % 10 > 0, "HOT").otherwise("B").alias("symbol"),
        F.when(F.col("id") % 10 > 0, 0).otherwise(F.col("id")).alias("open_time"),
    )
    numbered = number_rows(rows, ["symbol"], ["open_time"]).persist()
    for symbol, count in (("HOT", 36_000), ("B", 4_000)):
        own = numbered.filter(F.col("symbol") == symbol).agg(F.min(ROW), F.max(ROW), F.count_distinct(ROW)).first()
        assert own == (1, count, count)
    salted = rows.withColumn("s", F.monotonically_increasing_id()).repartitionByRange(4, "symbol", "open_time", "s")
    sizes = [r["count"] for r in salted.groupBy(F.spark_partition_id()).count().collect()]
    assert max(sizes) < 2 * sorted(sizes)[len(sizes) // 2]
    numbered.unpersist()


def test_running_xor(candles):
    hashed = index_rows(candles, ["symbol"], ["open_time"]).withColumn("h", F.xxhash64("symbol", "open_time"))
    out = running_rows(hashed, ["symbol"], {"x": ("xor", "h")}, size=100)
    whole = F.bit_xor("h").over(Window.partitionBy("symbol").orderBy(ROW))
    assert out.withColumn("w", whole).filter(F.col("w") != F.col("x")).count() == 0


def test_no_block_outgrows_its_size(candles):
    blocks = Blocks.cut(index_rows(candles, ["symbol"], ["open_time"]), ["symbol"], 20, 128)
    sizes = blocks.df.groupBy("symbol", BLOCK).agg(F.count_if(~F.col(LEAD)).alias("own"), F.count("*").alias("all"))
    assert sizes.agg(F.max("own"), F.max("all")).first() == (128, 148)
    assert blocks.rows().count() == candles.count()


def test_bounded_frame_equals_whole_series(candles):
    blocks = Blocks.cut(index_rows(candles, ["symbol"], ["open_time"]), ["symbol"], 29, 64)
    mine = blocks.add({"m": F.avg("close").over(blocks.frame(-29, 0))}).rows()
    whole = F.avg("close").over(Window.partitionBy("symbol").orderBy("open_time").rowsBetween(-29, 0))
    assert mine.withColumn("w", whole).filter(F.abs(F.col("w") - F.col("m")) > 1e-9).count() == 0


def test_running_equals_unbounded_window(candles):
    signed = candles.withColumn("x", F.col("close") - 100)
    out = running(
        signed, ["symbol"], ["open_time"], {"s": ("sum", "x"), "lo": ("min", "x"), "hi": ("max", "x")}, "2 days"
    )
    whole = Window.partitionBy("symbol").orderBy("open_time").rowsBetween(Window.unboundedPreceding, 0)
    checked = out.select(
        (F.abs(F.sum("x").over(whole) - F.col("s")) > 1e-6).alias("a"),
        (F.min("x").over(whole) != F.col("lo")).alias("b"),
        (F.max("x").over(whole) != F.col("hi")).alias("c"),
    )
    assert out.count() == candles.count()
    assert checked.filter("a or b or c").count() == 0


@pytest.mark.parametrize("side,ascending", [("newest", False), ("oldest", True)])
def test_slices(candles, side, ascending):
    out = slice_rows(candles, ["symbol"], ["open_time"], 10, side).toPandas()
    frame = candles.toPandas().sort_values("open_time", ascending=ascending)
    expected = frame.groupby("symbol").head(10)
    assert set(zip(out.symbol, out.open_time)) == set(zip(expected.symbol, expected.open_time))
    for _, part in out.groupby("symbol"):
        part = part.sort_values("open_time")
        assert list(part[ROW]) == list(range(1, len(part) + 1))


def test_slice_limits_before_the_shuffle(candles):
    plan = slice_rows(candles, ["symbol"], ["open_time"], 1000)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_unknown_side(candles):
    with pytest.raises(ValueError):
        slice_rows(candles, ["symbol"], ["open_time"], 10, "middle")
