"""Streams against their batch forms, and sinks under replay."""

import json
import random
from collections import deque
from datetime import timedelta

from pyspark.sql import functions as F

from helpers import TRADE_DDL, at, trade
from tickloom.operators import candles as C
from tickloom.sources import readers, sinks
from tickloom.streaming import ingest, jobs as J


def stream_of(spark, folder, batches, ddl=TRADE_DDL):
    """A file stream that delivers one batch of rows per micro-batch, in order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ddl).coalesce(1).write.parquet(f"{folder}/{i:03d}")
    schema = spark.read.parquet(f"{folder}/000").schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("latestFirst", "false").parquet(f"{folder}/*")


def drained(spark, stream, folder):
    query = J.to_files(stream, f"{folder}/out", f"{folder}/check", every=None)
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out"), query


def test_candles_once_their_minute_is_over(spark, tmp_path):
    rng = random.Random(1)
    rows = [trade(rng.choice(["BTCUSDT", "ETHUSDT"]), i * 7, 100 + rng.random(), trade_id=str(i)) for i in range(300)]
    stream = stream_of(spark, str(tmp_path / "in"), [rows[i : i + 100] for i in range(0, 300, 100)])
    out, _ = drained(spark, J.candle_rows(J.candle_stream(stream)), str(tmp_path))
    mark = at(299 * 7 - 60)
    batch = C.trade_candles(spark.createDataFrame(rows, TRADE_DDL)).filter(F.col("close_time") <= F.lit(mark).cast("timestamp"))
    columns = ["symbol", "open_time", "open", "high", "low", "close", "trades_count", "close_time"]
    assert out.count() == batch.count() > 50
    assert out.select(columns).exceptAll(batch.select(columns)).count() == 0


def test_late_trades_do_not_reopen_a_candle(spark, tmp_path):
    batches = [
        [trade(second=0, price=1.0, trade_id="1"), trade(second=130, price=2.0, trade_id="2")],
        # 65 s is behind the watermark of 70 s, but its candle is still open.
        [trade(second=65, price=3.0, trade_id="3")],
        # The candle of 5 s has been emitted by now.
        [trade(second=5, price=99.0, trade_id="4")],
        [trade(second=400, price=4.0, trade_id="5")],
    ]
    stream = stream_of(spark, str(tmp_path / "in"), batches)
    out, query = drained(spark, J.candle_rows(J.candle_stream(stream)), str(tmp_path))
    got = {r.open_time: (r.high, r.trades_count) for r in out.collect()}
    assert got == {at(0): (1.0, 1), at(60): (3.0, 1), at(120): (2.0, 1)}
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in json.loads(p.json if isinstance(p.json, str) else p.json())["stateOperators"])
    assert dropped == 1


def test_rollups_from_the_stream(spark, tmp_path):
    rows = [trade(second=i * 20, price=100.0 + i % 11, trade_id=str(i)) for i in range(200)]
    stream = stream_of(spark, str(tmp_path / "in"), [rows])
    hours = J.rollup_stream(J.candle_stream(stream), "5 minutes")
    out, _ = drained(spark, hours, str(tmp_path))
    batch = {r.open_time: (r.open, r.high, r.low, r.close, r.trades_count) for r in C.trade_candles(spark.createDataFrame(rows, TRADE_DDL), "5 minutes").collect()}
    got = {r.window.start: (r.open, r.high, r.low, r.close, r.trades_count) for r in out.collect()}
    assert len(got) >= 10 and all(batch[k] == v for k, v in got.items())


def gate_loop(prices):
    recent, verdicts = deque(maxlen=100), []
    for price in prices:
        ok = True
        if len(recent) >= 10:
            mean = sum(recent) / len(recent)
            ok = not (mean > 0 and abs(price - mean) / mean > 0.5)
        if ok:
            recent.append(price)
        verdicts.append(ok)
    return verdicts


def test_accuracy_state_spans_batches(spark, tmp_path):
    rng = random.Random(3)
    prices = {s: [100 * rng.choice([1, 1, 1, 1, 0.4, 1.6, 3]) * rng.uniform(0.95, 1.05) for _ in range(260)] for s in ("BTCUSDT", "ETHUSDT")}
    rows = [trade(s, i, p, trade_id=f"{i:04d}") for s in prices for i, p in enumerate(prices[s])]
    rows.sort(key=lambda r: r[1])
    stream = stream_of(spark, str(tmp_path / "in"), [rows[i : i + 130] for i in range(0, 520, 130)])
    out, _ = drained(spark, J.accuracy_stream(stream), str(tmp_path))
    for symbol, series in prices.items():
        got = [r.accepted for r in out.filter(F.col("symbol") == symbol).orderBy("timestamp").collect()]
        assert got == gate_loop(series) and not all(got)


def shuffled_batches(rows, parts, lateness, rng):
    """Rows in the order of arrival, each up to ``lateness`` seconds after its time, in so many files."""
    late = sorted(rows, key=lambda r: r[1].timestamp() + rng.uniform(0, lateness))
    size = -(-len(late) // parts)
    return [late[i : i + size] for i in range(0, len(late), size)]


def test_shuffled_files_give_the_batch_verdicts(spark, tmp_path):
    """Trades up to a minute late, over seven files: the verdicts are those of one pass in order of time and id."""
    rng = random.Random(5)
    prices = {s: [100 * rng.choice([1, 1, 1, 1, 0.4, 1.6, 3]) * rng.uniform(0.95, 1.05) for _ in range(250)] for s in ("BTCUSDT", "ETHUSDT")}
    # Two trades of one instant, ids 9 and 10 among them.
    rows = [trade(s, 3 * (i // 2), p, trade_id=str(i)) for s in prices for i, p in enumerate(prices[s])]
    batches = shuffled_batches(rows, 7, 60, rng)
    assert any(a[1] > b[1] for x, y in zip(batches, batches[1:]) for a in x for b in y)
    out, _ = drained(spark, J.accuracy_stream(stream_of(spark, str(tmp_path / "in"), batches), "1 minute"), str(tmp_path))
    closed = max(r[1] for r in rows) - timedelta(minutes=1)
    got = {(r.symbol, int(r.trade_id)): r.accepted for r in out.collect()}
    expected = {(s, i): ok for s in prices for i, ok in enumerate(gate_loop(prices[s])) if at(3 * (i // 2)) <= closed}
    assert got == expected and 400 < len(got) < 500 and len(set(got.values())) == 2


def test_late_trades_are_counted_and_failed_ones_never_late(spark, tmp_path):
    batches = [
        [trade(second=0, trade_id="1"), trade(second=600, trade_id="2")],
        [trade(second=700, trade_id="3"), trade(second=9000, trade_id="bad", side="hold")],
        [trade(second=10, trade_id="late"), trade(second=20, trade_id="old", side="hold"), trade(second=690, trade_id="4")],
        [trade(second=800, trade_id="5"), (None, None, 5.0, 1.0, "hold", None, None)],
    ]
    stream = stream_of(spark, str(tmp_path / "in"), batches)
    judged = stream.withColumn("failed_dimension", F.when(F.col("side") == "hold", "validity"))
    out, query = drained(spark, J.gate_stream(judged, "1 minute"), str(tmp_path))
    got = {r.trade_id: r.failed_dimension for r in out.collect()}
    assert got == {"1": None, "2": None, "3": None, "4": None, "bad": "validity", "old": "validity", None: "validity"}
    assert dict(out.dtypes) == dict(judged.dtypes)
    dropped = sum(s["numRowsDroppedByWatermark"] for p in query.recentProgress for s in json.loads(p.json if isinstance(p.json, str) else p.json())["stateOperators"])
    assert dropped == 1


def test_exact_deviation_is_accepted():
    assert J.judge_prices(deque([100.0] * 10, maxlen=100), [150.0]) == [True]
    assert J.judge_prices(deque([100.0] * 10, maxlen=100), [150.0001]) == [False]
    assert J.judge_prices(deque([100.0] * 9, maxlen=100), [9999.0]) == [True]


def test_redelivered_trades_count_once(spark, tmp_path):
    rows = [trade(second=i, trade_id=str(i)) for i in range(20)]
    stream = stream_of(spark, str(tmp_path / "in"), [rows, rows[10:]])
    out, _ = drained(spark, J.deduplicated(stream), str(tmp_path))
    assert out.count() == 20


def test_latest_price_and_replay(spark, tmp_path):
    batches = [[trade(second=5, price=1.0), trade("ETHUSDT", 9, 7.0)], [trade(second=50, price=2.0)], [trade(second=20, price=3.0)]]
    stream = stream_of(spark, str(tmp_path / "in"), batches)
    path = str(tmp_path / "latest")
    J.start(J.latest_price_stream(stream), str(tmp_path / "c"), J.to_latest(path), "update", every=None).awaitTermination()
    J.start(J.latest_price_stream(stream), str(tmp_path / "c2"), J.to_latest(path), "update", every=None).awaitTermination()
    got = {r.symbol: (r.price, r.price_time) for r in spark.read.parquet(path).collect()}
    assert got == {"BTCUSDT": (2.0, at(50)), "ETHUSDT": (7.0, at(9))}


def test_bars_prefer_the_final_update(spark):
    ddl = "symbol string, interval string, time long, open double, high double, low double, close double, is_final boolean, arrival long"
    rows = [("BTCUSDT", "1m", 60, 1.0, 1.0, 1.0, 1.0, False, 1), ("BTCUSDT", "1m", 60, 1.0, 1.0, 1.0, 2.0, True, 2), ("BTCUSDT", "1m", 60, 1.0, 1.0, 1.0, 3.0, False, 3), ("BTCUSDT", "5m", 60, 1.0, 1.0, 1.0, 9.0, False, 4)]
    updates = spark.createDataFrame(rows, ddl)
    got = {r.interval: (r.close, r.is_final) for r in J.latest_klines(updates).collect()}
    assert got == {"1m": (2.0, True), "5m": (9.0, False)}
    assert J.only_series(updates, "btcusdt", "1m").count() == 3


def test_ingest_from_messages_to_tables(spark, tmp_path):
    def message(i, **change):
        body = {"symbol": "BTCUSDT", "timestamp": at(i).isoformat() + "Z", "price": 100.0 + i, "volume": 1, "side": "buy", "trade_id": str(i + 1), "source": "bybit", **change}
        return (str(i).encode(), json.dumps(body).encode(), "btcusdt-bybit")

    rows = [message(i) for i in range(60)] + [message(61, side="hold"), message(62, trade_id="0"), message(-400, price=5.0), message(63, price=900.0), (b"x", None, "t")]
    ddl = "key binary, value binary, topic string"
    spark.createDataFrame(rows, ddl).write.parquet(str(tmp_path / "messages"))
    messages = readers.message_stream(spark, "parquet", path=str(tmp_path / "messages"))
    tables = ingest.Tables(*[str(tmp_path / name) for name in ("bronze", "rejects", "latest", "candles")])
    now = F.lit("2024-01-01 00:01:05").cast("timestamp")
    storage = ingest.start_storage(messages, tables, str(tmp_path / "c1"), every=None, as_of=now, processing_time=now)
    storage.awaitTermination()
    ingest.start_candles(spark, tables, str(tmp_path / "c2"), every=None).awaitTermination()
    assert readers.read_bronze(spark, tables.bronze).count() == 60
    rejects = {r.failed_dimension: r["count"] for r in spark.read.parquet(tables.rejects).groupBy("failed_dimension").count().collect()}
    assert rejects == {"validity": 2, "consistency": 1, "timeliness": 1, "accuracy": 1}
    assert spark.read.parquet(tables.latest).first().price == 159.0
    candle = spark.read.parquet(tables.candles).first()
    assert (candle.open, candle.close, candle.trades_count) == (100.0, 159.0, 60)
    metrics = [p.observedMetrics["quality"] for p in storage.recentProgress if "quality" in p.observedMetrics]
    assert sum(m.all_records for m in metrics) == 65


# --- sinks ---------------------------------------------------------------------------------------


def bronze_input(spark, rows):
    return spark.createDataFrame(rows, TRADE_DDL).withColumns(
        {"processing_time": F.lit(at(0)).cast("timestamp"), "date_partition": F.to_date("timestamp")}
    )


def test_bronze_is_partitioned_and_pruned(spark, tmp_path):
    day = 86400
    rows = [trade(second=d * day + i, trade_id=f"{d}-{i}") for d in range(4) for i in range(10)]
    path = str(tmp_path / "bronze")
    sinks.write_bronze(bronze_input(spark, rows[:20]), path)
    sinks.write_bronze(bronze_input(spark, rows[20:]), path, spread=True)
    out = readers.read_bronze(spark, path, start="2024-01-02 00:00:05", end="2024-01-03 00:00:05")
    assert out.count() == 10
    assert readers.read_bronze(spark, path).count() == 40
    assert dict(out.dtypes)["timestamp"] == "timestamp_ntz"
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date_partition" in plan and "PushedFilters: [IsNotNull(timestamp)" in plan


def test_partial_candle_never_replaces_a_full_one(spark, tmp_path):
    path = str(tmp_path / "candles")
    full = C.trade_candles(spark.createDataFrame([trade(second=i, price=1.0 + i) for i in range(5)], TRADE_DDL))
    late = C.trade_candles(spark.createDataFrame([trade(second=9, price=50.0), trade(second=70)], TRADE_DDL))
    for batch in (full, late, full):
        sinks.upsert_candles(batch, path)
    got = {r.open_time: (r.close, r.trades_count) for r in spark.read.parquet(path).collect()}
    assert got == {at(0): (5.0, 5), at(60): (100.0, 1)}


def test_event_envelope(spark):
    ddl = "aggregateId string, userId string, id string, type string, timestamp string, correlationId string"
    rows = [("a", "u", "i", "order.created", "2024-01-01T00:00:00.000Z", "c"), (None, "u", "i", "order.filled", None, None), (None, None, "i", "x", None, None)]
    sent = sinks.event_messages(spark.createDataFrame(rows, ddl), "svc", F.lit(at(1)).cast("timestamp")).collect()
    assert [m.key for m in sent] == ["a", "u", "i"]
    body = json.loads(sent[1].value)
    assert body["timestamp"] == "2024-01-01T00:00:01.000Z" and body["service"] == "svc" and body["type"] == "order.filled"
    assert sent[0].headers[1].value == "c" and len(sent[1].headers[1].value) == 36


def test_months_and_lake_table(spark, tmp_path):
    rows = spark.createDataFrame([(1, at(0)), (2, at(86400 * 40))], "id long, ts timestamp")
    sinks.write_months(rows, str(tmp_path / "m"), "ts")
    assert {r.month: r["count"] for r in spark.read.parquet(str(tmp_path / "m")).groupBy("month").count().collect()} == {"2024-01": 1, "2024-02": 1}
    table = sinks.create_lake_table(spark, "lake_trades", str(tmp_path / "t"))
    assert table.columns == ["symbol", "timestamp", "price", "volume", "side", "trade_id", "source"]


def test_few_files_and_no_copies_after_many_batches(spark, tmp_path):
    """Twenty micro-batches of bronze rows and prices: one file for a batch and day, and nothing staged is left."""
    import os
    from pathlib import Path

    from helpers import TRADE_DDL, trade
    from tickloom.operators.normalize import CANONICAL
    from tickloom.sources import sinks
    from tickloom.sources.staging import shared_folder

    before = set(os.listdir(shared_folder(spark)))
    for i in range(20):
        rows = spark.createDataFrame([trade(second=60 * i + j, trade_id=f"{i}-{j}", symbol=f"S{j}USDT") for j in range(8)], TRADE_DDL).repartition(4)
        whole = rows.withColumns({"processing_time": F.col("timestamp"), "date_partition": F.to_date("timestamp")}).select(*CANONICAL)
        sinks.write_bronze(whole, f"{tmp_path}/bronze")
        sinks.publish_latest(rows.select("symbol", "price", F.col("timestamp").alias("price_time")), f"{tmp_path}/prices")
    assert len(list(Path(f"{tmp_path}/bronze").rglob("*.parquet"))) == 20
    prices = spark.read.parquet(f"{tmp_path}/prices")
    assert prices.count() == 8 and len(list(Path(f"{tmp_path}/prices").rglob("*.parquet"))) <= sinks.PRICE_BUCKETS
    assert set(os.listdir(shared_folder(spark))) == before


def test_replayed_batches_are_in_the_lake_once(spark, tmp_path):
    """A batch written twice, one that broke off after some files, and the same number from another query."""
    import os

    rows = [trade(second=3600 * i, trade_id=str(i)) for i in range(60)]
    path = str(tmp_path / "bronze")
    first, second = bronze_input(spark, rows[:40]), bronze_input(spark, rows[40:])
    for _ in range(2):
        sinks.write_bronze(first, path, batch=("q", 0))
    assert readers.read_bronze(spark, path).count() == 40
    # What an attempt leaves that ends between its files and its last marker.
    sinks.write_bronze(second, path, batch=("q", 1))
    os.remove(f"{path}/_batches/batch-q-1.done")
    sinks.write_bronze(second, path, batch=("q", 1))
    assert sorted(int(r.trade_id) for r in readers.read_bronze(spark, path).collect()) == list(range(60))
    assert {f.split(".")[0] for f in os.listdir(f"{path}/_batches") if not f.startswith(".")} == {"batch-q-1"}
    sinks.write_bronze(first, path, batch=("q", 10))
    sinks.write_bronze(second, path, batch=("other", 1))
    os.remove(f"{path}/_batches/batch-other-1.done")
    sinks.write_bronze(second.limit(0), path, batch=("other", 1))
    assert readers.read_bronze(spark, path).count() == 100


def test_a_query_that_fails_after_its_write_goes_on(spark, tmp_path):
    rows = [trade(second=i, trade_id=str(i)) for i in range(30)]
    stream = stream_of(spark, str(tmp_path / "in"), [rows[:10], rows[10:20], rows[20:]])
    trades = stream.withColumns({"processing_time": F.lit(at(0)).cast("timestamp"), "date_partition": F.to_date("timestamp")})
    write, path, failed = J.to_bronze(str(tmp_path / "bronze")), str(tmp_path / "bronze"), []

    def breaks_off(batch, number):
        write(batch, number)
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("lost after the write")

    query = J.start(trades, str(tmp_path / "check"), breaks_off, every=None)
    try:
        query.awaitTermination()
    except Exception as error:
        assert "lost after the write" in str(error)
    assert failed == [1]
    J.start(trades, str(tmp_path / "check"), breaks_off, every=None).awaitTermination()
    assert sorted(int(r.trade_id) for r in readers.read_bronze(spark, path).collect()) == list(range(30))


def test_counters_of_every_batch_are_kept(spark, tmp_path):
    log = J.CounterLog(spark, str(tmp_path / "counters"))
    spark.streams.addListener(log)
    try:
        batches = [[trade(second=i, trade_id=str(i)) for i in range(20)], [trade(second=500, trade_id="a"), trade(second=501, side="hold", trade_id="b")],
                   [trade(second=900, price=1e6, trade_id="c")], [trade(second=1, trade_id="late"), trade(second=2000, trade_id="d")]]
        stream = stream_of(spark, str(tmp_path / "in"), batches)
        judged = stream.withColumn("failed_dimension", F.when(F.col("side") == "hold", "validity"))
        drained(spark, J.observed(J.gate_stream(judged, "1 minute")), str(tmp_path))
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(log)
    kept = spark.read.parquet(str(tmp_path / "counters"))
    got = kept.agg(*[F.sum(c).alias(c) for c in ("input_rows", "late_rows", "all_records", "failed_validity", "failed_accuracy")]).first()
    assert tuple(got) == (25, 1, 23, 1, 1)
    assert kept.select("query", "batch").distinct().count() == kept.count() >= 4
