"""Streaming forms of the candle, price and quality operators.

Every function takes a streaming DataFrame and returns one; ``start`` and the
sinks attach it to storage.  Sources replay from their checkpoint; the keyed sinks
come out the same after a replay, and the appends hold every batch once (T7).
"""

from __future__ import annotations

import itertools
import tempfile
from collections import deque
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickloom.operators.candles import close_time, event_offset, event_order, first_by, id_turn, last_by
from tickloom.operators.quality import FAILED, judge_prices, quality_report
from tickloom.schemas import ACCURACY_MIN_HISTORY, ACCURACY_WINDOW, MAX_DEVIATION, QUALITY_DIMENSIONS
from tickloom.sources import sinks
from tickloom.sources.staging import fresh_path
from tickloom.streaming import runs as R

FLUSH_EVERY = "30 seconds"
BATCH_EVERY = "5 seconds"


def candle_stream(trades: DataFrame, lateness: str = "1 minute", span: str = "1 minute") -> DataFrame:
    """Candles emitted once when the watermark passes their end.

    Trades later than the watermark are dropped and counted in the query's
    progress; they never reopen a candle.
    """
    rank = event_order(trades, event_offset("timestamp", span), "trade_id")
    # The watermark needs an instant, not a time without zone.
    timed = trades.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)
    grouped = timed.groupBy("symbol", F.window("timestamp", span)).agg(
        first_by("price", rank).alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        last_by("price", rank).alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("trades_count"),
    )
    return grouped


def candle_rows(windowed: DataFrame, span: str = "1 minute") -> DataFrame:
    """Windowed aggregates as candle rows."""
    start = F.col("window")["start"]
    return windowed.select(
        "symbol", start.alias("open_time"), "open", "high", "low", "close", "volume",
        close_time(start, span, inclusive=False).alias("close_time"), "trades_count",
    )


def rollup_stream(windowed: DataFrame, span: str) -> DataFrame:
    """Longer candles from the candle stream, chained on its event time."""
    at = F.col("window")["start"]
    rank = event_offset("_open", span)
    inner = windowed.withColumns({"_open": at, "_time": F.window_time("window")})
    grouped = inner.groupBy("symbol", F.window("_time", span)).agg(
        first_by("open", rank).alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        last_by("close", rank).alias("close"),
        F.sum("volume").alias("volume"),
        F.sum("trades_count").alias("trades_count"),
        F.count(F.lit(1)).alias("candles_count"),
    )
    return grouped


def latest_price_stream(trades: DataFrame) -> DataFrame:
    """Last price per symbol, for update mode; one state row per symbol.  Ties as in A9."""
    stamp = F.col("timestamp").cast("timestamp")
    return trades.groupBy("symbol").agg(
        last_by("price", event_order(trades, F.unix_micros(stamp), "trade_id")).alias("price"), F.max(stamp).alias("price_time")
    )


def latest_klines(updates: DataFrame, arrival: str = "arrival") -> DataFrame:
    """The current state of every bar, the final update before any other, else
    the last to arrive.  Works on batches too."""
    rank = F.struct(F.col("is_final"), F.col(arrival))
    bar = F.struct("open", "high", "low", "close", "is_final")
    return (
        updates.groupBy("symbol", "interval", "time")
        .agg(F.max_by(bar, rank).alias("_bar"))
        .select("symbol", "interval", "time", "_bar.*")
    )


def only_series(updates: DataFrame, symbol: str, interval: str) -> DataFrame:
    """Updates of one chart; symbols compare without case."""
    return updates.filter((F.lower("symbol") == symbol.lower()) & (F.col("interval") == interval))


def deduplicated(trades: DataFrame, lateness: str = "10 minutes") -> DataFrame:
    """Redelivered trades dropped within the watermark."""
    timed = trades.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withWatermark("timestamp", lateness)
    return timed.dropDuplicatesWithinWatermark(["trade_id"])


# --- accuracy gate with state ----------------------------------------------------------

# Accepted prices, and the trades that still wait for the watermark as an Arrow stream, or where they are many that of the
# sorted runs they are in.
_STATE = "prices array<double>, waiting binary"
#: Trades of a group that are judged at once; more of them go through sorted runs in files.
HELD_ROWS = 1 << 16
#: Trades of a series that a task packs into a value; more of them go into a file.
PACKED_ROWS = 1 << 12
PASSED, SERIES, EVENT_AT, EVENT_MICROS = "_passed", "_series", "_event_at", "_event_micros"
_SPREAD = 256


def _packed(rows: pd.DataFrame) -> bytes | None:
    if rows.empty:
        return None
    table = pa.Table.from_pandas(rows, preserve_index=False)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return sink.getvalue().to_pybytes()


def _unpacked(waiting: bytes) -> pd.DataFrame:
    return pa.ipc.open_stream(bytes(waiting)).read_all().to_pandas()


def _in_order(rows: pd.DataFrame, recent: deque) -> tuple[pd.DataFrame, list[bool]]:
    """Trades in order of (time, id) and their verdicts.  Without a column of event times their timestamps order them."""
    at = EVENT_MICROS if EVENT_MICROS in rows else "timestamp"
    turns = rows.assign(_turn=[id_turn(None if pd.isna(t) else str(t)) for t in rows["trade_id"]])
    ordered = turns.sort_values([at, "_turn"], kind="stable").drop(columns="_turn")
    return ordered, judge_prices(recent, ordered["price"])


def _judged(
    batches: Iterator[pd.DataFrame], state: GroupState, waits: bool = False
) -> tuple[pd.DataFrame, list[bool]] | None:
    """The trades of a group whose turn has come, judged; the others are kept in the state.

    Without ``waits`` that is every trade of the micro-batch, else those that the watermark has reached: no earlier one can
    come any more.
    """
    prices, waiting = state.get if state.exists else ([], None)
    parts = [b for b in batches if len(b)]
    if waiting is not None:
        parts.insert(0, _unpacked(waiting))
    rows = pd.concat(parts, ignore_index=True) if parts else None
    later = None
    if rows is not None and waits:
        mark = state.getCurrentWatermarkMs()
        due = rows[EVENT_MICROS] <= mark * 1000
        rows, later = rows[due], rows[~due]
    recent = deque(prices, maxlen=ACCURACY_WINDOW)
    judged = _in_order(rows, recent) if rows is not None and len(rows) else None
    held = later is not None and len(later)
    state.update((list(recent), _packed(later) if held else None))
    if held:
        # Fires once the watermark is past this millisecond, that is, at the first waiting trade.
        state.setTimeoutTimestamp(-(-int(later[EVENT_MICROS].min()) // 1000) - 1)
    return judged


def _turns(
    batches: Iterator[pd.DataFrame], state: GroupState, folder: str | None = None, arrived: list[R.Run] | None = None
) -> Iterator[tuple[pd.DataFrame, list[bool]]]:
    """``_judged`` in parts, for groups of any size: a task holds some batches of its trades at a time.

    Those that are due are sorted in files of the task, those that wait in files of ``folder``, which all executors see;
    with it trades wait for the watermark.  The state names the files, also those of the runs that ``arrived``.  One whose trades all have had their turn is
    deleted in a later micro-batch, when none that needs it can run again.
    """
    prices, waiting = state.get if state.exists else ([], None)
    runs, first = R.unpacked_runs(waiting), []
    held = _unpacked(waiting) if waiting is not None and runs is None else None
    rows, batches = 0 if held is None else len(held), iter(batches)
    for batch in batches:
        first.append(batch)
        rows += len(batch)
        if rows > HELD_ROWS:
            break
    if runs is None and not arrived and rows <= HELD_ROWS:
        ready = _judged(iter(first), state, folder is not None)
        if ready is not None:
            yield ready
        return
    at, until = EVENT_MICROS, state.getCurrentWatermarkMs() * 1000 if folder is not None else None
    for run in runs or []:
        if run.done == run.rows:
            run.delete()
    runs = [*(r for r in runs or [] if r.done < r.rows), *(arrived or [])]
    given = itertools.chain([] if held is None else [held], first, batches)
    recent = deque(prices, maxlen=ACCURACY_WINDOW)
    with tempfile.TemporaryDirectory(prefix="turns-") as own:
        due = []
        for table in R.sorted_tables((R.turned(b) for b in given if len(b)), at):
            n = table.num_rows if until is None else int(table[at].to_numpy().searchsorted(until, side="right"))
            if n:
                due.append(R.Run.write(table.slice(0, n), own, at))
            if n < table.num_rows:
                runs.append(R.Run.write(table.slice(n), folder, at))
        due += [r for r in runs if until is None or r.least <= until]
        for table in R.merged([r.tables(at, until) for r in due], at):
            ready = R.plain(table)
            yield ready, judge_prices(recent, ready["price"])
    if folder is not None:
        runs = R.lengthened(runs, folder, at)
    state.update((list(recent), R.packed_runs(runs)))
    times = [r.least for r in runs if r.done < r.rows]
    if times:
        state.setTimeoutTimestamp(-(-min(times) // 1000) - 1)


def _packed_series(trades: DataFrame) -> DataFrame:
    """``symbol, held``: the trades in few rows, as Spark passes a group to Python at once.  A value has some trades of a
    series or names sorted runs in the shared folder."""
    folder, at = fresh_path(trades.sparkSession, "arrived-trades"), EVENT_MICROS

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in _parts(batches):
            symbols, held = [], []
            for symbol, rows in batch.groupby("symbol", sort=False, dropna=False):
                symbols.append(None if pd.isna(symbol) else symbol)
                if len(rows) <= PACKED_ROWS:
                    held.append(_packed(rows))
                else:
                    (table,) = R.sorted_tables([R.turned(rows)], at)
                    held.append(R.packed_runs([R.Run.write(table, folder, at)]))
            yield pd.DataFrame({"symbol": pd.Series(symbols, dtype=object), "held": pd.Series(held, dtype=object)})

    kind = trades.schema["symbol"].dataType.simpleString()
    return trades.mapInPandas(pack, f"symbol {kind}, held binary")


def _parts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The batches, several together, of up to about ``HELD_ROWS`` rows."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows >= HELD_ROWS:
            yield pd.concat(held, ignore_index=True)
            held, rows = [], 0
    if rows:
        yield pd.concat(held, ignore_index=True)


def _waiting_folder(trades: DataFrame, lateness: str | None) -> str | None:
    return None if lateness is None else fresh_path(trades.sparkSession, "waiting-trades")


def _event_time(trades: DataFrame, lateness: str | None, judged: Column | None = None) -> DataFrame:
    """Adds the time that orders the trades.  With ``lateness`` it also moves the watermark, but for the rows that are not
    ``judged``: neither do they move it nor are they late."""
    at = F.col("timestamp").cast("timestamp")
    timed = trades.withColumn(EVENT_MICROS, F.coalesce(F.unix_micros(at), F.lit(0)))
    if lateness is None:
        return timed
    return timed.withColumn(EVENT_AT, at if judged is None else F.when(judged, at)).withWatermark(EVENT_AT, lateness)


def _timeout(lateness: str | None) -> str:
    return GroupStateTimeout.NoTimeout if lateness is None else GroupStateTimeout.EventTimeTimeout


def accuracy_stream(trades: DataFrame, lateness: str | None = None) -> DataFrame:
    """T4: every trade with whether its price is accepted, against the last 100
    accepted prices of its symbol.

    Each verdict depends on the ones before it, so the trades of a symbol are put in
    order of (timestamp, trade_id) in one task, beyond ``HELD_ROWS`` of them by sorted
    runs in the task's files, so that it holds a few batches of them at a time.

    With ``lateness`` trades wait in the state until the watermark reaches them, so
    the verdicts are those of the batch gate however the trades are spread over
    micro-batches.  The state is a hundred numbers and the trades of that span per
    symbol, or where these are many the names of files in the shared folder that hold
    them, which has to outlive the checkpoint then; trades that come later than that are dropped and counted in the query's
    progress, as in T1.  Without it a trade is judged in the micro-batch it arrives
    in, and between micro-batches the order of arrival counts.  A trade without a
    time is judged at once, before the others.
    """
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in trades.schema.fields)
    spent, folder = [EVENT_MICROS, EVENT_AT], _waiting_folder(trades, lateness)

    def judge(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        arrived = []
        if folder is None:
            values = [value for batch in batches for value in batch["held"]]
            named = [R.unpacked_runs(value) for value in values]
            arrived = [run for runs in named for run in runs or []]
            batches = (_unpacked(value) for value, runs in zip(values, named) if runs is None)
        for rows, verdicts in _turns(batches, state, folder, arrived):
            yield rows.drop(columns=spent, errors="ignore").assign(accepted=verdicts)

    timed = _event_time(trades, lateness)
    # With a lateness Spark drops and counts late trades by the row.
    series = _packed_series(timed) if folder is None else timed
    return series.groupBy("symbol").applyInPandasWithState(
        judge, f"{kinds}, accepted boolean", _STATE, "append", _timeout(lateness)
    )


def gate_stream(judged: DataFrame, lateness: str | None = None) -> DataFrame:
    """Q6 on a stream: trades judged by the row, those that passed judged by their
    price too, in event time with ``lateness`` as in ``accuracy_stream``.  The others
    pass through in spread groups of their own, without state, so the source is read
    and parsed once; they are never late and do not move the watermark."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in judged.schema.fields)
    passed = F.col(FAILED).isNull()
    spread = F.pmod(F.xxhash64("trade_id", "timestamp"), F.lit(_SPREAD)).cast("string")
    keyed = judged.withColumns({PASSED: passed, SERIES: F.when(passed, F.col("symbol")).otherwise(spread)})
    spent, folder = [PASSED, SERIES, EVENT_MICROS, EVENT_AT], _waiting_folder(judged, lateness)

    def judge(key, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if not key[0]:
            for batch in batches:
                yield batch.drop(columns=spent, errors="ignore")
            return
        for rows, verdicts in _turns(batches, state, folder):
            failures = [None if ok else "accuracy" for ok in verdicts]
            yield rows.drop(columns=spent, errors="ignore").assign(**{FAILED: failures})

    return _event_time(keyed, lateness, passed).groupBy(PASSED, SERIES).applyInPandasWithState(
        judge, kinds, _STATE, "append", _timeout(lateness)
    )


# --- counters and sinks ----------------------------------------------------------------


def observed(judged: DataFrame, name: str = "quality") -> DataFrame:
    """The gate's counters as observed metrics of every micro-batch."""
    failures = [F.count_if(F.col(FAILED) == d).alias(f"failed_{d}") for d in QUALITY_DIMENSIONS]
    return judged.observe(name, F.count(F.lit(1)).alias("all_records"), *failures)


_COUNTERS = ("all_records", *[f"failed_{d}" for d in QUALITY_DIMENSIONS])
_LOG = "observed_name string, input_rows long, late_rows long, " + ", ".join(f"{name} long" for name in _COUNTERS)


class CounterLog(StreamingQueryListener):
    """Keeps the counters of every micro-batch, and the rows the watermark dropped, in a Parquet table.

    Each batch has a folder of its own, so a replayed batch replaces its row.  Add it with ``spark.streams.addListener``
    before the query starts; it hears every query of the session and notes those that are ``observed`` under ``name``.
    """

    def __init__(self, spark: SparkSession, path: str, name: str = "quality"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        counted = progress.observedMetrics.get(self.name)
        if counted is None:
            return
        late = sum(operator.numRowsDroppedByWatermark for operator in progress.stateOperators)
        row = (self.name, progress.numInputRows, late, *[counted[name] for name in _COUNTERS])
        folder = f"{self.path}/query={progress.id}/batch={progress.batchId}"
        self.spark.createDataFrame([row], _LOG).coalesce(1).write.mode("overwrite").parquet(folder)

    def wait(self) -> None:
        """Returns once every event so far has been heard."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass


def start(
    stream: DataFrame,
    checkpoint: str,
    each_batch: Callable[[DataFrame, int], None],
    mode: str = "append",
    every: str | None = BATCH_EVERY,
) -> StreamingQuery:
    """T5: runs a stream into ``each_batch``; without ``every`` it takes what is
    there and stops."""
    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).foreachBatch(each_batch)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def to_files(stream: DataFrame, path: str, checkpoint: str, every: str | None = BATCH_EVERY) -> StreamingQuery:
    """Appends a stream to a Parquet folder, exactly once per batch."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .option("path", path)
        .trigger(**trigger)
        .start()
    )


def batch_name(batch: DataFrame, number: int) -> tuple[str, int]:
    """The streaming query that runs a micro-batch, by the id its checkpoint keeps, and the number of the batch."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if query is None:
        raise ValueError("only a streaming query's batches have a name")
    return query, number


def to_bronze(path: str) -> Callable[[DataFrame, int], None]:
    """Every micro-batch is in the lake table once, also when it is written again after a failure."""
    return lambda batch, number: sinks.write_bronze(batch, path, batch=batch_name(batch, number))


def to_candles(path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, _: sinks.upsert_candles(batch, path)


def to_latest(path: str) -> Callable[[DataFrame, int], None]:
    return lambda batch, _: sinks.publish_latest(batch, path)


def to_reports(path: str) -> Callable[[DataFrame, int], None]:
    """T6 as a table: the quality report of every micro-batch, one folder per batch,
    so a replayed batch replaces its own report."""

    def write(batch: DataFrame, number: int) -> None:
        quality_report(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    return write
