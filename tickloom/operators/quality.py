"""The five-dimension quality gate and its report (Q5-Q7), order requests (Q8)."""

from __future__ import annotations

from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import checks
from tickloom.operators.candles import id_order
from tickloom.operators.series import BLOCK, BLOCK_ROWS, LEAD, ROW, TICK_CHUNK, Blocks, index_rows
from tickloom.operators.stacking import stack
from tickloom.schemas import (
    ACCURACY_MIN_HISTORY, ACCURACY_WINDOW, DEFAULT_EXCHANGE, MAX_DEVIATION, MAX_ORDER_QUANTITY,
    ORDER_SYMBOL_PATTERN, PRICED_TYPES, QUALITY_DIMENSIONS, REQUEST_EXCHANGES, REQUEST_TYPES, TRADE_SIDES,
    REQUEST_MESSAGES as TEXT, UUID_PATTERN,
)
from tickloom.sources.staging import stage

FAILED = "failed_dimension"


def row_failure(as_of: Column, complete: Column | None = None) -> Column:
    """Q6 for the four dimensions that look at one row: the first that fails."""
    passed = {
        "completeness": checks.complete() if complete is None else complete,
        "validity": checks.valid(),
        "consistency": checks.consistent(),
        "timeliness": checks.timely(as_of),
    }
    return F.coalesce(*[F.when(~ok, F.lit(name)) for name, ok in passed.items()])


def _measured(trades: DataFrame, keys: list[str], order: list[str], span: str) -> DataFrame:
    blocks = Blocks.cut(index_rows(trades, keys, order, span), keys, ACCURACY_WINDOW)
    before = blocks.frame(-ACCURACY_WINDOW, -1)
    blocks = blocks.add({"recent_mean": F.avg("price").over(before)})
    mean = F.col("recent_mean")
    enough = (F.col(ROW) > ACCURACY_MIN_HISTORY) & (mean > 0)
    return blocks.add({"deviation": F.when(enough, F.abs(F.col("price") - mean) / mean)}).rows()


def with_deviation(
    trades: DataFrame, keys=("symbol",), order=("timestamp", "trade_id"), span: str = TICK_CHUNK
) -> DataFrame:
    """Q5: mean of the up to 100 trades before, and the relative distance from it.

    Every trade given counts as accepted.  ``deviation`` is null with fewer than
    ten trades before or a mean that is not positive.
    """
    return _measured(trades, list(keys), list(order), span).drop(ROW)


# --- accuracy against accepted prices ---------------------------------------------------------


def judge_prices(recent: deque, prices) -> list[bool]:
    """Accepts or rejects prices in order; only accepted ones enter the history."""
    verdicts = []
    total = sum(recent)
    for price in prices:
        ok = True
        if len(recent) >= ACCURACY_MIN_HISTORY:
            mean = total / len(recent)
            ok = not (mean > 0 and abs(price - mean) / mean > MAX_DEVIATION)
        if ok:
            if len(recent) == recent.maxlen:
                recent.popleft()
            recent.append(price)
            # Summed anew: at most a hundred terms, and no drift over a long stream.
            total = sum(recent)
        verdicts.append(ok)
    return verdicts


#: Rounds in which blocks are judged side by side.  Only a series whose blocks keep waiting for each other longer is judged
#: in order from there on.
ROUNDS = 12


def _judged_block(rows: pd.DataFrame, recent: deque) -> dict:
    """Rejected rows of a block, the accepted prices at its end, and whether those are simply its last ones."""
    given = list(recent)
    verdicts = judge_prices(recent, rows["price"])
    rejected = [int(r) for r, ok in zip(rows[ROW], verdicts) if not ok]
    return {"start": given, "rejected": rejected, "end": list(recent), "clean": len(verdicts) >= ACCURACY_WINDOW and all(verdicts[-ACCURACY_WINDOW:])}


def _open_blocks(judged: DataFrame, every: DataFrame, keys: list[str]) -> DataFrame:
    """Blocks whose start is not what the block before them ended with, and the start to judge them from.

    A block not judged from given prices started from the rows before it, which is right after a clean block.  The first
    open block of a series gets its true start, so each round settles one block at least.
    """
    names = [*keys, BLOCK]
    ends = judged.select(
        *keys, (F.col(BLOCK) + 1).alias(BLOCK), F.col("end").alias("_start"), F.col("clean").alias("_after_clean"),
        (F.col("_given") & (F.col("start") == F.col("end"))).alias("_handed_on"),
    )
    known = judged.select(*names, "start", "_given")
    pairs = every.join(ends, names, "left").join(known, names, "left")
    fits = F.when(F.col("_given"), F.col("start") == F.col("_start")).otherwise(F.col("_after_clean"))
    pairs = pairs.withColumn("_open", F.col("_start").isNotNull() & ~fits)
    # One row a block: what the last open block after an all-rejecting one hands on to all blocks after it.
    before = Window.partitionBy(*keys).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, 0)
    handed = F.last(F.when(F.col("_open") & F.col("_handed_on"), F.col("_start")), ignorenulls=True).over(before)
    tried = pairs.withColumn("_handed", handed).withColumn("_from", F.coalesce("_handed", F.when(F.col("_open"), F.col("_start"))))
    same = F.coalesce(F.col("_given") & (F.col("start") == F.col("_from")), F.lit(False))
    return tried.where(F.col("_from").isNotNull() & ~same).select(*names, F.col("_from").alias("start"))


def with_accepted(
    trades: DataFrame, keys=("symbol",), order=("timestamp", "trade_id"), span: str = TICK_CHUNK, size: int = BLOCK_ROWS
) -> DataFrame:
    """Q5 by the rule: ``accepted`` is false where the price is too far from the mean of the last 100 accepted prices.

    As long as nothing is rejected these are the last 100 trades, so ``with_deviation`` says which blocks of a series
    hold a rejection at all; the others are accepted whole.  Blocks with one are judged side by side, first as if the 100
    trades before had been accepted.  In each further round those blocks are judged again whose start is not what the
    block before ended with; most end as they did before, so the next block need not be judged again, and when all starts
    fit the ends before them the verdicts are those of one pass in order.  After a block that rejects everything, as a
    lasting step of the level makes them, all later blocks are tried from the same start at once.  A row without a price
    is accepted and counts in no mean.
    """
    keys, order, size = list(keys), list(order), max(size, ACCURACY_WINDOW)
    own_block = F.floor((F.col(ROW) - 1) / F.lit(size)).cast("long")
    known = _measured(trades.where("price is not null"), keys, order, span).withColumn(BLOCK, own_block)
    measured = stage(known, "measured")
    priced = measured.select(*keys, ROW, BLOCK, "price")
    kinds = {f.name: f.dataType for f in measured.schema.fields}
    schema = T.StructType([T.StructField(k, kinds[k]) for k in keys] + [
        T.StructField(BLOCK, T.LongType()), T.StructField("start", T.ArrayType(T.DoubleType())), T.StructField("rejected", T.ArrayType(T.LongType())),
        T.StructField("end", T.ArrayType(T.DoubleType())), T.StructField("clean", T.BooleanType())])

    def judge(rows: pd.DataFrame) -> pd.DataFrame:
        """One block after up to 100 rows before it, or after given prices."""
        rows = rows.sort_values(ROW)
        before, own = rows[rows[LEAD]], rows[~rows[LEAD]]
        given = own["start"].iloc[0]
        recent = deque(before["price"] if given is None else given, maxlen=ACCURACY_WINDOW)
        return pd.DataFrame([{**{k: own[k].iloc[0] for k in keys}, BLOCK: own[BLOCK].iloc[0], **_judged_block(own, recent)}])

    def judge_on(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole blocks in order, each from the prices the one before left."""
        series, recent, block = None, None, None
        for batch in batches:
            parts = batch if block is None else pd.concat([block, batch])
            groups = [g for _, g in parts.groupby([*keys, BLOCK], sort=False, dropna=False)]
            block = groups.pop() if groups else None  # its last rows may be in the next batch
            out = []
            for rows in groups:
                series, recent = start(rows, series, recent)
                out.append({**{k: rows[k].iloc[0] for k in keys}, BLOCK: rows[BLOCK].iloc[0], **_judged_block(rows, recent)})
            yield pd.DataFrame(out, columns=schema.names)
        if block is not None:
            series, recent = start(block, series, recent)
            yield pd.DataFrame([{**{k: block[k].iloc[0] for k in keys}, BLOCK: block[BLOCK].iloc[0], **_judged_block(block, recent)}])

    def start(rows: pd.DataFrame, series, recent):
        own = tuple(rows[k].iloc[0] for k in keys)
        return (own, recent) if own == series else (own, deque(rows["start"].iloc[0], maxlen=ACCURACY_WINDOW))

    def with_context(todo: DataFrame) -> DataFrame:
        """Rows of the blocks in ``todo`` (keys, block, start) and the up to 100 rows before each."""
        place = F.pmod(F.col(ROW) - 1, F.lit(size))
        homes = F.when(place >= size - ACCURACY_WINDOW, F.array(F.col(BLOCK), F.col(BLOCK) + 1)).otherwise(F.array(BLOCK))
        spread = priced.withColumn("_own", F.col(BLOCK)).withColumn(BLOCK, F.explode(homes))
        return spread.withColumn(LEAD, F.col("_own") != F.col(BLOCK)).drop("_own").join(todo, [*keys, BLOCK])

    names = [*keys, BLOCK]
    first = measured.where(F.col("deviation") > MAX_DEVIATION).select(*names).distinct()
    todo = stage(first.withColumn("start", F.lit(None).cast("array<double>")), "blocks")
    every = stage(priced.select(*names).distinct(), "all-blocks")
    judged, rounds = None, []
    for turn in range(ROUNDS + 1):
        if not todo.take(1):
            break
        if turn < ROUNDS:
            new = with_context(todo).groupBy(*names).applyInPandas(judge, schema)
        else:
            opened = todo.groupBy(*keys).agg(F.min_by("start", BLOCK).alias("start"), F.min(BLOCK).alias("_from"))
            rest = priced.join(opened, keys).where(F.col(BLOCK) >= F.col("_from")).drop("_from")
            new = rest.repartition(*keys).sortWithinPartitions(*keys, ROW).mapInPandas(judge_on, schema)
        rounds.append(stage(new.withColumns({"_turn": F.lit(turn), "_given": F.lit(turn > 0)}), "judged-blocks"))
        parts = ["start", "rejected", "end", "clean", "_turn", "_given"]
        last = F.max_by(F.struct(*parts), "_turn").alias("_last")
        judged = rounds[0] if turn == 0 else stack(*rounds).groupBy(*names).agg(last).select(*names, "_last.*")
        todo = stage(_open_blocks(judged, every, keys), "blocks")
    out = measured.withColumn("accepted", F.lit(True))
    if judged is not None:
        rejected = judged.select(*keys, F.explode("rejected").alias(ROW)).withColumn("_rejected", F.lit(True))
        joined = measured.join(rejected, [*keys, ROW], "left")
        out = joined.withColumn("accepted", F.col("_rejected").isNull()).drop("_rejected")
    unpriced = trades.where("price is null").withColumns(
        {"recent_mean": F.lit(None).cast("double"), "deviation": F.lit(None).cast("double"), "accepted": F.lit(True)}
    )
    return stack(out.select(*unpriced.columns), unpriced)


def gate(trades: DataFrame, as_of: Column, complete: Column | None = None, span: str = TICK_CHUNK) -> DataFrame:
    """Q6: every trade with its first failed dimension, null when it is accepted.

    Only trades that pass the other four dimensions make up the series accuracy
    looks at, and only accepted ones its means.  The judgement by the row is
    stored first, so the trades are parsed once and the failed ones are not
    sorted.
    """
    stored = stage(trades.withColumn(FAILED, row_failure(as_of, complete)), "judged")
    passed = stored.filter(F.col(FAILED).isNull())
    placed = passed.withColumn("_at", F.coalesce(F.col("timestamp").cast("timestamp"), F.timestamp_micros(F.lit(0))))
    # Trades of one instant in the order of their ids, as candles have them.
    placed = placed.withColumn("_turn", id_order("trade_id"))
    measured = with_accepted(placed, ("symbol",), ("_at", "_turn"), span)
    accuracy = F.when(~F.col("accepted"), F.lit("accuracy"))
    priced = measured.withColumn(FAILED, accuracy).select(*stored.columns)
    return stack(stored.filter(F.col(FAILED).isNotNull()), priced)


def accepted(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(FAILED).isNull()).drop(FAILED)


def rejected(judged: DataFrame) -> DataFrame:
    return judged.filter(F.col(FAILED).isNotNull())


def quality_report(judged: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """Q7: totals, failures per dimension, scores and failure rate.

    ``score`` is the accepted share of all records.  ``score_ref`` and
    ``failure_rate_ref`` divide by the accepted records only, as the platform's
    report does, so the score can fall below zero.
    """
    counts = judged.groupBy(*by).agg(
        F.count(F.lit(1)).alias("all_records"),
        F.count_if(F.col(FAILED).isNull()).alias("accepted_records"),
        *[F.count_if(F.col(FAILED) == name).alias(f"failed_{name}") for name in QUALITY_DIMENSIONS],
    )
    failures = F.col("all_records") - F.col("accepted_records")
    good = F.col("accepted_records")

    def percent(part: Column, whole: Column) -> Column:
        return F.round(part / whole * 100, 2)

    return counts.withColumns(
        {
            "score": F.when(F.col("all_records") == 0, 100.0).otherwise(
                percent(good, F.nullif("all_records", F.lit(0)))
            ),
            "score_ref": F.when(good == 0, 100.0).otherwise(percent(good - failures, F.nullif(good, F.lit(0)))),
            "failure_rate_ref": percent(failures, F.greatest(good, F.lit(1))),
        }
    )


def check_order_requests(requests: DataFrame) -> DataFrame:
    """Q8: all errors of every order request, the default exchange filled in.

    Unknown columns are dropped.  ``errors`` is an array of (field, message);
    empty when the request is valid.
    """
    quantity, price = checks.number("quantity"), checks.number("price")
    priced = F.coalesce(F.col("type").isin(PRICED_TYPES), F.lit(False))
    sure = checks.sure

    def error(field: str, bad: Column, message: str) -> Column:
        return F.when(bad, F.struct(F.lit(field).alias("field"), F.lit(message).alias("message")))

    def missing(field: str) -> Column:
        return F.col(field).isNull()

    rules = [
        error("portfolio_id", missing("portfolio_id"), TEXT["portfolio_id required"]),
        error(
            "portfolio_id", sure(~F.col("portfolio_id").rlike(UUID_PATTERN)), TEXT["portfolio_id format"]
        ),
        error("symbol", missing("symbol"), TEXT["symbol required"]),
        error(
            "symbol",
            sure(~F.col("symbol").rlike(ORDER_SYMBOL_PATTERN)),
            TEXT["symbol format"],
        ),
        error("type", missing("type"), "type is required"),
        error("type", sure(~F.col("type").isin(REQUEST_TYPES)), TEXT["type allowed"]),
        error("side", missing("side"), "side is required"),
        error("side", sure(~F.col("side").isin(TRADE_SIDES)), TEXT["side allowed"]),
        error("quantity", missing("quantity"), TEXT["quantity required"]),
        error("quantity", F.col("quantity").isNotNull() & quantity.isNull(), "quantity must be a number"),
        error("quantity", sure(quantity <= 0), TEXT["quantity positive"]),
        error("quantity", sure(quantity > MAX_ORDER_QUANTITY), TEXT["quantity maximum"]),
        error("price", missing("price") & priced, TEXT["price required"]),
        error("price", F.col("price").isNotNull() & price.isNull(), "price must be a number"),
        error("price", sure(price <= 0), TEXT["price positive"]),
        error(
            "exchange_code",
            sure(~F.col("exchange_code").isin(REQUEST_EXCHANGES)),
            "exchange_code must be one of: " + ", ".join(REQUEST_EXCHANGES),
        ),
    ]
    known = ["portfolio_id", "symbol", "type", "side", "quantity", "price", "exchange_code"]
    carried = [c for c in ("request_id",) if c in requests.columns]
    checked = requests.select(*carried, *known, F.array_compact(F.array(*rules)).alias("errors"))
    return checked.withColumns(
        {
            "exchange_code": F.coalesce("exchange_code", F.lit(DEFAULT_EXCHANGE)),
            "is_valid": F.size("errors") == 0,
        }
    )
