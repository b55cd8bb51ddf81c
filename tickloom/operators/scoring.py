"""SELL/HOLD scoring, panel signals and model evaluation (M1-M6, Q10)."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickloom.functions import checks
from tickloom.operators.indicators import feature_sequences
from tickloom.operators.series import CANDLE_CHUNK, ROW, Blocks, numbered
from tickloom.schemas import FEATURES, SELL_THRESHOLD, SEQUENCE_LENGTH
from tickloom.sources.staging import stage

KEYS = ["symbol"]
ORDER = ["open_time"]


def step_signs() -> dict[str, Column]:
    """The three warning signs of a feature row, as 0 or 1."""
    falling = (F.col("macd_12_26") < 0) & (F.col("macd_5_35") < F.col("macd_signal_5_35"))
    signs = {
        "_below": F.col("below_all_sma") > 0.5,
        "_volatile": F.col("volatility_14d") > 0.02,
        "_falling": falling,
    }
    return {name: checks.sure(sign).cast("double") for name, sign in signs.items()}


# Points of a sign on the latest step.  Fixed values.
_POINTS = {"_below": 0.3, "_volatile": 0.2, "_falling": 0.2}


def _evidence(steps: dict[str, list[Column]]) -> Column:
    """Weighted points of up to three steps, oldest first, weights 1, 2, 3.

    Terms are added sign by sign from the oldest step, since results are compared
    with thresholds they can hit exactly.
    """
    trends = []
    for name, signs in steps.items():
        trend = F.lit(0.0)
        for weight, sign in enumerate(signs, start=1):
            trend = trend + sign * (_POINTS[name] * weight)
        trends.append(trend)
    return (trends[0] + trends[1] + trends[2]) / 3.0


def _bounded(probability: Column) -> Column:
    return F.least(F.lit(0.99), F.greatest(F.lit(0.01), probability))


def _last_steps(blocks: Blocks, n: int) -> dict[str, list[Column]]:
    """Signs of the last ``n`` rows, oldest first."""
    return {
        name: [F.lag(name, back).over(blocks.ordered()) if back else F.col(name) for back in range(n - 1, -1, -1)]
        for name in _POINTS
    }


def fallback_probability(
    features: DataFrame, keys=KEYS, order=ORDER, span: str = CANDLE_CHUNK, row: str | None = "data_points"
) -> DataFrame:
    """M1: probability from the last three rows, weights 1, 2, 3, between 0.01 and 0.99.

    With fewer than three rows the weights start at 1 on the oldest one.  ``row``
    is the row number that ``feature_rows`` leaves; None numbers the rows anew.
    """
    blocks = Blocks.cut(numbered(features, keys, order, span, row), keys, 2).add(step_signs())
    evidence = [_evidence(_last_steps(blocks, n)) for n in (1, 2, 3)]
    row = F.col(ROW)
    probability = F.when(row == 1, evidence[0]).when(row == 2, evidence[1]).otherwise(evidence[2])
    return blocks.add({"probability": _bounded(probability)}).rows().drop(ROW, *_POINTS)


def decide(scored: DataFrame, threshold: float = SELL_THRESHOLD) -> DataFrame:
    """M2: SELL or HOLD, and the strength of a SELL."""
    p = F.col("probability")
    sell = p >= threshold
    return scored.withColumns(
        {
            "prediction": F.when(sell, "SELL").otherwise("HOLD"),
            "signal_strength": F.when(~sell, "NONE")
            .when(p >= 0.95, "STRONG")
            .when(p >= 0.90, "MODERATE")
            .otherwise("WEAK"),
            "threshold": F.lit(threshold),
        }
    )


def score_with(
    sequences: DataFrame,
    scorer: Callable[[pd.DataFrame], pd.Series],
    names: list[str] = FEATURES,
    keep: tuple[str, ...] = ("symbol", "open_time"),
) -> DataFrame:
    """M3: probabilities from the caller's model.

    ``scorer`` gets one Arrow batch at a time, as a frame whose ``sequence``
    column holds a list of float32 steps, and returns one number per row.
    """
    steps = F.transform("sequence", lambda s: F.array(*[s[name].cast("float") for name in names]))
    given = sequences.select(*keep, steps.alias("sequence"))
    out = T.StructType([given.schema[name] for name in keep] + [T.StructField("probability", T.DoubleType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield batch[list(keep)].assign(probability=scorer(batch).astype("float64"))

    return given.mapInPandas(run, out)


def missing_features(names: list[str] = FEATURES) -> Column:
    """Names of the features that are absent."""
    return F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]))


def predictions(
    features: DataFrame, n: int = SEQUENCE_LENGTH, horizon: int = 24, keys=KEYS, order=ORDER, span=CANDLE_CHUNK,
    row: str | None = "data_points",
) -> DataFrame:
    """M6: a prediction for every feature row that completes a valid sequence.

    Rows with missing or invalid features are kept, with their missing names and
    a null prediction.
    """
    blocks = Blocks.cut(numbered(features, keys, order, span, row), keys, max(n - 1, 2))
    blocks = blocks.add({"_ok": checks.valid_features(FEATURES), **step_signs()})
    recent = blocks.frame(1 - n, 0)
    full = (F.count("*").over(recent) == n) & F.min("_ok").over(recent)
    probability = F.when(full, _bounded(_evidence(_last_steps(blocks, 3))))
    rows = blocks.add({"probability": probability, "missing": missing_features()}).rows()
    decided = decide(rows)
    known = F.col("probability").isNotNull()
    return decided.select(
        *keys, *order, "price", "probability",
        F.when(known, F.col("prediction")).alias("prediction"),
        F.when(known, F.col("signal_strength")).alias("signal_strength"),
        F.lit(horizon).alias("horizon"), "missing",
    )


def panel_signals(features: DataFrame) -> DataFrame:
    """M5: trend, MACD and band signals; a missing band counts as neutral."""
    price = F.col("price")
    return features.withColumns(
        {
            "trend_signal": F.when(F.col("below_all_sma") == 1, "Bearish").otherwise("Bullish"),
            "macd_signal": F.when(F.col("macd_5_35") > F.col("macd_signal_5_35"), "Buy").otherwise("Sell"),
            "band_position": F.when(price > F.col("bb_upper"), "Overbought")
            .when(price < F.col("bb_lower"), "Oversold")
            .otherwise("Neutral"),
        }
    )


# --- evaluation ----------------------------------------------------------------------


def _ranked_levels(scored: DataFrame, label: str, score: str) -> DataFrame:
    """Distinct scores with their positives, negatives and the negatives below.

    Scores are counted first, then dealt into sorted ranges of about as many distinct
    scores each, however close they lie, and cumulated inside the ranges; only the
    range totals, one row for each partition, meet in one task.  The ranges are
    staged, so all that reads them sees the same.  Rows without a score are left out.
    """
    positive, known = F.count_if(F.col(label) == 1), F.count_if(F.col(label) != 1)
    levels = scored.where(F.col(score).isNotNull()).groupBy(F.col(score).alias("_score")).agg(
        positive.alias("_pos"), (F.count(F.lit(1)) - positive).alias("_neg"), known.alias("_good")
    )
    levels = stage(levels.repartitionByRange("_score").withColumn("_range", F.spark_partition_id()), "score-ranges")
    totals = levels.groupBy("_range").agg(F.sum("_neg").alias("_range_neg"))
    # One row per range: the number of partitions bounds this window, not the data.
    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    lower = totals.select("_range", F.coalesce(F.sum("_range_neg").over(earlier), F.lit(0)).alias("_lower"))
    inside = Window.partitionBy("_range").orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("_neg").over(inside), F.lit(0))
    return levels.withColumn("_below", below).join(lower, "_range")


def _area() -> Column:
    wins = F.sum(F.col("_pos") * (F.col("_lower") + F.col("_below") + F.col("_neg") / 2.0))
    pairs = F.sum("_pos").cast("double") * F.sum("_neg")
    return (wins / F.nullif(pairs, F.lit(0.0))).alias("auc")


def area_under_curve(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """AUC by the rank sum, ties counted half; one row, null when a class is absent."""
    return _ranked_levels(scored, label, score).agg(_area())


# Keeps the ratio finite at a precision of 1.  Fixed value.
_TINY = 1e-10


def evaluate(
    scored: DataFrame, threshold: float = SELL_THRESHOLD, label: str = "label", score: str = "score"
) -> DataFrame:
    """M4: confusion counts, precision, recall, F1, AUC and the trading metrics."""
    sell = F.col("_score") >= threshold

    def number(column: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(column))), F.lit(0).cast("long"))

    counts = _ranked_levels(scored, label, score).agg(
        number("_good", ~sell).alias("tn"),
        number("_good", sell).alias("fp"),
        number("_pos", ~sell).alias("fn"),
        number("_pos", sell).alias("tp"),
        _area(),
    )
    tp, fp, fn = F.col("tp").cast("double"), F.col("fp").cast("double"), F.col("fn").cast("double")

    def over(part: Column, whole: Column) -> Column:
        return part / F.nullif(whole, F.lit(0.0))

    precision, recall = over(tp, tp + fp), over(tp, tp + fn)
    report = counts.withColumns(
        {
            "precision": precision,
            "recall": recall,
            "f1": over(2 * precision * recall, precision + recall),
            "profit_per_signal": over(2 * tp - fp, tp + fp),
            "efficiency": over(tp, tp + fp + fn),
            "risk_reward_ratio": over(tp, fp),
        }
    )
    p = F.col("precision")
    report = report.withColumns(
        {
            "sharpe_approx": F.col("profit_per_signal") / (2 * F.sqrt(p * (1 - p)) + _TINY),
            "threshold": F.lit(threshold),
        }
    )
    return report.select(*[c for c in report.columns if c != "auc"], "auc")


def model_sequences(
    features: DataFrame, n: int = SEQUENCE_LENGTH, keys=KEYS, order=ORDER, row: str | None = "data_points"
) -> DataFrame:
    """Sequences ready for ``score_with``: every step is valid (Q10)."""
    sequences = feature_sequences(features, FEATURES, n, checks.valid_features(FEATURES), keys, order, row=row)
    return sequences.filter(checks.valid_model_symbol())
