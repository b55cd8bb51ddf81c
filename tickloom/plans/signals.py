"""Queries over scores and signals: M1-M6, Q10."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.functions import checks
from tickloom.operators import indicators as I
from tickloom.operators import scoring as M
from tickloom.plans import views as V
from tickloom.plans.market import FEATURE_CTES
from tickloom.plans.registry import query, r
from tickloom.schemas import FEATURES, SELL_THRESHOLD


def _features(spark: SparkSession, folder: str) -> DataFrame:
    return I.feature_rows(V.hour_candles(spark, folder))


# Literals with an exponent are doubles in DuckDB; plain ones are decimals.
_STEP = """step AS (
  SELECT *, CAST(below_all_sma > 0.5 AS INT) AS below, CAST(volatility_14d > 0.02e0 AS INT) AS wild,
         CAST(macd_12_26 < 0 AND macd_5_35 < macd_signal_5_35 AS INT) AS falling FROM features)"""


def _weighted(sign: str, points: str, steps: int) -> str:
    lags = [f"lag({sign}, {back}) OVER s" if back else sign for back in range(steps - 1, -1, -1)]
    return " + ".join(f"{lag} * ({points} * {weight})" for weight, lag in enumerate(lags, start=1))


def _evidence(steps: int) -> str:
    parts = [_weighted("below", "0.3e0", steps), _weighted("wild", "0.2e0", steps), _weighted("falling", "0.2e0", steps)]
    total = f"(({parts[0]}) + ({parts[1]}) + ({parts[2]})) / 3e0"
    return f"least(0.99e0, greatest(0.01e0, {total}))"


_PROBABILITY = f"""{FEATURE_CTES}, {_STEP}, scored AS (
  SELECT *, CASE n WHEN 1 THEN {_evidence(1)} WHEN 2 THEN {_evidence(2)} ELSE {_evidence(3)} END AS probability
  FROM step WINDOW s AS (PARTITION BY symbol ORDER BY n))"""


def _decision(p: str) -> str:
    return f"""CASE WHEN {p} >= {SELL_THRESHOLD}e0 THEN 'SELL' ELSE 'HOLD' END AS prediction,
       CASE WHEN {p} < {SELL_THRESHOLD}e0 THEN 'NONE' WHEN {p} >= 0.95e0 THEN 'STRONG' WHEN {p} >= 0.90e0 THEN 'MODERATE' ELSE 'WEAK' END AS signal_strength"""


@query("M1_fallback_probability", f"{_PROBABILITY} SELECT symbol, open_time, {r('probability')} AS probability FROM scored")
def m1(spark: SparkSession, folder: str) -> DataFrame:
    return M.fallback_probability(_features(spark, folder)).select("symbol", "open_time", "probability")


@query(
    "M2_decision",
    f"{_PROBABILITY} SELECT symbol, open_time, {r('probability')} AS probability, {_decision('probability')} FROM scored",
)
def m2(spark: SparkSession, folder: str) -> DataFrame:
    decided = M.decide(M.fallback_probability(_features(spark, folder)))
    return decided.select("symbol", "open_time", "probability", "prediction", "signal_strength")


# Scores of the labelled documents, spread over 0..1 with many ties.
_SCORED = "scored AS (SELECT quality AS label, (doc_id * 37 % 101) / 100.0 AS score FROM labels)"


def _labelled(spark: SparkSession, folder: str) -> DataFrame:
    return V.table(spark, folder, "labels").select(
        F.col("quality").alias("label"), (F.pmod(F.col("doc_id") * 37, F.lit(101)) / 100).alias("score")
    )


@query(
    "M2_label_decisions",
    f"""WITH s AS (SELECT doc_id, CAST((doc_id * 37 % 101) / 100.0 AS DOUBLE) AS probability FROM labels)
SELECT doc_id, {r("probability")} AS probability, {_decision("probability")} FROM s""",
)
def m2_labels(spark: SparkSession, folder: str) -> DataFrame:
    rows = V.table(spark, folder, "labels").select(
        "doc_id", (F.pmod(F.col("doc_id") * 37, F.lit(101)) / 100).alias("probability")
    )
    return M.decide(rows).drop("threshold")


def linear_scorer(batch: pd.DataFrame) -> pd.Series:
    """Stand-in model: 0.6 for a last step below all averages, plus 0.05 per such step."""
    flag = FEATURES.index("below_all_sma")
    return batch["sequence"].map(lambda steps: 0.6 * steps[-1][flag] + 0.05 * sum(step[flag] for step in steps))


@query(
    "M3_model_scores",
    f"""{FEATURE_CTES}, ready AS (
  SELECT symbol, open_time, below_all_sma, sum(below_all_sma) OVER w AS below, count(sma_200) OVER w AS known
  FROM features WINDOW w AS (PARTITION BY symbol ORDER BY n ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT symbol, open_time, {r("0.6 * below_all_sma + 0.05 * below")} AS probability FROM ready WHERE known = 7""",
)
def m3(spark: SparkSession, folder: str) -> DataFrame:
    return M.score_with(M.model_sequences(_features(spark, folder)), linear_scorer)


@query(
    "M4_evaluation",
    f"""WITH {_SCORED}, counts AS (
  SELECT count(*) FILTER (WHERE score < 0.85 AND label = 0) AS tn, count(*) FILTER (WHERE score >= 0.85 AND label = 0) AS fp,
         count(*) FILTER (WHERE score < 0.85 AND label = 1) AS fn, count(*) FILTER (WHERE score >= 0.85 AND label = 1) AS tp FROM scored),
ratios AS (SELECT *, tp / nullif(tp + fp, 0) AS p, tp / nullif(tp + fn, 0) AS q, (2 * tp - fp) / nullif(tp + fp, 0) AS g FROM counts),
pairs AS (SELECT sum(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) / nullif(count(*), 0) AS auc
  FROM scored a, scored b WHERE a.label = 1 AND b.label = 0)
SELECT tn, fp, fn, tp, {r("p")} AS "precision", {r("q")} AS recall, {r("2 * p * q / nullif(p + q, 0)")} AS f1, {r("g")} AS profit_per_signal,
       {r("tp / nullif(tp + fp + fn, 0)")} AS efficiency, {r("tp / nullif(fp, 0)")} AS risk_reward_ratio,
       {r("g / (2 * sqrt(p * (1 - p)) + 1e-10)")} AS sharpe_approx, {r("0.85")} AS threshold, {r("auc")} AS auc FROM ratios, pairs""",
)
def m4(spark: SparkSession, folder: str) -> DataFrame:
    return M.evaluate(_labelled(spark, folder), 0.85)


@query(
    "M5_panel_signals",
    f"""{FEATURE_CTES} SELECT symbol, open_time, CASE WHEN below_all_sma = 1 THEN 'Bearish' ELSE 'Bullish' END AS trend_signal,
       CASE WHEN macd_5_35 > macd_signal_5_35 THEN 'Buy' ELSE 'Sell' END AS macd_signal,
       CASE WHEN price > bb_upper THEN 'Overbought' WHEN price < bb_lower THEN 'Oversold' ELSE 'Neutral' END AS band_position FROM features""",
)
def m5(spark: SparkSession, folder: str) -> DataFrame:
    panel = M.panel_signals(I.feature_rows(V.hour_candles(spark, folder)))
    return panel.select("symbol", "open_time", "trend_signal", "macd_signal", "band_position")


@query(
    "M6_predictions",
    f"""{FEATURE_CTES}, {_STEP}, scored AS (
  SELECT *, CASE WHEN count(sma_200) OVER w = 7 THEN {_evidence(3)} END AS p FROM step
  WINDOW s AS (PARTITION BY symbol ORDER BY n), w AS (PARTITION BY symbol ORDER BY n ROWS BETWEEN 6 PRECEDING AND CURRENT ROW))
SELECT symbol, open_time, {r("price")} AS price, {r("p")} AS probability,
       CASE WHEN p >= {SELL_THRESHOLD}e0 THEN 'SELL' WHEN p IS NOT NULL THEN 'HOLD' END AS prediction,
       CASE WHEN p < {SELL_THRESHOLD}e0 THEN 'NONE' WHEN p >= 0.95e0 THEN 'STRONG' WHEN p >= 0.90e0 THEN 'MODERATE' WHEN p IS NOT NULL THEN 'WEAK' END AS signal_strength,
       CAST(24 AS BIGINT) AS horizon,
       concat_ws(',', CASE WHEN n < 20 THEN 'sma_20' END, CASE WHEN n < 50 THEN 'sma_50' END, CASE WHEN n < 200 THEN 'sma_200' END,
                 CASE WHEN n < 20 THEN 'bb_middle,bb_upper' END) AS missing FROM scored""",
)
def m6(spark: SparkSession, folder: str) -> DataFrame:
    return M.predictions(_features(spark, folder)).withColumn("missing", F.array_join("missing", ","))


@query(
    "Q10_feature_validity",
    f"""{FEATURE_CTES} SELECT symbol, open_time, sma_200 IS NOT NULL AS is_valid FROM features""",
)
def q10(spark: SparkSession, folder: str) -> DataFrame:
    rows = I.feature_rows(V.hour_candles(spark, folder))
    return rows.select("symbol", "open_time", checks.valid_features(FEATURES).alias("is_valid"))
