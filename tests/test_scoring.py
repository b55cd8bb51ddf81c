import itertools

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import at, closes, walk, CANDLE_DDL
from tickloom.functions import checks
from tickloom.operators import indicators as I
from tickloom.operators import scoring as M
from tickloom.schemas import FEATURES, SELL_THRESHOLD

SIGN_DDL = "symbol string, open_time timestamp, below_all_sma int, volatility_14d double, macd_12_26 double, macd_5_35 double, macd_signal_5_35 double"


def sign_rows(symbol, signs):
    return [(symbol, at(3600 * i), b, 0.03 if v else 0.02, -1.0 if f else 0.0, 0.0, 1.0) for i, (b, v, f) in enumerate(signs)]


WEIGHTS = np.array([0.3, 0.2, 0.2])


def weighted(signs):
    """Flags of the last three rows, oldest first, weighed by kind and by place."""
    last = np.array(signs[-3:], dtype=float)
    return float(np.clip(np.arange(1, len(last) + 1) @ last @ WEIGHTS / 3.0, 0.01, 0.99))


@pytest.mark.parametrize(
    "signs,probability",
    [
        ([(0, 0, 0)], 0.01),
        ([(1, 1, 1)], 0.7 / 3),
        ([(1, 0, 0), (0, 1, 0), (0, 0, 1)], (0.3 + 0.4 + 0.6) / 3),
        ([(1, 1, 1)] * 3, 0.99),
        ([(1, 1, 1), (0, 0, 0), (0, 0, 0), (0, 0, 0)], 0.01),
    ],
)
def test_probabilities_worked_by_hand(spark, signs, probability):
    rows = M.fallback_probability(spark.createDataFrame(sign_rows("X", signs), SIGN_DDL), row=None).collect()
    assert max(rows, key=lambda r: r.open_time).probability == pytest.approx(probability, rel=1e-12)


def test_probability_of_every_row(spark):
    signs = list(itertools.product((0, 1), repeat=3))
    orders = {f"S{i}": [signs[(i * 5 + j * (i + 1)) % 8] for j in range(40)] for i in range(8)}
    rows = [row for s, steps in orders.items() for row in sign_rows(s, steps)]
    out = M.fallback_probability(spark.createDataFrame(rows, SIGN_DDL), row=None).collect()
    assert len(out) == 320
    for row in out:
        i = round((row.open_time - at(0)).total_seconds() / 3600)
        assert row.probability == pytest.approx(weighted(orders[row.symbol][: i + 1]), rel=1e-12)


@pytest.mark.parametrize(
    "p,expected",
    [
        (SELL_THRESHOLD, ("SELL", "WEAK")),
        (SELL_THRESHOLD - 1e-12, ("HOLD", "NONE")),
        (0.90, ("SELL", "MODERATE")),
        (0.95, ("SELL", "STRONG")),
        (0.9499999, ("SELL", "MODERATE")),
        (0.01, ("HOLD", "NONE")),
    ],
)
def test_decisions(spark, p, expected):
    row = M.decide(spark.createDataFrame([(p,)], "probability double")).first()
    assert (row.prediction, row.signal_strength) == expected


def test_published_evaluation(spark):
    """The confusion matrix of the published model gives its published metrics."""
    tn, fp, fn, tp = 1199, 38, 105, 799
    rows = [(0, 0.1)] * tn + [(0, 0.9)] * fp + [(1, 0.2)] * fn + [(1, 0.95)] * tp
    got = M.evaluate(spark.createDataFrame(rows, "label int, score double")).first()
    assert (got.tn, got.fp, got.fn, got.tp) == (tn, fp, fn, tp)
    expected = {
        "precision": 0.954599761051374, "recall": 0.8838495575221239, "f1": 0.9178632969557725,
        "profit_per_signal": 1.863799283154122, "efficiency": 0.8481953290870489,
        "risk_reward_ratio": 21.026315789473685, "sharpe_approx": 4.476405437644828,
    }
    for name, value in expected.items():
        assert got[name] == pytest.approx(value, rel=1e-12)


@pytest.mark.parametrize("levels", [3, 50, 10_000])
def test_area_under_curve(spark, levels):
    rng = np.random.default_rng(levels)
    label, score = rng.integers(0, 2, 800), rng.integers(0, levels, 800) / levels
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    rows = spark.createDataFrame(pd.DataFrame({"label": label, "score": score}))
    assert M.area_under_curve(rows).first().auc == pytest.approx(wins / (len(pos) * len(neg)), rel=1e-12)
    assert M.area_under_curve(rows.filter("label = 1")).first().auc is None


def test_close_scores_spread_over_all_ranges(spark):
    """Scores within a thousandth, some outside 0 to 1, some missing: ranges of like size, and the plain rank sum."""
    rng = np.random.default_rng(4)
    label = rng.integers(0, 2, 2000)
    score = np.where(rng.random(2000) < 0.99, 0.5 + rng.integers(0, 1500, 2000) / 2e6, rng.uniform(-3, 3, 2000))
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    rows = [(int(a), float(b)) for a, b in zip(label, score)] + [(1, None), (0, None)]
    frame = spark.createDataFrame(rows, "label int, score double").repartition(3)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "false")
    try:
        levels = M._ranked_levels(frame, "label", "score")
        sizes = [r["count"] for r in levels.groupBy("_range").count().collect()]
        assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)
        report = M.evaluate(frame, 0.5)
        got = report.first()
        assert "NestedLoop" not in report._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert got.auc == pytest.approx(wins / (len(pos) * len(neg)), rel=1e-12)
    assert (got.tp, got.fp) == ((pos >= 0.5).sum(), (neg >= 0.5).sum()) and got.tp + got.fn + got.tn + got.fp == 2000


@pytest.fixture(scope="module")
def features(spark):
    return I.feature_rows(spark.createDataFrame(closes({"A": walk(230, 3), "B": walk(205, 4)}), CANDLE_DDL))


def test_feature_validity(features):
    rows = features.withColumn("ok", checks.valid_features(FEATURES))
    assert rows.filter("ok").count() == 31 + 6
    bad = features.filter("data_points >= 200").withColumn("high", F.lit(float("inf")))
    assert bad.filter(checks.valid_features(FEATURES)).count() == 0


def test_predictions_keep_incomplete_rows(features):
    out = M.predictions(features)
    assert out.count() == 435
    # A sequence of seven valid steps ends at row 206 at the earliest.
    assert out.filter("probability IS NOT NULL").count() == 25
    early = out.filter("symbol = 'B' AND probability IS NULL AND array_contains(missing, 'sma_200')")
    assert early.count() == 199


def test_model_scores_by_batch(features):
    out = M.score_with(M.model_sequences(features), lambda batch: batch["sequence"].map(lambda steps: float(len(steps)) / 10))
    rows = out.collect()
    assert len(rows) == 25 and {r.probability for r in rows} == {0.7}


def test_panel(spark):
    ddl = "price double, bb_upper double, bb_lower double, below_all_sma int, macd_5_35 double, macd_signal_5_35 double"
    rows = spark.createDataFrame([(10.0, 9.0, 1.0, 1, 2.0, 1.0), (0.5, 9.0, 1.0, 0, 1.0, 1.0), (5.0, None, None, 0, 0.0, 1.0)], ddl)
    got = [(r.trend_signal, r.macd_signal, r.band_position) for r in M.panel_signals(rows).collect()]
    assert got == [("Bearish", "Buy", "Overbought"), ("Bullish", "Sell", "Oversold"), ("Bullish", "Sell", "Neutral")]
