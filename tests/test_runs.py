"""Groups of more trades than a task holds: judged through sorted runs, with the verdicts of one pass."""

from __future__ import annotations

import random
from datetime import timedelta
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import at, trade
from test_streaming import drained, gate_loop, shuffled_batches, stream_of
from tickloom.operators.candles import id_turn
from tickloom.streaming import jobs as J, runs as R


class State:
    """What a task sees of a group's state."""

    def __init__(self, value=None, mark=0):
        self.exists, self.get, self.mark, self.timeout = value is not None, value, mark, None

    def getCurrentWatermarkMs(self):
        return self.mark

    def update(self, value):
        self.get = value

    def setTimeoutTimestamp(self, at):
        self.timeout = at


@pytest.fixture
def small(monkeypatch):
    monkeypatch.setattr(J, "HELD_ROWS", 50)
    monkeypatch.setattr(R, "RUN_ROWS", 128)
    monkeypatch.setattr(R, "BATCH_ROWS", 8)
    monkeypatch.setattr(R, "SHORT_RUNS", 3)


def made(n, seed):
    rng = np.random.default_rng(seed)
    micros = rng.integers(0, n // 3, n) * 1000  # many at one instant
    ids = [None if i % 97 == 0 else str(i) if i % 5 else f"x{i}" for i in range(n)]
    prices = 100 * rng.choice([1, 1, 1, 1, 0.4, 1.6, 3], n) * rng.uniform(0.95, 1.05, n)
    return pd.DataFrame({"trade_id": ids, "price": prices, J.EVENT_MICROS: micros, "row": np.arange(n)})


def in_order(rows):
    return sorted(rows.to_dict("records"), key=lambda r: (r[J.EVENT_MICROS], id_turn(r["trade_id"]), r["row"]))


def test_a_large_group_is_never_held_whole(small, monkeypatch):
    """Two thousand trades; before, all of them were one frame."""
    rows = made(2000, 1)
    held, state = [], State()
    monkeypatch.setattr(R, "_sorted", lambda tables, at, made=R._sorted: held.append(sum(t.num_rows for t in tables)) or made(tables, at))
    parts = list(J._turns(iter([rows[i : i + 30] for i in range(0, 2000, 30)]), state))
    assert max(len(p) for p, _ in parts) < 400 and max(held) < 400
    got = pd.concat([p.assign(accepted=v) for p, v in parts])
    expected = in_order(rows[rows["trade_id"].notna()])
    assert got[got["trade_id"].notna()]["row"].tolist() == [r["row"] for r in expected]
    every = in_order(rows)
    assert got[J.EVENT_MICROS].tolist() == [r[J.EVENT_MICROS] for r in every] and len(got) == 2000
    assert got["accepted"].tolist() == gate_loop(got["price"].tolist()) and not got["accepted"].all()
    assert state.get[1] is None and len(state.get[0]) == 100


def test_waiting_trades_stay_in_runs(small, tmp_path):
    """Each micro-batch frees the trades that the watermark has reached; runs are merged and their files go in the end."""
    rows = made(1500, 2)
    rows = rows[rows["trade_id"].notna()].sort_values(J.EVENT_MICROS, kind="stable").reset_index(drop=True)
    folder, state, got = str(tmp_path / "waiting"), State(), []
    batches = [rows[i : i + 100].sample(frac=1, random_state=i) for i in range(0, len(rows), 100)]
    late = [int(b[J.EVENT_MICROS].min()) // 1000 - 120 for b in batches]
    for batch, mark in zip([*batches, rows[:0], rows[:0]], [*late, 499, 600]):
        state = State(state.get, max(mark, 0))
        for part, verdicts in J._turns(iter([batch[i : i + 30] for i in range(0, len(batch), 30)]), state, folder):
            assert (part[J.EVENT_MICROS] <= state.mark * 1000).all()
            got.append(part.assign(accepted=verdicts))
        runs = R.unpacked_runs(state.get[1])
        if runs is not None:
            open_runs = [r for r in runs if r.done < r.rows]
            assert len(open_runs) <= 12
            assert (state.timeout is None) == (not open_runs)
    got = pd.concat(got)
    assert got["row"].tolist() == [r["row"] for r in in_order(rows)]
    assert got["accepted"].tolist() == gate_loop(got["price"].tolist())
    list(J._turns(iter([rows[:0]]), State(state.get, 700), folder))
    assert not list((tmp_path / "waiting").glob("*"))


@pytest.mark.parametrize("waits", [False, True])
def test_streams_through_runs(spark, tmp_path, monkeypatch, waits):
    """The verdicts of one pass in order, with Spark's own state; only part of the groups is large."""
    rng = random.Random(6)
    sizes = {"BTCUSDT": 900, "ETHUSDT": 60}
    prices = {s: [100 * rng.choice([1, 1, 1, 1, 0.4, 1.6, 3]) * rng.uniform(0.95, 1.05) for _ in range(n)] for s, n in sizes.items()}
    rows = [trade(s, 3 * (i // 2), p, trade_id=str(i)) for s in prices for i, p in enumerate(prices[s])]
    batches = shuffled_batches(rows, 4, 300, rng) if waits else [rng.sample(rows, len(rows))]
    turns, seen = J._turns, []

    def small(*arguments):
        """Runs in the Python workers, with the limits pickled along and those of the module that they import."""
        from tickloom.streaming import runs

        runs.RUN_ROWS, runs.BATCH_ROWS = 128, 8
        return turns(*arguments)

    monkeypatch.setattr(J, "HELD_ROWS", 50)
    stream = stream_of(spark, str(tmp_path / "in"), batches)
    folder = J._waiting_folder
    monkeypatch.setattr(J, "_waiting_folder", lambda *a: seen.append(folder(*a)) or seen[-1])
    monkeypatch.setattr(J, "_turns", small)
    out, _ = drained(spark, J.accuracy_stream(stream, "5 minutes" if waits else None), str(tmp_path))
    closed = max(r[1] for r in rows) - (timedelta(minutes=5) if waits else timedelta())
    got = {(r.symbol, int(r.trade_id)): r.accepted for r in out.collect()}
    expected = {(s, i): ok for s in prices for i, ok in enumerate(gate_loop(prices[s])) if at(3 * (i // 2)) <= closed}
    assert got == expected and len(set(got.values())) == 2 and len(got) > 700
    assert bool(list(Path(seen[0]).glob("run-*"))) if waits else seen == [None]


def test_a_group_reaches_python_in_few_rows(spark, tmp_path, monkeypatch):
    """A symbol's trades come as names of files, not as rows, which Spark would pass at once; files go with the next batch."""
    monkeypatch.setattr(J, "PACKED_ROWS", 20)
    rng, folders, fresh, turns = random.Random(7), [], J.fresh_path, J._turns
    prices = [100 * rng.choice([1, 1, 1, 1, 0.4, 1.6, 3]) * rng.uniform(0.95, 1.05) for _ in range(600)]
    rows = [trade("BTCUSDT", i // 2, p, trade_id=str(i)) for i, p in enumerate(prices)]
    rows += [trade("ETHUSDT", i, 5.0, trade_id=f"e{i}") for i in range(10)] + [(None, at(1), 5.0, 1.0, "buy", "n", "x")]

    def few(batches, state, folder, arrived):
        batches = list(batches)
        assert sum(map(len, batches)) <= 20 and all(len(b) for b in batches)
        return turns(iter(batches), state, folder, arrived)

    monkeypatch.setattr(J, "_turns", few)
    monkeypatch.setattr(J, "fresh_path", lambda *a: folders.append(fresh(*a)) or folders[-1])
    first = rng.sample(rows[:500], 500)
    stream = stream_of(spark, str(tmp_path / "in"), [first, rows[500:]])
    out, _ = drained(spark, J.accuracy_stream(stream), str(tmp_path))
    got = {(r.symbol, r.trade_id): r.accepted for r in out.collect()}
    assert len(got) == len(rows) and got[None, "n"]
    assert [got["BTCUSDT", str(i)] for i in range(600)] == gate_loop(prices)
    assert len(list(Path(folders[0]).glob("run-*"))) == 1
