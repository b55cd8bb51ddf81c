"""As-of values and the replay of order events against plain loops."""

import bisect
import random

import pytest
from pyspark.sql import functions as F

from helpers import at
from tickloom.operators import ledger as L
from tickloom.operators.asof import as_of
from tickloom.schemas import ORDER_STATUS, ORDER_TRANSITIONS

EVENT_DDL = "id long, order_id long, event_type string, created_at timestamp"


def replayed(events):
    """Status and verdict after each event, order by order."""
    state, out = {}, {}
    for i, order, kind, when in sorted(events, key=lambda e: (e[3], e[0])):
        target, sources = ORDER_TRANSITIONS.get(kind, (None, []))
        accepted = state.get(order) in sources
        if accepted:
            state[order] = target
        out[i] = (order, state.get(order), accepted)
    return out, state


@pytest.mark.parametrize("size", [7, 4096])
def test_replay_equals_a_loop(spark, size):
    rng = random.Random(6)
    kinds = [*ORDER_TRANSITIONS, *["order.created", "order.submitted", "order.partially_filled"] * 3, "order.odd"]
    # Order 1 has half of all events, in one long run of partial fills.
    events = [(i, 1 if i % 2 else rng.randrange(2, 30), rng.choice(kinds), at(rng.randrange(400))) for i in range(900)]
    events += [(1000 + i, 77, "order.partially_filled" if i else "order.created", at(i)) for i in range(60)]
    frame = spark.createDataFrame(events, EVENT_DDL).repartition(5)
    plain, state = replayed(events)
    rows = L.replay_orders(frame, size=size).persist()
    assert {r.id: (r.order_id, r.status, r.accepted) for r in rows.collect()} == plain
    found = {r.order_id: r for r in L.replayed_state(rows).collect()}
    assert {k: r.status for k, r in found.items()} == {k: state.get(k) for k in found}
    assert found[77].accepted == 60 and found[77].rejected == 0
    rows.unpersist()


def test_both_vocabularies(spark):
    frame = spark.createDataFrame([(s,) for s in ORDER_STATUS], "s string")
    rows = frame.select("s", L.platform_status(F.col("s")), L.service_status(F.col("s"))).collect()
    assert {r[0]: r[1] for r in rows} == {**{s: s for s in ORDER_STATUS}, "pending": "new", "expired": "canceled"}
    assert {r[0]: r[2] for r in rows} == {**{s: s for s in ORDER_STATUS}, "new": "pending"}


def test_as_of_equals_a_search(spark):
    rng = random.Random(2)
    facts = [(rng.choice("AAAAAB"), at(rng.randrange(300)), float(i), i) for i in range(500)]
    points = [(k, at(t)) for k in "ABC" for t in range(-5, 320, 5)]
    found = as_of(
        spark.createDataFrame(points, "symbol string, ts timestamp"),
        spark.createDataFrame(facts, "symbol string, ts timestamp, price double, n long").repartition(3),
        ["symbol"], "ts", ["price", "n"], ties=("n",),
    ).collect()
    assert len(found) == len(points)
    for key in "ABC":
        own = sorted((ts, n, price) for k, ts, price, n in facts if k == key)
        for r in (r for r in found if r.symbol == key):
            i = bisect.bisect_right([ts for ts, _, _ in own], r.ts)
            assert (r.price, r.n) == ((own[i - 1][2], own[i - 1][1]) if i else (None, None))
