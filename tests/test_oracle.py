"""Registered queries beside their DuckDB oracles.

ALL_QUERIES=1 runs every one; the default takes one or two of each group, since
the other tests run the same operators against plain loops.
"""

import os
import re

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from oracle import compare

FOLDER = os.environ.get("SF_DIR", "/root/testdata/sf0.001")
CHOICE = (
    "F1", "P3", "P8", "Q6", "Q8", "Q9", "S3", "S6", "S7", "A1_candles", "A4", "A9", "A11", "J2", "J5_held", "J8", "W1_",
    "W2", "W8_slice_newest", "W9_feature", "W15", "O2_portfolio", "L2_settlement", "L5_transfers", "L6", "L7", "L11", "M4",
    "M5", "T8_bar_updates",
)
ORACLES, QUERIES = oracle_sql(), queries()
PICKED = [n for n in QUERIES if os.environ.get("ALL_QUERIES") or n.startswith(CHOICE)]


def test_every_query_has_an_oracle():
    own = {n for n in QUERIES if n != "pipeline" and not re.match(r"op\d+_", n)}
    assert own <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", PICKED)
def test_matches_the_oracle(spark, name):
    assert compare(spark, QUERIES[name], ORACLES[name], FOLDER) is None


def test_entry(spark):
    out = entry(spark)
    assert out.count() > 0 and "bb_upper" in out.columns
