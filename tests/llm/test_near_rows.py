"""Signature rows: in proportion to the sets at every size of the corpus, rarely shared by unrelated sets."""

from __future__ import annotations

import numpy as np
import pytest

from tickloom.llm import near_duplicates

LEAST, WIDTH = (4, 5), 5


@pytest.mark.parametrize("sets", [3_000, 47_000, 230_000])
def test_unrelated_sets_rarely_meet(sets):
    """Before, sets met in their empty segments (over 4000 pairs of 300 sets), and of 3 million sets each had three times the rows."""
    rng = np.random.default_rng(sets)
    sizes = rng.integers(500, 620, 300)
    values = np.concatenate([np.sort(rng.integers(0, 2**64, n, dtype=np.uint64)) for n in sizes])
    owner, signature, kind = near_duplicates.signatures(sizes, values, sets, LEAST, WIDTH)
    assert len(owner) <= 0.6 * sizes.sum()
    rows = np.unique(np.stack([signature.view(np.int64), owner]), axis=1)
    _, counts = np.unique(rows[0], return_counts=True)
    assert (counts * (counts - 1) // 2).sum() <= 300


@pytest.mark.parametrize("sets", [1, 3_000, 47_000, 10**8])
def test_sets_that_share_empty_segments_only_meet(sets):
    """Five elements in each of a fifth as many segments, of which the other set lacks one each."""
    rng = np.random.default_rng(1)
    for size in (20, 60, 200, 400, 1000):
        for upper in (0, 1):  # of the band of the larger set, and of the band below
            first = near_duplicates.bands(size, LEAST)
            group = int(np.searchsorted(first, size, side="right")) - 1 - upper
            m, _, spare = near_duplicates.allocation(int(first[group + 1] - 1), sets, LEAST, WIDTH)
            filled = np.sort(rng.choice(m, min(size // 5, m), replace=False)).astype(np.uint64)
            low = -(-(filled << np.uint64(32)) // np.uint64(m))
            x = np.concatenate([(low + np.uint64(k) << np.uint64(32)) + rng.integers(0, 2**31, dtype=np.uint64) for k in range(5)])
            y = np.sort(x[len(filled):])
            x = np.sort(x)
            assert near_duplicates.similar(x, y, LEAST)
            both = np.array([len(x), len(y)]), np.concatenate([x, y])
            owner, signature, kind = near_duplicates.signatures(*both, sets, LEAST, WIDTH)
            rows = [set(zip(signature[owner == i].tolist(), kind[owner == i].tolist())) for i in (0, 1)]
            full, every = [{s for s, k in r if k < 2} for r in rows], [{s for s, _ in r} for r in rows]
            assert full[0] & every[1] or full[1] & every[0], (sets, size, m, spare)


def test_short_sketches_are_whole_outlines():
    """Of texts of 400 words all bits refute; with two bits of each byte pairs at 0.75 were let through."""
    rng = np.random.default_rng(2)
    x = rng.integers(0, 256, 300, dtype=np.uint8)
    y = np.where(rng.random(300) < 0.35, rng.integers(0, 256, 300, dtype=np.uint8), x).astype(np.uint8)
    drawn = near_duplicates.outlines([x.tobytes(), y.tobytes()])
    assert drawn == [b"\0" + x.tobytes(), b"\0" + y.tobytes()]


def test_long_outlines_differ_in_no_more_fields_than_sketches():
    rng = np.random.default_rng(4)
    for length in (1025, 3001):
        x, y = rng.integers(0, 256, (2, length), dtype=np.uint8)
        drawn = near_duplicates.outlines([x.tobytes(), y.tobytes()])
        lengths = np.array([len(d) for d in drawn])
        facts = np.frombuffer(b"".join(drawn), np.uint8), np.cumsum(lengths) - lengths, lengths
        unlike = int(near_duplicates._unlike(*facts, np.array([0]), np.array([1]))[0])
        assert unlike == ((x ^ y) & 1).sum() and lengths[0] <= length // 8 + 2
