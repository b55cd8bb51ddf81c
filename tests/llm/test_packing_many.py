"""Packing where a good sequence holds many pieces."""

from __future__ import annotations

import numpy as np
import pytest

from tickloom.llm import packing


@pytest.mark.parametrize(("low", "high", "most"), [(340, 460, 820), (200, 700, 910), (150, 190, 345), (205, 300, 516)])
def test_many_pieces_in_a_sequence(low, high, most):
    lengths = np.random.default_rng(1).integers(low, high + 1, 4096)
    found = packing.complete_bins(lengths, 2048)
    assert sorted(n for s in found for n in s) == sorted(lengths.tolist()) and max(map(sum, found)) <= 2048
    bound = packing.fewest_sequences(lengths, 2048)
    assert bound <= len(found) <= most and len(found) < len(packing.best_fit(lengths, 2048)), (bound, len(found))


def test_fillings_of_five_without_waste():
    """Ten sequences of six pieces, each of which is full."""
    rng = np.random.default_rng(5)
    parts = [np.diff([0, *sorted(rng.choice(np.arange(1, 2048), 5, replace=False)), 2048]) for _ in range(10)]
    lengths = np.concatenate(parts)
    assert len(packing.complete_bins(lengths, 2048)) == packing.fewest_sequences(lengths, 2048) == 10
    left = np.bincount(parts[0], minlength=2049)
    largest = int(parts[0].max())
    left[largest] -= 1
    assert sorted((largest, *packing._fillings(left, 2048 - largest, 4)[0])) == sorted(parts[0].tolist())
