"""The mix of a source holds all lengths, however large its budget is."""

import numpy as np
import pytest

from gleanspark.llm import mixing


@pytest.mark.parametrize("longest, copies", [(50, 40), (300, 1), (2000, 1), (2000, 30)])
def test_lengths_are_taken_alike(longest, copies):
    lengths, counts = np.arange(1, longest + 1), np.full(longest, copies)
    budget = int((lengths * counts).sum()) // 2
    take = mixing.fit_subset(lengths, counts, budget)
    assert (take >= 0).all() and (take <= counts).all() and (take * lengths).sum() == budget
    for part in np.array_split(np.arange(longest), 4):
        assert 0.35 <= take[part].sum() / counts[part].sum() <= 0.65


def test_few_long_items_fit_as_well_as_before():
    lengths, counts = np.array([0, 3, 70_000, 90_000]), np.array([5, 1, 2, 2])
    take = mixing.fit_subset(lengths, counts, 160_005)
    assert (take <= counts).all() and (take * lengths).sum() <= 160_005
    assert (mixing.fit_subset(np.array([7, 11]), np.array([3, 3]), 22) == [0, 2]).all()
