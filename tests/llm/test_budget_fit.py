"""The budget fit of the mix against every choice of documents."""

import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as some

from tokenloom.llm import mixing


def filled(sizes, counts, budget):
    taken = mixing.fitted(np.array(sizes), np.array(counts), budget)
    assert all(0 <= t <= c for t, c in zip(taken.tolist(), counts))
    return int((np.array(sizes) * taken).sum())


@pytest.mark.parametrize("sizes,budget", [([150_000, 140_000, 130_000], 270_000), ([400_000, 390_000, 300_000, 290_000], 590_000),
                                          ([1_000_000, 999_999, 3], 1_000_002)])
def test_sizes_beyond_the_least_window(sizes, budget):
    assert filled(sizes, [1] * len(sizes), budget) == budget


@settings(max_examples=200, deadline=None)
@given(some.dictionaries(some.integers(1, 1_000_000), some.integers(0, 3), min_size=1, max_size=5), some.floats(0, 1))
def test_fit_is_the_best_of_all_choices(by_size, share):
    sizes, counts = list(by_size), list(by_size.values())
    budget = int(sum(s * c for s, c in by_size.items()) * share)
    sums = (sum(s * n for s, n in zip(sizes, choice)) for choice in itertools.product(*(range(c + 1) for c in counts)))
    assert filled(sizes, counts, budget) == max(n for n in sums if n <= budget)


def test_many_sizes_fill_the_budget_to_the_word():
    random = np.random.default_rng(3)
    for largest in (500, 30_000, 400_000):
        sizes = np.unique(random.integers(1, largest, 500))
        counts = random.integers(1, 40, len(sizes))
        budget = int((sizes * counts).sum() * 0.37)
        assert filled(sizes, counts.tolist(), budget) == budget
