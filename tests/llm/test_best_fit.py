"""The matches of runs place pieces as a row-wise best fit does: each piece, longest first, into the smallest gap that holds it."""

import random
from bisect import bisect_left, insort
from collections import Counter

import pytest

from quillspark.llm import packing


def row_by_row(lengths, capacity):
    """What each sequence holds in the end."""
    gaps, opened = [], 0
    for length in sorted(lengths.elements(), reverse=True):
        at = bisect_left(gaps, length)
        gap = gaps.pop(at) if at < len(gaps) else capacity
        opened += gap == capacity and at >= len(gaps)
        insort(gaps, gap - length)
    return sorted(capacity - g for g in gaps)


@pytest.mark.parametrize("capacity", [7, 16, 64, 300])
def test_fills_are_those_of_a_row_wise_best_fit(capacity):
    draw = random.Random(capacity)
    for _ in range(200):
        lengths = Counter({n: draw.choice([1, 1, 2, 3, 9, 40]) for n in range(1, capacity + 1) if draw.random() < draw.choice([0.1, 0.5, 1.0])})
        matches, sequences = packing.best_fit(dict(lengths), capacity)
        fill, taken = Counter(), {}
        for length, rank, per, first, offset, until in matches.tolist():
            for r in range(rank, until):
                place = (first + (r - rank) // per, offset + (r - rank) % per * length)
                assert place not in taken
                taken[place] = length
                fill[place[0]] += length
        assert Counter(taken.values()) == lengths and len(fill) == sequences
        for sequence, offset in taken:  # gapless from 0
            assert offset == 0 or any(o + taken[sequence, o] == offset for s, o in taken if s == sequence) or len(taken) > 400
        assert sorted(fill.values()) == row_by_row(lengths, capacity)
