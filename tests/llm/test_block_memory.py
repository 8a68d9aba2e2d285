"""What a task holds while it counts a block."""

import tracemalloc

import numpy as np

from gaugekeep.llm import jaccard_join as j


def test_frequent_values_are_those_of_unique():
    for n in (0, 1, 2, 3, 10, 1000, 100_000):
        x = np.random.default_rng(n).integers(0, max(1, n // 3), n, dtype=np.uint64)
        want, times = np.unique(x, return_counts=True)
        u, c = j.frequent(x.copy())
        assert u.tolist() == want[times >= j.HOT_LEAST].tolist() and c.tolist() == times[times >= j.HOT_LEAST].tolist()


def test_a_block_of_rare_shingles_takes_no_copies():
    x = np.random.default_rng(1).integers(0, 1 << 63, 500_000, dtype=np.uint64)
    tracemalloc.start()
    j.frequent(x)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < x.nbytes / 2  # np.unique with counts: several times the block
