import itertools
from collections import Counter

import numpy as np
import pytest

from weblode.llm import shards


@pytest.mark.parametrize("block_rows", [10_000, 3])
def test_every_row_has_one_place(spark, documents, block_rows):
    rows = [(None, None), (1, ""), (1, ""), *[(i, "x" * i) for i in range(200)]]
    placed = shards.shuffled_shards(documents(rows).repartition(7), shards=8, seed=3, block_rows=block_rows)
    got = placed.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    sizes = Counter(r.shard for r in got)
    assert set(sizes) == set(range(8)) and max(sizes.values()) - min(sizes.values()) <= 1
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sizes[s]))
    assert "_norm" in placed.columns and placed.columns.count("shard") == 1
    again = shards.shuffled_shards(documents(rows).repartition(7), shards=8, seed=4)
    assert again.count() == len(rows)


def test_empty_and_fewer_rows_than_shards(spark, documents):
    assert shards.shuffled_shards(documents([])).count() == 0
    assert {(r.slot) for r in shards.shuffled_shards(documents([(1, "a"), (2, "b")])).collect()} == {0}


def test_matrix_is_uniform_over_assignments():
    counts, tries = np.array([2, 1, 1]), 4000
    seen = Counter()
    for seed in range(tries):
        m = shards.communication_matrix(counts, 2, np.random.default_rng(seed))
        assert m.sum(axis=1).tolist() == [2, 1, 1] and m.sum(axis=0).tolist() == [2, 2]
        seen[tuple(map(tuple, m))] += 1
    # Of the six ways to send two of four rows to shard 0, count those that give each matrix.
    part_of = [0, 0, 1, 2]
    want = Counter()
    for first in itertools.combinations(range(4), 2):
        m = np.zeros((3, 2), dtype=int)
        for r in range(4):
            m[part_of[r], 0 if r in first else 1] += 1
        want[tuple(map(tuple, m))] += tries / 6
    assert set(seen) == set(want) and all(abs(seen[m] - n) < 5 * n**0.5 for m, n in want.items())
