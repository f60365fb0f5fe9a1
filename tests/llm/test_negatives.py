import random

import pytest
from pyspark.sql import functions as F

from weblode.llm import negatives

KIND = "doc int, vec long, label int, e array<double>, score string, anchor string, kind int, `id` string"


def plain(rows, every=5):
    best = {}
    for key, label, e in rows:
        if None in (key, label, e) or any(x is None or x != x or abs(x) == float("inf") for x in e):
            continue
        whole = (label, tuple(int((256 * x) // 1) for x in e))
        best[key] = min(best.get(key, whole), whole)
    out = []
    for a, (label, e) in best.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(e, f, strict=False)), k, other == label) for k, (other, f) in best.items() if k != a)
        for s, p, _ in [x for x in scored if x[2]][:5]:
            fit = [x for x in scored if not x[2] and -50 * s <= -100 * x[0] <= -95 * s][:3]
            out += [(a, p, r, n, -s, -t) for r, (t, n, _) in enumerate(fit, 1)]
    return sorted(out)


def made(seed, n, width, labels, values):
    rng = random.Random(seed)
    return [(i, rng.randrange(labels), [rng.choice(values) for _ in range(width)]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame([(0, *r, None, None, None, None) for r in rows], KIND)


def mined(spark, rows, every=5):
    found = negatives.hard_negatives(frame(spark, rows).repartition(3), F.col("vec") % every == 0, "vec", "label", "e")
    return sorted(map(tuple, found.collect()))


TIES = [-0.5, 0.0, 0.25, 0.5]


@pytest.mark.parametrize("tile", [negatives.TILE, 2])
@pytest.mark.parametrize(("width", "labels", "values"), [(3, 3, TIES), (8, 2, [x / 100 for x in range(-90, 91)]), (1, 2, [0.0, 0.001, 0.01])])
def test_equals_brute_force(spark, monkeypatch, tile, width, labels, values):
    monkeypatch.setattr(negatives, "TILE", tile)
    monkeypatch.setattr(negatives, "ROWS", 7 if tile == 2 else negatives.ROWS)
    rows = made(width, 150, width, labels, values)
    want = plain(rows)
    assert mined(spark, rows) == want and (want or width == 1)


def test_pieces_and_reductions(spark, monkeypatch):
    monkeypatch.setattr(negatives, "PIECE_BYTES", 200)
    monkeypatch.setattr(negatives, "PIECES", 2)
    rows = made(1, 120, 4, 3, TIES)
    assert mined(spark, rows) == plain(rows)


def test_awkward_rows(spark):
    rows = made(9, 60, 4, 2, TIES)
    rows += [(None, 1, [0.5] * 4), (200, None, [0.5] * 4), (205, 1, None), (210, 1, [0.5, None, 0.5, 0.5]), (215, 1, [0.5, float("nan"), 0.0, 0.0]), (220, 0, [float("inf")] * 4)]
    rows += [(225, 1, []), (230, 1, [0.5]), (0, 1, [0.25] * 4), (10, 0, [0.5] * 4), rows[15], rows[15], (235, 77, [0.5] * 4)]
    assert mined(spark, rows) == plain(rows)
    assert mined(spark, []) == [] and mined(spark, [(1, 1, [0.5])]) == [] and mined(spark, [(5, 1, [0.5])]) == []


def test_large_components(spark):
    rows = [(i, i % 2, [6e4 * ((i * 7) % 11 - 5) + 0.3, 2e5, 1.0 * i]) for i in range(40)]
    assert mined(spark, rows) == plain(rows)
    with pytest.raises(ValueError):
        mined(spark, [(0, 1, [1e30]), (1, 1, [1.0])])


def test_reduction_keeps_the_first_of_each_range():
    import numpy as np

    m = negatives.Matches(np.array([[0, 0]]), np.array([[9, 5]]), 2)
    m.add(np.zeros(6, np.int64), np.array([9, 9, 9, 5, 5, 4]), np.array([3, 1, 2, 8, 9, 0]))
    m.reduce()
    assert [list(x) for x in m.found] == [[0] * 4, [9, 9, 5, 5], [1, 2, 8, 9]] and m.low.tolist() == [[9, 5]]
