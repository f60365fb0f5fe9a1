import random

import numpy as np
import pytest
import xxhash

from weblode.llm import simhash


def plain_print(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    h = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(rows):
    prints = [plain_print(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                root[find(i)] = find(j)
    least = {}
    for i, (k, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return sorted(((k, f"{p:016x}", least.get(find(i))) for i, (k, p) in enumerate(zip([r[0] for r in rows], prints, strict=True))), key=str)


def corpus():
    rng = random.Random(5)
    vocabulary = [f"w{i}é" for i in range(60)] + ["Ab", "aB"]
    rows = [(None, "a b"), (7, None), (3, ""), (900, " \t\n "), (901, "One"), (902, "one"), (902, "one")]
    for i in range(40):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 30, 400]))]
        rows.append((1000 + 10 * i, " ".join(words)))
        for j in range(rng.choice([0, 0, 3])):
            words[rng.randrange(len(words))] = "changed"
            rows.append((1001 + 10 * i + j, "  ".join(words)))
    return rows


@pytest.mark.parametrize("block", [simhash.BLOCK, 3])
def test_components_equal_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)
    rows = corpus()
    got = sorted(map(tuple, simhash.near_duplicates(documents(rows)).collect()), key=str)
    assert got == plain_components(rows)


def test_close_pairs_lose_none():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(400)], dtype=np.uint64)
    prints = np.unique(base[rng.integers(0, 40, 400)] ^ flips)
    want = {(i, j) for i in range(len(prints)) for j in range(len(prints)) if int(prints[i] ^ prints[j]).bit_count() <= 4}
    got = {(int(i), int(j)) for a, b in simhash.close_pairs(prints, prints) for i, j in zip(a, b, strict=True)}
    assert got == want


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i + 1, i) for i in range(300)] + [(1000, 999), (5, 5)], "high long, low long")
    roots = dict(map(tuple, simhash.components(edges).collect()))
    assert all(roots[i] == 0 for i in range(1, 301)) and roots[1000] == 999


def test_stage_keeps_one_of_each(spark, documents):
    rows = corpus()
    kept = simhash.one_of_each(documents(rows))
    want = [r for r in rows if r[0] is None or any(k == r[0] == c for k, _, c in plain_components(rows))]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert kept.columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
    assert simhash.one_of_each(documents([])).count() == 0
