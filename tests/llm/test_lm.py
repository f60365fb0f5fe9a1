import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from weblode.llm import lm


def words(text):
    return [*(text or "").encode().lower().split(), b""]


def discount(counts):
    of = Counter(min(n, 5) for n in counts if n)
    return lm.discounts(of[1], of[2], of[3], sum(1 for n in counts if n == 4))


def plain(rows):
    """Every number from plain dictionaries over all texts."""
    train = [words(t) for _, t, keep in rows if keep]
    single, pair = Counter(w for x in train for w in x), Counter((a, b) for x in train for a, b in zip([b"", *x], x, strict=False))
    total, kinds, after, classes = sum(single.values()), Counter(), Counter(), defaultdict(Counter)
    for (a, b), n in pair.items():
        kinds[b] += 1
        after[a] += n
        classes[a][min(n, 3)] += 1
    low, high = discount(kinds.values()), discount(pair.values())
    spare = sum(low[min(n, 3)] for n in kinds.values())
    out = []
    for k, t, keep in rows:
        tokens, base, score = words(t), 0.0, 0.0
        for a, b in zip([b"", *tokens], tokens, strict=False):
            base += math.log10((single[b] + 0.1) / (total + 0.1 * (len(single) + 1)))
            p = (max(kinds[b] - low[min(kinds[b], 3)], 0) + spare / (len(single) + 1)) / len(pair) if pair else 1.0
            if after[a]:
                weight = sum(high[c] * n for c, n in classes[a].items()) / after[a]
                p = max(pair[a, b] - high[min(pair[a, b], 3)], 0) / after[a] + weight * p
            score += math.log10(p)
        out.append((k, keep, len(tokens), sum(single[b] > 0 for b in tokens), total, round(base, 6), round(score, 6)))
    return sorted(out, key=str)


def corpus(n, rng):
    vocabulary = [f"w{int(rng.paretovariate(0.6))}" for _ in range(200)] + ["É", "Ab"]
    return [(None, None, True), (1, "", False), (1, "  \x0b", True)] + [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60))), i % 4 > 0) for i in range(n)]


@pytest.mark.parametrize(("hot", "block"), [(lm.HOT_TOKENS, lm.BLOCK_BYTES), (5, 800)])
def test_scores_equal_brute_force(spark, monkeypatch, hot, block):
    monkeypatch.setattr(lm, "HOT_TOKENS", hot)
    monkeypatch.setattr(lm, "BLOCK_BYTES", block)
    rows = corpus(120, random.Random(1))
    frame = spark.createDataFrame(rows, "doc_id long, text string, keep boolean").withColumns({"block": F.lit("x"), "learn": F.lit(1)}).repartition(3)
    got = lm.scored(frame, learn=F.col("keep"), buckets=7).collect()
    assert sorted(((*r[:5], round(r[5], 6), round(r[6], 6)) for r in got), key=str) == plain(rows)


def test_probabilities_sum_to_one(spark):
    """One text per known word and one unknown: their first words and ends are all that can follow the start."""
    rows = corpus(40, random.Random(2))
    known = sorted({w.decode() for _, t, keep in rows if keep for w in words(t)[:-1]})
    single = [(10_000 + i, w, False) for i, w in enumerate([*known, "unknown"])]
    double = [(20_000 + i, f"{w} {w}", False) for i, w in enumerate([*known, "unknown"])]
    frame = spark.createDataFrame(rows + single + double + [(30_000, "", False)], "doc_id long, text string, keep boolean")
    score = {r.doc_id: r.score for r in lm.scored(frame, learn=F.col("keep")).collect()}
    assert all(score[10_000 + i] > score[20_000 + i] for i in range(len(known)))
    first = {r[0]: r[-1] for r in plain(rows + single)}
    assert all(abs(first[k] - score[k]) < 1e-6 for k, _, _ in single)


def test_learn_nothing_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r for r in lm.scored(frame, learn=F.lit(False)).collect()}
    assert got[1].n_tokens == 3 and got[1].n_known == 0 and got[1].train_tokens == 0 and got[1].score == 0
    assert lm.scored(frame.limit(0)).count() == 0


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for top in (1, 255, 2**17, 2**40):
        x = rng.integers(0, top, 1000)
        assert (lm.unpack(lm.pack(x)) == x).all()
    h = np.sort(rng.integers(0, 2**64, 100, dtype=np.uint64, endpoint=False))
    assert (lm.unpack_sorted(lm.pack_sorted(h)) == h).all() and len(lm.unpack(lm.pack(h[:0]))) == 0


def test_held_out_texts_are_likelier_than_under_single_words(spark):
    from weblode.llm import queries

    rows = queries.op6(spark, "/root/testdata/sf0.01").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(r.score for r in held) > sum(r.base_score for r in held)
