import random
from collections import Counter

import numpy as np
import pytest

from weblode.llm import suffixes


def plain(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), dtype=bool)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = True
        out.append(gone)
    return out


def corpus(rng, n, size):
    passage = "".join(rng.choice("abcde é") for _ in range(3 * size))
    out = []
    for _ in range(n):
        text = "".join(rng.choice("abcd ") for _ in range(rng.randrange(4 * size)))
        if rng.random() < 0.6:
            a = rng.randrange(len(passage))
            text += passage[a : a + rng.randrange(3 * size)] + "".join(rng.choice("xyz") for _ in range(rng.randrange(size)))
        out.append(text)
    return out + rng.sample(out, 3)


@pytest.mark.parametrize("seed", range(4))
def test_repeated_starts_equal_brute_force(seed):
    rng = random.Random(seed)
    length = rng.choice([3, 8, 20])
    strings = [t.encode() for t in corpus(rng, 25, length)] + [b"", b"\x00" * 30, b"\x00\xff" * 20, b"abab" * 12, b"x"]
    seen = Counter(t[i : i + length] for t in strings for i in range(len(t) - length + 1))
    want = [[i for i in range(len(t) - length + 1) if seen[t[i : i + length]] > 1] for t in strings]
    assert [f.tolist() for f in suffixes.repeated_starts(strings, length)] == want


def test_each_window_has_one_context():
    rng = random.Random(3)
    texts = [t.encode() for t in corpus(rng, 12, 20)] + [b"", b"z" * 200, b"ab" * 90]
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    sizes = np.array([len(t) for t in texts])
    ends = np.repeat(np.cumsum(sizes), sizes)
    h, c, first, count = suffixes.contexts(data, ends, 20)
    got = sorted(i for f, n in zip(first.tolist(), count.tolist(), strict=True) for i in range(f, f + n))
    assert got == [i for i in range(len(data)) if i + 20 <= ends[i]]
    anchor = {}
    for key, f, n in zip(h.tolist(), first.tolist(), count.tolist(), strict=True):
        for i in range(f, f + n):
            assert anchor.setdefault(bytes(data[i : i + 20]), key) == key


@pytest.mark.parametrize(("hot", "length"), [(suffixes.HOT_CONTEXTS, 400), (2, 400), (suffixes.HOT_CONTEXTS, 40)])
def test_removed_bytes_equal_brute_force(spark, documents, monkeypatch, hot, length):
    monkeypatch.setattr(suffixes, "HOT_CONTEXTS", hot)
    monkeypatch.setattr(suffixes, "RUN_BYTES", 2_000)
    monkeypatch.setattr(suffixes, "CHUNK_BYTES", 5_000)
    rng = random.Random(length + hot)
    texts = corpus(rng, 40, length) + [None, "", "é" * length, "The " * 500, "of " * 300, "q" * (length - 1), "q" * length]
    long_one = "".join(rng.choice("abc") for _ in range(50_000))
    texts += [long_one, "!" + long_one[20_000 : 20_000 + 2 * length] + "?"]
    rows = [(i % 50, t) for i, t in enumerate(texts)]
    docs = documents(rows, "row string, data int, cut int").repartition(5)
    data = [(t or "").encode() for t in texts]
    want = []
    for (k, _), t, gone in zip(rows, data, plain(data, length), strict=True):
        edges = np.flatnonzero(np.diff(np.concatenate(([0], gone.astype(int), [0])))).reshape(-1, 2)
        want.append((k, len(t), [tuple(e) for e in edges.tolist()], np.frombuffer(t, np.uint8)[~gone].tobytes()))
    got = [(r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], bytes(r.kept)) for r in suffixes.without_repeats(docs, length=length).collect()]
    assert sorted(got) == sorted(want)


def test_empty_table(spark, documents):
    assert suffixes.without_repeats(documents([])).count() == 0


@pytest.mark.parametrize("stable", [False, True])
def test_row_numbers_do_not_follow_the_splits_of_a_scan(spark, documents, tmp_path, stable):
    rng = random.Random(9)
    texts = corpus(rng, 60, 40)
    path = str(tmp_path / "docs")
    documents(list(enumerate(texts))).repartition(6).write.parquet(path)
    keys = {"spark.sql.files.maxPartitionBytes": "1m", "spark.sql.files.openCostInBytes": "1m", "spark.sql.files.minPartitionNum": "1"}
    try:
        for key, value in keys.items():
            spark.conf.set(key, value)
        cut = suffixes.without_repeats(spark.read.parquet(path), length=40, stable=stable)
        # The last job of the operator runs with other splits than those before it.
        spark.conf.set("spark.sql.files.maxPartitionBytes", "1g")
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        got = {r.doc_id: bytes(r.kept) for r in cut.collect()}
    finally:
        for key in keys:
            spark.conf.unset(key)
    data = [t.encode() for t in texts]
    assert got == {i: np.frombuffer(t, np.uint8)[~gone].tobytes() for i, (t, gone) in enumerate(zip(data, plain(data, 40), strict=True))}
