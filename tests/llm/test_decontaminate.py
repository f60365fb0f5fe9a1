import random
import re

import pytest

from weblode.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, items):
    out = []
    for k, t in rows:
        w, hit, found = words(t), set(), set()
        for item, text in items:
            of = words(text)
            n = min(10, len(of))
            if not n or item is None:
                continue
            wanted = {tuple(of[i : i + n]) for i in range(len(of) - n + 1)}
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in wanted:
                    hit.update(range(i, i + n))
                    found.add(str(item))
        out.append((k, len(w), len(hit), sorted(found)))
    return sorted(out, key=str)


@pytest.mark.parametrize("set_windows", [decontaminate.SET_WINDOWS, 20])
def test_hits_equal_brute_force(spark, documents, set_windows):
    rng = random.Random(2)
    some = [rng.choice(["a", "B", "ça", "42", "dé"]) for _ in range(60)]
    items = [(10, " ".join(some[:25])), (2, "Ça, B. 42!"), (3, None), (4, "..."), (5, "zz"), (None, "a"), (11, " ".join(some[30:41])), (12, " ".join(some[30:41]))]
    rows = [(1, None), (2, ""), (3, "a-b\n" + "; ".join(some)), (3, "zz zz ZZ"), (4, "x " * 3000 + " ".join(some[5:20])), (5, " ".join(some[31:40]))]
    rows += [(10 + i, " ".join(rng.choice(some) for _ in range(40))) for i in range(30)]
    bench = spark.createDataFrame(items, "item_id int, text string")
    frame = decontaminate.contaminated(documents(rows, "spans string, n_hit int, _x string"), bench, set_windows=set_windows)
    got = frame.collect()
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in got), key=str) == plain(rows, items)
    for r in got:
        data = (r.text or "").encode()
        assert sum(len(words(data[s.start : s.stop].decode())) for s in r.spans) == r.n_hit
    cut = {r.doc_id: r.text for r in decontaminate.without_spans(frame).collect()}
    assert cut[5] == dict(rows)[5] and cut[1] == ""


def test_empty_tables(spark, documents):
    bench = spark.createDataFrame([], "item_id int, text string")
    assert decontaminate.contaminated(documents([]), bench).count() == 0
    assert [r.n_hit for r in decontaminate.contaminated(documents([(1, "a b")]), bench).collect()] == [0]
