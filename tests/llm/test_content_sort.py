import hashlib
import re

import pytest

from weblode.llm import content_sort


def plain(rows):
    norm = [re.sub(r"[\x20\x09-\x0D]", "", t or "") for _, t in rows]
    out = []
    for k, n in zip([r[0] for r in rows], norm, strict=True):
        group = [r for r, m in zip(rows, norm, strict=True) if m == n]
        best = min(group, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] or 0))
        out.append((k, best[0], len(group), hashlib.sha256(n.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("share", [content_sort.HOT_SHARE, 4])
def test_groups_equal_brute_force(spark, documents, monkeypatch, share):
    monkeypatch.setattr(content_sort, "HOT_SHARE", share)
    rows = [(5, "a b"), (4, "a  b"), (9, "a\x0bb "), (3, "ab"), (None, None), (None, ""), (8, " \t"), (2, "é x"), (1, "é  x"), (6, "éx"), (11, "y" * 200_000)]
    rows += [(100 + i, "copy  of  it" if i % 3 else "copy of it") for i in range(60)] + [(101, "copy of it"), (103, "copy of it")]
    frame = content_sort.exact_duplicates(documents(rows))
    got = frame.collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got), key=str) == plain(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got}) == len({r.text_sha256 for r in kept})
    assert all(r.doc_id == r.keep_id for r in kept)
    assert [c.lower() for c in frame.columns].count("kept") == 1
    assert {r["_norm"] for r in got} == {None}  # a column of the input, not the working one


def test_empty_table_and_plan(spark, documents):
    assert content_sort.exact_duplicates(documents([])).count() == 0
    plan = content_sort.exact_duplicates(documents([(1, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(_head" in plan and plan.count("rangepartitioning") == plan.count("Window [") == 1 and "Python" not in plan and "Arrow" not in plan
