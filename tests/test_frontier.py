import random

import pytest

from weblode.operators import frontier


def walk(edges, seeds, budget=None):
    """Level-by-level walk in plain Python: {url: (depth, visited)}."""
    out, level, depth, left = {}, sorted(set(seeds)), 0, float("inf") if budget is None else budget
    targets = {}
    for a, b in edges:
        targets.setdefault(a, set()).add(b)
    while level:
        for i, url in enumerate(level):
            out[url] = (depth, i < left)
        chosen = level[: int(min(left, len(level)))]
        left -= len(chosen)
        level = sorted({b for a in chosen for b in targets.get(a, ())} - set(out))
        depth += 1
    return out


def as_dict(frame):
    return {r["url"]: (r["depth"], r["visited"]) for r in frame.collect()}


@pytest.mark.parametrize(("budget", "buckets"), [(None, 1), (1, None), (7, None), (25, 5), (None, 5), (1000, None)])
def test_walk_of_a_random_graph_with_cycles(spark, budget, buckets):
    rng = random.Random(3)
    edges = [(f"u{rng.randint(0, 60)}", f"u{rng.randint(0, 60)}") for _ in range(90)] + [("u1", f"x{i}") for i in range(40)]
    frame = spark.createDataFrame(edges, "src_url string, url string")
    seeds = spark.createDataFrame([("u1",), ("u2",), ("u1",)], "url string")
    assert as_dict(frontier.crawl_order(frame, seeds, budget, buckets)) == walk(edges, ["u1", "u2"], budget)


def test_deep_walk_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(frontier, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(frontier, "MERGE_LEVELS", 3)
    edges = [(f"n{i}", f"n{i + 1}") for i in range(12)] + [("n12", "n0"), ("n5", "n5")]
    frame = spark.createDataFrame(edges, "src_url string, url string")
    seeds = spark.createDataFrame([("n0",)], "url string")
    assert as_dict(frontier.crawl_order(frame, seeds, None)) == walk(edges, ["n0"])


def test_a_level_reads_the_buckets_of_its_urls(spark, monkeypatch):
    read, plain = [], frontier.read_buckets

    def counted(session, tables, wanted=None):
        frame = plain(session, tables, wanted)
        if wanted is not None:
            read.append(len(frame.inputFiles()))
        return frame

    monkeypatch.setattr(frontier, "read_buckets", counted)
    edges = [(f"n{i}", f"n{i + 1}") for i in range(4)] + [(f"far{i}", f"off{i}") for i in range(300)]
    frame = spark.createDataFrame(edges, "src_url string, url string")
    seeds = spark.createDataFrame([("n0",)], "url string")
    got = frontier.crawl_order(frame, seeds, buckets=50)
    assert as_dict(got) == walk(edges, ["n0"])
    # Edges of one URL lie in one of 50 buckets; of the levels before only buckets of what was found are read.
    assert len(read) == 10 and max(read[::2]) == 1 and max(read[1::2]) <= 2


def test_buckets_follow_the_bytes_of_the_edges(spark, monkeypatch):
    monkeypatch.setattr(frontier, "BUCKET_BYTES", 20)
    edges = [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d" * 90), (None, "e")]
    frame = spark.createDataFrame(edges, "src_url string, url string")
    assert as_dict(frontier.crawl_order(frame, spark.createDataFrame([("a",)], "url string"))) == walk(edges, ["a"])


def test_walk_without_seeds(spark):
    frame = spark.createDataFrame([("a", "b")], "src_url string, url string")
    assert frontier.crawl_order(frame, spark.createDataFrame([], "url string")).count() == 0


@pytest.mark.parametrize("n", [0, 1, 37, 200, 500])
def test_first_rows(spark, n):
    frame = spark.range(200).selectExpr("id", "concat('k', lpad(id * 7 % 200, 4, '0')) as k")
    got = sorted(r["k"] for r in frontier.first_rows(frame, ["k"], n).collect())
    assert got == sorted(f"k{i:04d}" for i in range(200))[:n]


def counter(links, templates, start):
    """One page after the other, as a reader would turn them."""
    pages, seen, found, stops = {}, set(), [], []
    for t, k, u in links:
        pages.setdefault((t, k), set()).add(u)
    for t in range(templates):
        k, empty = start, 0
        while empty < 9:
            new = pages.get((t, k), set()) - seen
            found += [(t, k, u) for u in new]
            seen |= new
            empty = 0 if new else empty + 1
            k += 1
        stops.append(k - 1)
    return sorted(found), stops


def check_counter(spark, links, templates, start):
    frame = spark.createDataFrame(links, "template int, k bigint, url string")
    walked, stops = frontier.counter_walk(frame, templates, start)
    assert (sorted(tuple(r) for r in walked.collect()), stops) == counter(links, templates, start)


def test_counter_stops_after_nine_empty_pages(spark):
    links = [(0, k, f"a{k}") for k in (1, 2, 5, 6, 7, 17)] + [(0, 8, "a1")]
    assert frontier.counter_walk(spark.createDataFrame(links, "template int, k bigint, url string"), 1, 1)[1] == [16]
    check_counter(spark, links, 1, 1)


def test_links_past_a_cut_stay_new(spark):
    links = [(0, 1, "a"), (0, 11, "late"), (0, 10, "edge"), (1, 3, "late"), (1, 4, "a"), (1, 13, "b"), (1, 2, "edge")]
    check_counter(spark, links, 2, 1)
    check_counter(spark, [(0, 30, "x"), (1, 1, "x")], 2, 1)
    check_counter(spark, [(0, 0, "x"), (0, 9, "y"), (0, 3, "z")], 1, 3)


def test_random_counter_walks(spark):
    rng = random.Random(11)
    for _ in range(3):
        links = [(rng.randint(0, 2), rng.randint(0, 60), f"u{rng.randint(0, 40)}") for _ in range(60)]
        check_counter(spark, links, 3, 0)


def test_counter_pages(spark):
    templates = spark.createDataFrame([(0, "http://h/{counter}")], "template int, pattern string")
    assert [r["url"] for r in frontier.counter_pages(templates, 2, 4).orderBy("k").collect()] == ["http://h/2", "http://h/3", "http://h/4"]


def test_summary(spark):
    links = spark.createDataFrame(
        [("a", True, True), ("a", False, False), ("b", True, False), ("c", False, True)],
        "url string, internal boolean, permitted boolean",
    )
    assert tuple(frontier.crawl_summary(links, 9).first()) == (2, 1, 1, 3, 9)
