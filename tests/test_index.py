import random

import pytest

from weblode.operators import index, records


def docs(spark, rows):
    return spark.createDataFrame(rows, "url string, n int")


def content(spark, path):
    return sorted(tuple(r) for r in index.read_index(spark, path).select("url", "n").collect())


def test_upsert_replaces_adds_and_keeps(spark, tmp_path):
    path = str(tmp_path / "index")
    assert index.read_index(spark, path) is None
    index.upsert(path, docs(spark, [(f"u{i}", i) for i in range(20)]), "url", buckets=4)
    index.upsert(path, docs(spark, [("u3", 33), ("new", 1)]), "url", buckets=4)
    want = sorted([(f"u{i}", 33 if i == 3 else i) for i in range(20)] + [("new", 1)])
    assert content(spark, path) == want
    # Again changes nothing, and an empty batch neither.
    index.upsert(path, docs(spark, [("u3", 33), ("new", 1)]), "url", buckets=4)
    index.upsert(path, docs(spark, []), "url", buckets=4)
    assert content(spark, path) == want


def test_last_of_a_batch_wins(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.createDataFrame([("a", 1, 5), ("a", 2, 9), ("a", 3, 7)], "url string, n int, at int")
    index.upsert(path, rows, "url", arrival=["at"], buckets=2)
    assert content(spark, path) == [("a", 2)]


def test_commit_that_dies_halfway_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "index")
    index.upsert(path, docs(spark, [("a", 1), ("b", 2), ("c", 3)]), "url", buckets=1)
    with monkeypatch.context() as broken:
        changes = docs(spark, [("b", 20), ("d", 4)])
        broken.setattr(index, "log_row", lambda *_: 1 / 0)  # after the data, before the log
        with pytest.raises(ZeroDivisionError):
            index.upsert(path, changes, "url", buckets=1, batch="7")
    assert len(list((tmp_path / "index" / "data").iterdir())) == 2
    assert content(spark, path) == [("a", 1), ("b", 2), ("c", 3)]
    for _ in range(2):
        index.upsert(path, docs(spark, [("b", 20), ("d", 4)]), "url", buckets=1, batch="7")
    assert content(spark, path) == [("a", 1), ("b", 20), ("c", 3), ("d", 4)] and index.read_state(spark, path).version == 2


def test_repeated_batch_does_not_rewind_later_ones(spark, tmp_path):
    path = str(tmp_path / "index")
    index.upsert(path, docs(spark, [("a", 1)]), "url", buckets=1, batch="x-0")
    index.upsert(path, docs(spark, [("a", 2), ("b", 2)]), "url", buckets=1, batch="x-1")
    index.upsert(path, docs(spark, [("a", 1)]), "url", buckets=1, batch="x-0")
    assert content(spark, path) == [("a", 2), ("b", 2)]


def test_untouched_buckets_are_not_rewritten(spark, tmp_path):
    path = str(tmp_path / "index")
    index.upsert(path, docs(spark, [(f"u{i}", i) for i in range(50)]), "url", buckets=16)
    before = index.read_state(spark, path).buckets
    index.upsert(path, docs(spark, [("u1", 100)]), "url", buckets=16)
    after = index.read_state(spark, path).buckets
    assert sum(before[b] != after[b] for b in before) == 1 and before.keys() == after.keys()


def test_new_records_are_added_as_parts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "MOST_PARTS", 3)
    path = str(tmp_path / "index")
    for i in range(5):
        index.upsert(path, docs(spark, [(f"u{i}", i)]), "url", buckets=1, only_new=True)
    assert content(spark, path) == [(f"u{i}", i) for i in range(5)]
    assert len(index.read_state(spark, path).buckets[0]) == 2  # three parts were put together with the fourth


def files_read(frame):
    return len(frame.inputFiles())


@pytest.mark.parametrize("identity", [["url"], ["url", "n"]])
def test_a_batch_reads_the_buckets_it_touches(spark, tmp_path, identity):
    path = str(tmp_path / "index")
    index.upsert(path, docs(spark, [(f"u{i}", i) for i in range(400)]), "url", buckets=40, identity=identity)
    state = index.read_state(spark, path)
    assert files_read(index.read_buckets(spark, path, state)) >= 40
    asked = docs(spark, [("u7", 7), ("u8", 80), ("new", 1)])
    features = asked.select(*index.identity_of(asked, identity, state.schema))
    known = index.known_identities(spark, path, state, features, "url")
    assert 1 <= files_read(known.select("feature_0")) <= 4 + len(identity)
    got = {r["url"] for r in index.not_in_index(path, asked, identity, "url").collect()}
    assert got == ({"new"} if identity == ["url"] else {"u8", "new"})


def test_identity_of_a_replaced_document_is_new_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "MOST_PARTS", 2)
    path = str(tmp_path / "index")
    want = {}
    rng = random.Random(2)
    for _ in range(6):
        batch = {f"u{rng.randrange(8)}": rng.randrange(3) for _ in range(4)}
        index.upsert(path, docs(spark, list(batch.items())), "url", buckets=3, identity=["n", "url"])
        want |= batch
    asked = [(f"u{i}", n) for i in range(9) for n in range(3)]
    got = {tuple(r) for r in index.not_in_index(path, docs(spark, asked), ["n", "url"], "url").collect()}
    assert got == {a for a in asked if want.get(a[0]) != a[1]}
    # Other features, and an index that was not told of them by every commit: the whole index is read.
    assert {r["n"] for r in index.not_in_index(path, docs(spark, asked), ["n"], "url").collect()} == set(range(3)) - set(want.values())
    index.upsert(path, docs(spark, [("late", 2)]), "url", buckets=3)
    assert index.read_state(spark, path).identity == ()
    assert index.not_in_index(path, docs(spark, [("late", 2), ("u", 0)]), ["n", "url"], "url").count() == 1


def test_state_is_written_out_and_history_not_read(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(index, "MOST_COMMITS", 3)
    path = str(tmp_path / "index")
    for i in range(10):
        index.upsert(path, docs(spark, [(f"u{i % 4}", i)]), "url", buckets=2, batch=f"s-{i}", identity=["url"])
    state = index.read_state(spark, path)
    assert (state.version, state.epoch, state.logged, state.batches, state.count) == (10, 3, 1, {"s": 9}, 2)
    # What is read: one state and the commits since, not the log of earlier ones.
    (tmp_path / "index" / "log" / "0").rename(tmp_path / "moved")
    assert content(spark, path) == [("u0", 8), ("u1", 9), ("u2", 6), ("u3", 7)]
    index.upsert(path, docs(spark, [("u0", 0)]), "url", batch="s-8")
    # A state that was not written whole does not count.
    (tmp_path / "index" / "state" / "4").mkdir()
    assert index.read_state(spark, path).version == 10 and content(spark, path)[0] == ("u0", 8)


def test_new_columns_and_types_that_do_not_fit(spark, tmp_path):
    path = str(tmp_path / "index")
    index.upsert(path, docs(spark, [("a", 1), ("b", 2)]), "url", buckets=2)
    index.upsert(path, spark.createDataFrame([("b", "x", 5), ("c", "7", 6)], "url string, n string, m int"), "url", buckets=2)
    index.upsert(path, spark.createDataFrame([("d", [1])], "url string, n array<int>"), "url", buckets=2)
    index.upsert(path, docs(spark, [("a", 9)]), "url", buckets=2)
    rows = index.read_index(spark, path)
    assert rows.schema.simpleString() == "struct<url:string,n:int,m:int>"
    assert sorted(map(tuple, rows.collect())) == [("a", 9, None), ("b", None, 5), ("c", 7, 6), ("d", None, None)]


def test_ties_are_settled_by_the_row(spark):
    rows = [("k", 1, v) for v in range(20)]
    want = None
    for parts in (1, 7):
        frame = spark.createDataFrame(rows, "k string, at int, v int").repartition(parts)
        got = [records.first_of_each(frame, ["k"], ["at"]).first()["v"], records.last_of_each(frame, "k", ["at"]).first()["v"]]
        assert want in (None, got)
        want = got


@pytest.mark.parametrize("partitions", ["1", "64"])
def test_first_of_each_with_a_hot_identity(spark, partitions):
    rng = random.Random(5)
    rows = [("hot" if rng.random() < 0.4 else f"k{rng.randint(0, 50)}", i, rng.random()) for i in range(3000)]
    frame = spark.createDataFrame(rows, "k string, at int, v double").repartition(16)
    want = {}
    for k, at, v in rows:
        if k not in want or at < want[k][0]:
            want[k] = (at, v)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r["k"]: (r["at"], r["v"]) for r in records.first_of_each(frame, ["k"], ["at"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == want


def test_hot_identity_is_reduced_before_the_shuffle(spark):
    frame = spark.createDataFrame([("a", 1, 2.0)], "k string, at int, v double")
    plan = records.first_of_each(frame, ["k"], ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_min_by" in plan and "Window" not in plan


def test_incomplete_records(spark):
    rows = spark.createDataFrame([("a", "x"), ("b", None), ("c", "N/A"), (None, "x")], "url string, t string")
    assert [r["url"] for r in records.complete(rows, ["url", "t"]).collect()] == ["a"]
    lists = spark.createDataFrame([(["a"],), (["N/A"],), (None,), ([],)], "url array<string>")
    assert records.complete(lists, ["url"]).count() == 1


def test_not_indexed_needs_all_features_equal(spark):
    known = spark.createDataFrame([("a", ["t1"]), ("b", ["t2"])], "url string, t array<string>")
    rows = spark.createDataFrame([("a", ["t1"]), ("a", ["t2"]), ("c", ["t1"])], "url string, t array<string>")
    got = {(r["url"], r["t"][0]) for r in records.not_indexed(rows, known, ["url", "t"]).collect()}
    assert got == {("a", "t2"), ("c", "t1")}


def test_presence(spark):
    rows = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    known = spark.createDataFrame([(2,), (2,)], "k int")
    assert {r["k"]: r["present"] for r in records.presence(rows, known, ["k"]).collect()} == {1: False, 2: True, None: False}
    assert records.any_document(known, k=2) and not records.any_document(known, k=1)


def test_tolerant(spark):
    rows = spark.createDataFrame([("1", "x", "2020-02-30"), ("a", "y", "2020-02-28")], "n string, t string, d string")
    got = index.tolerant(rows, {"n": "int", "d": "date"})
    assert [tuple(map(str, r)) for r in got.orderBy("t").collect()] == [("1", "x", "None"), ("None", "y", "2020-02-28")]
