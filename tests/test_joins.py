import random

import pytest

from weblode.operators import joins, places, records


def skewed(spark, n=4000):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        p = rng.random()
        rows.append((i, "hot" if p < 0.35 else None if p < 0.6 else "gone" if p < 0.7 else f"k{rng.randint(0, 2000)}"))
    return rows


@pytest.mark.parametrize("share", [1000, 20, 2, 1])
def test_lookup_with_hot_and_missing_keys(spark, monkeypatch, share):
    monkeypatch.setattr(joins, "HOT_SHARE", share)
    rows = skewed(spark)
    table = {"hot": "H", **{f"k{i}": f"v{i}" for i in range(0, 2000, 2)}, "k4": None}
    left = spark.createDataFrame(rows, "id int, k string")
    known = spark.createDataFrame(list(table.items()), "k string, v string")
    got = {(r["id"], r["k"]): r["v"] for r in joins.looked_up(left, known, ["k"], "v").collect()}
    assert got == {(i, k): table.get(k) for i, k in rows}


def test_hot_keys_are_few(spark):
    rows = spark.createDataFrame(skewed(spark), "id int, k string")
    assert {r["k"] for r in joins.hot_keys(rows, ["k"]).collect()} >= {"hot", "gone"}
    assert joins.hot_keys(rows.select("id"), ["id"]).count() == 0


def test_hot_rows_do_not_meet_in_one_task(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        from pyspark.sql import functions as F

        rows = spark.createDataFrame([(i, "hot") for i in range(8000)], "id int, k string")
        known = spark.createDataFrame([("hot", 1)], "k string, v int")
        joined = joins.looked_up(rows, known, ["k"], "v")
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert len(sizes) == 8 and max(sizes) < 2500 and sum(sizes) == 8000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", aqe)


def test_not_indexed_with_a_hot_identity(spark):
    rows = [(k, i % 3) for i, k in skewed(spark, 500)]
    left = spark.createDataFrame(rows, "k string, n int").distinct()
    known = spark.createDataFrame([("hot", 1), ("gone", 2), ("k1", 0), ("hot", 1)], "k string, n int")
    got = records.not_indexed(left, known, ["k", "n"]).collect()
    assert len(got) == left.count() - left.join(known.distinct(), ["k", "n"]).count()


def test_places_beyond_the_broadcast_bound(spark, monkeypatch):
    cities = spark.createDataFrame([(9, "Oslo", "", "XX"), (2, "OSLO", "Oslo", "NO"), (3, "Rome", None, "IT")], "geonameid bigint, name string, subcountry string, country string")
    rows = spark.createDataFrame([(1, " oslo "), (2, "Rome"), (3, None), (4, "Atlantis")], "id int, place string")
    want = {1: "OSLO, Oslo, NO", 2: "Rome, IT", 3: None, 4: None}
    assert dict(places.locate(rows, "place", cities).collect()) == want
    monkeypatch.setattr(places, "BROADCAST_BYTES", 0)
    assert dict(places.locate(rows, "place", cities).collect()) == want
