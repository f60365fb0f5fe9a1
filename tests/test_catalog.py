"""Every registered query against its SQL on the smallest supplied tables."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from weblode.catalog import load

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="supplied tables are not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for name in os.listdir(BASE):
        connection.execute(f"CREATE VIEW {name[:-8]} AS SELECT * FROM '{BASE}/{name}'")
    return connection


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(f"{r[i]:.9g}" if isinstance(r[i], float) else str(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(load()[0]))
def test_query_equals_sql(spark, db, name):
    frame = entry.queries()[name](spark, BASE)
    got = rows_of(frame.columns, frame.collect())
    result = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(frame.columns) == sorted(names)
    assert got == rows_of(names, result.fetchall())


def test_entry(spark):
    frame = entry.entry(spark)
    assert frame.columns == ["url", "title", "heading", "advert", "language", "collection", "item"]
    assert frame.count() > 0


def test_register_needs_no_session_and_workers_no_package(tmp_path):
    """Listing queries needs no session; running one needs the package on the driver only."""
    import subprocess
    import sys

    script = f"""
import importlib.util
spec = importlib.util.spec_from_file_location("contract", {os.path.abspath(entry.__file__)!r})
contract = importlib.util.module_from_spec(spec)
spec.loader.exec_module(contract)
assert set(contract.queries()) >= set(contract.oracle_sql())
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", contract.entry(spark).count())
"""
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "rows " in done.stdout, done.stderr[-2000:]


@pytest.mark.parametrize("name", ["u7_link_table", "d1_not_indexed", "d7_presence", "v6_category_votes", "h17_page_records", "c7_vocabulary"])
def test_plans_have_no_nested_loops(spark, name):
    plan = entry.queries()[name](spark, BASE)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


@pytest.fixture(scope="module")
def shared_addresses(spark, tmp_path_factory):
    """Every address three times: with a later page of the same heading, and with one of another heading."""
    from pyspark.sql import functions as F

    folder = str(tmp_path_factory.mktemp("shared-addresses"))
    pages = spark.read.parquet(f"{BASE}/pages.parquet")

    def variant(place, old, new):
        return pages.select((F.col("page_id") * 3 + place).alias("page_id"), "url", F.replace("html", F.lit(old), F.lit(new)).alias("html"))

    variants = [variant(0, "", ""), variant(1, '<div class="ad">', '<div class="ad">Later '), variant(2, "<h1>", "<h1>Other ")]
    variants[0].union(variants[1]).union(variants[2]).coalesce(1).write.parquet(f"{folder}/pages.parquet")
    return folder


@pytest.mark.parametrize("name", ["t1_stream_ingest", "t1_two_streams", "t2_stream_files"])
def test_streams_of_pages_that_share_addresses(spark, shared_addresses, name):
    frame = entry.queries()[name](spark, shared_addresses)
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{shared_addresses}/pages.parquet/*.parquet')")
    result = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, result.fetchall())
