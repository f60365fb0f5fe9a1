import json

import pytest

from weblode.config import Site
from weblode.operators.index import read_index
from weblode.plans.site import counter_of, index_site
from weblode.streaming.ingest import ingest_stream, read_page_stream

from tests.test_extract import SITE

HEADING = {"tag": "h1", "cssClass": "", "datatype": "string"}


def page(heading, *links):
    anchors = "".join(f'<a href="{link}">x</a>' for link in links)
    return f"<html><body><h1>{heading}</h1>{anchors}</body></html>"


CORPUS = [
    ("http://s.example/", page("home", "/study/1", "/list", "http://far.example/study/9")),
    ("http://s.example/list", page("list", "/study/2", "/study/3?x=1", "/deny/study/4", "/")),
    ("http://s.example/study/1", page("one", "/study/5")),
    ("http://s.example/study/2", page("two")),
    ("http://s.example/study/3", page("two")),
    ("http://s.example/study/5", "<html><h1>no body</h1></html>"),
    ("http://s.example/deny/study/4", page("four", "/study/6")),
    ("http://s.example/study/6", page("six")),
    ("http://s.example/study/7", page("not linked")),
]


def site(**changes):
    raw = {
        **SITE, "permitted_urls_rules": ["/study/"], "denied_urls_rules": ["/deny/"], "csv_fields": ["h", "url"],
        "features": {"h": HEADING}, **changes,
    }
    return Site.parse("s", raw)


def indexed(spark, path):
    return {(r["url"], r["h"]) for r in read_index(spark, path).select("url", "h").collect()}


def test_site_is_walked_and_indexed(spark, tmp_path):
    pages = spark.createDataFrame(CORPUS, "url string, html string")
    path, files = str(tmp_path / "index"), str(tmp_path / "files")
    summary = index_site(pages, site(), path, files, buckets=4).first().asDict()
    assert indexed(spark, path) == {("http://s.example/study/1", "one"), ("http://s.example/study/2", "two"), ("http://s.example/study/3", "two")}
    assert summary == {"internal": 6, "external": 1, "permitted": 4, "total": 7, "max_urls": None, "cut": False}
    lines = [json.loads(line) for p in (tmp_path / "files").rglob("*.json") for line in p.read_text().splitlines()]
    assert len(lines) == 3 and set(lines[0]) == {"url", "h"}
    # Nothing is new the second time.
    index_site(pages, site(), path, files, buckets=4)
    assert len(indexed(spark, path)) == 3
    lines = [line for p in (tmp_path / "files").rglob("*.json") for line in p.read_text().splitlines()]
    assert len(lines) == 3


def test_identity_by_feature(spark, tmp_path):
    pages = spark.createDataFrame(CORPUS, "url string, html string")
    path = str(tmp_path / "index")
    index_site(pages, site(equal_crawled_features=["h"]), path, buckets=4)
    assert indexed(spark, path) == {("http://s.example/study/1", "one"), ("http://s.example/study/2", "two")}


def test_last_record_of_a_url_is_indexed(spark, tmp_path):
    corpus = [
        ("http://s.example/", page("home", "/study/1")),
        ("http://s.example/study/1?v=1", page("first")),
        ("http://s.example/study/1?v=2", page("second")),
        ("http://s.example/study/1?v=3", page("second")),
    ]
    pages = spark.createDataFrame(corpus, "url string, html string")
    path, files = str(tmp_path / "index"), str(tmp_path / "files")
    index_site(pages, site(equal_crawled_features=["url", "h"]), path, files, buckets=2)
    rows = read_index(spark, path).collect()
    assert [r.asDict() for r in rows] == [{"url": "http://s.example/study/1", "h": "second"}]
    lines = [line for p in (tmp_path / "files").rglob("*.json") for line in p.read_text().splitlines()]
    assert len(lines) == 2


def test_seed_is_indexed_if_a_page_links_to_it(spark, tmp_path):
    pages = spark.createDataFrame(CORPUS, "url string, html string")
    path = str(tmp_path / "index")
    index_site(pages, site(permitted_urls_rules=["example/(list)?$"]), path, buckets=2)
    assert indexed(spark, path) == {("http://s.example/", "home"), ("http://s.example/list", "list")}
    index_site(pages, site(permitted_urls_rules=["example/(list)?$"]), str(tmp_path / "one"), max_visits=1, buckets=2)
    assert indexed(spark, str(tmp_path / "one")) == {("http://s.example/list", "list")}


def test_visit_budget_of_a_site(spark, tmp_path):
    pages = spark.createDataFrame(CORPUS, "url string, html string")
    path = str(tmp_path / "index")
    summary = index_site(pages, site(), path, max_visits=1, buckets=4).first()
    assert indexed(spark, path) == {("http://s.example/study/1", "one")}
    assert summary["cut"] and summary["max_urls"] == 1 and summary["internal"] == 2


def test_doubled_ampersands_in_stored_addresses(spark, tmp_path):
    corpus = [("http://s.example/", page("home", "/study/1?a=1&amp;amp;b=2")), ("http://s.example/study/1?a=1&amp;b=2", page("one"))]
    pages = spark.createDataFrame(corpus, "url string, html string")
    kept = site(keep_parameters=True, keep_parameters_for_indexing=True)
    index_site(pages, kept, str(tmp_path / "index"), buckets=2)
    assert len(indexed(spark, str(tmp_path / "index"))) == 1


def test_places_and_countries_are_never_passed_through(spark, tmp_path):
    pages = spark.createDataFrame([("http://s.example/", page("home", "/study/1")), ("http://s.example/study/1", page("in France today"))], "url string, html string")
    index_site(pages, site(features={"h": {**HEADING, "datatype": "country"}}), str(tmp_path / "a"), buckets=2)
    assert indexed(spark, str(tmp_path / "a")) == {("http://s.example/study/1", "France")}
    with pytest.raises(ValueError, match="gazetteer"):
        index_site(pages, site(features={"h": {**HEADING, "datatype": "location"}}), str(tmp_path / "b"), buckets=2)


def test_counter_site(spark, tmp_path):
    listing = [
        (f"http://s.example/list?page={k}", page(f"page {k}", f"/study/{k}", "/study/1")) for k in (1, 2, 11, 30)
    ]
    pages = spark.createDataFrame(
        CORPUS + listing + [("http://s.example/study/11", page("eleven")), ("http://s.example/study/30", page("thirty"))],
        "url string, html string",
    )
    path = str(tmp_path / "index")
    counted = site(page_counter=["http://s.example/list?page={counter}"], equal_crawled_features=["url", "h"])
    index_site(pages, counted, path, buckets=4)
    assert indexed(spark, path) == {("http://s.example/study/1", "one"), ("http://s.example/study/2", "two"), ("http://s.example/study/11", "eleven")}


def test_counter_of(apply):
    texts = ["http://h/p12/x12", "http://h/p12/x13", "http://h/p/x", "zhttp://h/p1/x1"]
    assert apply(texts, lambda c: counter_of(c, "http://h/p{counter}/x{counter}")) == [12, None, None, None]


def test_array_records_are_indexed_by_element(spark, tmp_path):
    pages = spark.createDataFrame(CORPUS, "url string, html string")
    path = str(tmp_path / "index")
    for _ in range(2):
        index_site(pages, site(allArray=True), path, buckets=4)
    rows = read_index(spark, path).collect()
    assert {(r["id"], r["h"][0]) for r in rows} == {("http://s.example/study/1", "one"), ("http://s.example/study/2", "two"), ("http://s.example/study/3", "two")}


def test_stream_equals_batch_and_survives_replay(spark, tmp_path):
    landing, path, files = str(tmp_path / "landing"), str(tmp_path / "index"), str(tmp_path / "files")
    pages = spark.createDataFrame(CORPUS, "url string, html string")

    def drain(checkpoint):
        stream = read_page_stream(spark, landing, pages.schema, files_per_batch=1)
        ingest_stream(stream, site(), path, str(tmp_path / checkpoint), files, buckets=4).awaitTermination()

    pages.repartition(3, "url").write.parquet(landing)
    drain("c1")
    want = {(u, h.split("<h1>")[1].split("</h1>")[0]) for u, h in CORPUS if "<body>" in h}
    assert indexed(spark, path) == want

    def saved():
        return sorted(line for p in (tmp_path / "files").rglob("*.json") for line in p.read_text().splitlines())

    first = saved()
    assert len(first) == len(want)
    # A lost checkpoint reads everything again: nothing is added or lost.
    drain("c2")
    assert indexed(spark, path) == want and saved() == first


def test_second_stream_adds_to_the_index(spark, tmp_path):
    path = str(tmp_path / "index")
    for name, corpus in (("a", CORPUS[:4]), ("b", CORPUS[4:5])):
        pages = spark.createDataFrame(corpus, "url string, html string")
        pages.write.parquet(str(tmp_path / name))
        stream = read_page_stream(spark, str(tmp_path / name), pages.schema)
        ingest_stream(stream, site(), path, str(tmp_path / f"checkpoint-{name}"), buckets=4).awaitTermination()
    assert {u for u, _ in indexed(spark, path)} == {u for u, _ in CORPUS[:5]}
