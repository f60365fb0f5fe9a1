from itertools import product
from urllib.parse import urljoin, urlparse

from pyspark.sql import functions as F

from weblode.functions import urls as U
from weblode.operators import links

BASES = [
    "http://h.example/a/b/c.html", "https://h.example", "http://h.example/", "http://h.example/a/b/?q=1#f",
    "http://h.example:8080/x;p=1?y=2", "HTTP://H.example/Up/",
]
REFS = [
    "/p", "/p/../q", "p", "./p", "../p", "../../p", "../../../p", ".", "..", "?q=2", "#frag", "//cdn.example/x",
    "https://o.example/z?k#v", "mailto:a@h.example", "javascript:void(0)", "p/./q/../r", "/a//b", "x//y/../z", "p?x=/../y",
    " /lead", "/tab\tin", "g;x=1/../y", "http:/same", "ftp://f.example/a/../b", "?", "/.", "/a/b/..", "p#a?b",
]


def test_resolution_equals_the_standard_library(spark):
    pairs = list(product(BASES, REFS))
    rows = spark.createDataFrame(pairs, "base string, ref string")
    got = rows.select("base", "ref", U.resolve(F.col("ref"), F.col("base")).alias("url")).collect()
    wrong = [(r["base"], r["ref"], r["url"], urljoin(r["base"], r["ref"])) for r in got if r["url"] != urljoin(r["base"], r["ref"])]
    assert not wrong, wrong


def test_strip_and_validity_equal_the_standard_library(apply):
    texts = [urljoin(b, r) for b, r in product(BASES, REFS)] + ["nope", "http://", "//h/p", "x://y", "1a://b/c", ""]
    got = apply(texts, U.strip_parameters)

    def expected(url):
        p = urlparse(url)
        return f"{p.scheme}://{p.netloc}{p.path}"

    # Path parameters are split off only for some schemes by the library; none of these has any elsewhere.
    assert got == [expected(t) for t in texts]
    assert apply(texts, U.is_valid) == [bool(urlparse(t).netloc and urlparse(t).scheme) for t in texts]
    again = apply(got, U.strip_parameters)
    assert [a for a, t in zip(again, got) if urlparse(t).scheme] == [t for t in got if urlparse(t).scheme]


def test_same_site_is_a_substring(spark):
    rows = spark.createDataFrame(
        [("http://a.com/x", "http://b.com/?u=a.com"), ("http://a.com/x", "http://b.com/"), ("http://a.com/", "https://sub.a.com/")],
        "p string, u string",
    )
    flags = rows.select(
        links.same_site(F.col("u"), F.col("p")).alias("loose"),
        links.same_site(F.col("u"), F.col("p"), strict_host=True).alias("strict"),
    ).collect()
    assert [tuple(r) for r in flags] == [(True, False), (False, False), (True, False)]


def test_link_table_rules(spark):
    from weblode.catalog.url_queries import SITE
    from dataclasses import replace

    html = (
        '<body><a href="/m/1?x=1">one</a><a href="">none</a><a>no href</a><a href="/secret/2">two</a>'
        '<!-- <a href="/m/hidden">h</a> --><a HREF=\'/z/3\'>three</a><a href="http://other.example/m">far</a>'
        '<a href="mailto:x@site.example">mail</a></body>'
    )
    pages = spark.createDataFrame([("http://site.example/start", html)], "url string, html string")
    site = replace(SITE, denied=("secret",), permitted=("/m/",))
    got = {tuple(r)[1:] for r in links.link_table(pages, site).collect()}
    assert got == {
        ("http://site.example/m/1", True, True),
        ("http://site.example/z/3", True, False),
        ("http://other.example/m", False, False),
        ("mailto://x@site.example", True, False),
    }
    kept = links.link_table(pages, replace(site, keep_parameters=True))
    assert kept.where("url like '%x=1'").count() == 1


def test_entities_and_counters(apply):
    assert apply(["/a?x=1&amp;y=2", "amp;amp;"], U.clean_entities) == ["/a?x=1&y=2", ""]
    assert apply([3], lambda k: U.counter_url(F.lit("/p{counter}/{counter}"), k), "int") == ["/p3/3"]
