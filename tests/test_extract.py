import time

import pytest
from pyspark.sql import functions as F

from weblode.config import ConfigError, Feature, Site
from weblode.functions import dom
from weblode.operators import extract
from weblode.plans.records import page_records

PAGE = """<html><body>
<dl><dt>Price</dt><dd class="v" id="d1">EUR 1,200.50</dd><dt>Date</dt><dd class="v" data-x="9-8-2001">on 1-2-2003</dd>
<dt>Note</dt><dd class="v"><b>two
parts</b></dd></dl>
<p class="k">first <i lang="en">inner A</i></p><p class="k">second <i lang="fr">inner B</i></p>
<h1 data-n="5">Head..  line</h1>
<script type="application/ld+json">{"meta": {"name": "N &amp; M", "n": 7}}</script>
</body></html>"""


def value(spark, raw, page=PAGE, countries=(), as_array=False):
    feature = Feature.parse("f", {"cssClass": "", **raw})
    tags, texts = extract.needed_nodes([feature])
    frame = dom.with_nodes(spark.createDataFrame([(page,)], "html string"), tags, texts)
    column = extract.feature_value(feature, F.col("html"), F.col("nodes"), countries, as_array)
    return frame.select(column).first()[0]


def anchor(side, **spec):
    return {"searchKeywords": {side: {"tag": "", "cssClass": "", "propertyValue": "", "index": 1, **spec}}}


def test_single_match(spark):
    assert value(spark, {"tag": "h1", "datatype": "string"}) == "Head.line"
    assert value(spark, {"tag": "h1", "propertyValue": "data-n", "datatype": "int"}) == 5
    assert value(spark, {"tag": "h1", "propertyValue": "missing"}) is None
    assert value(spark, {"tag": "h1", "htmlAllowed": True}) == '<h1 data-n="5">Head..  line</h1>'
    assert value(spark, {"tag": "h2"}) is None
    # Two matches and no strategy: no value.
    assert value(spark, {"tag": "p", "cssClass": "k"}) is None


def test_single_match_skips_anchors(spark):
    raw = {"tag": "h1", "datatype": "string", **anchor("prefix", tag="dt", content=["nowhere"])}
    assert value(spark, raw) == "Head.line"


def test_prefix_anchor_is_nearest_then_tested(spark):
    raw = {"tag": "dd", "cssClass": "v", "datatype": "currency"}
    assert value(spark, {**raw, **anchor("prefix", tag="dt", content=["Price"])}) == 120050
    date = {"tag": "dd", "cssClass": "v", "datatype": "date", **anchor("prefix", tag="dt", content=["Nothing", "Date"])}
    assert value(spark, date) == "2003-2-1"
    note = {"tag": "dd", "cssClass": "v", "datatype": "other", **anchor("prefix", tag="dt", content=["Note"])}
    assert value(spark, note) == "two\nparts"


def test_postfix_anchor(spark):
    raw = {"tag": "dt", "datatype": "string", **anchor("postfix", tag="dd", cssClass="v", content=["2003"])}
    assert value(spark, raw) == "Date"


def test_infix_anchor(spark):
    raw = {"tag": "p", "cssClass": "k", "datatype": "string", **anchor("infix", tag="i", content=["B"])}
    assert value(spark, raw) == "second inner B"
    raw["htmlAllowed"] = True
    assert value(spark, raw) == '<p class="k">second <i lang="fr">inner B</i></p>'


def test_anchor_by_attribute(spark):
    by_lang = anchor("infix", tag="i", propertyValue="lang", content=["fr"])
    assert value(spark, {"tag": "p", "cssClass": "k", "datatype": "string", **by_lang}) == "second inner B"
    own = {"tag": "dd", "cssClass": "v", "datatype": "date", "propertyValue": "data-x"}
    nearest = anchor("prefix", tag="dd", cssClass="v", propertyValue="id", content=["d1"])
    # The second dd's nearest earlier dd has id d1; the value is its own attribute.
    assert value(spark, {**own, **nearest}) == "2001-8-9"
    # Content is looked for in the attribute, not in the element's source.
    assert value(spark, {**own, **anchor("prefix", tag="dd", cssClass="v", propertyValue="id", content=["EUR"])}) is None


def test_offset_moves_over_all_nodes(spark):
    page = "<body><b>x</b>one<u>1</u>two<u>2</u></body>"
    raw = {"tag": "u", "datatype": "other"}
    # index 3: one node back from the second <u> is the text "two"; from the first it is "one".
    assert value(spark, {**raw, **anchor("prefix", tag="b", content=["x"], index=3)}, page) == "one"
    assert value(spark, {**raw, **anchor("prefix", tag="u", content=["1"], index=3)}, page) == "two"
    assert value(spark, {**raw, **anchor("prefix", tag="b", content=["x"], index=2)}, page) == "1"
    # Forward by one from the first <u> is its own text; off the document there is nothing.
    assert value(spark, {**raw, **anchor("postfix", tag="u", content=["2"], index=3)}, page) == "1"
    assert value(spark, {**raw, **anchor("postfix", tag="u", content=["2"], index=30)}, page) is None


def test_json_applies_to_any_number_of_elements(spark):
    raw = {"tag": "script", "metadataFormat": "json", "propertyValue": "meta.name"}
    assert value(spark, raw) == "N &amp; M"
    assert value(spark, {**raw, "propertyValue": "meta.n", "datatype": "int"}) == 7
    twice = PAGE + '<script>{"x": 1}</script>'
    assert value(spark, {**raw, "propertyValue": "gone.meta.n"}, twice) == "7"
    assert value(spark, {**raw, "propertyValue": "x"}, twice) == "1"
    assert value(spark, {**raw, "propertyValue": "y"}, twice) is None


def test_strategy_order_is_per_element(spark):
    page = "<body><i>k</i><p>1</p><i>m</i><p>2<b>in</b></p><i>z</i></body>"
    raw = {"tag": "p", "datatype": "other"}
    keys = {
        "infix": {"tag": "b", "cssClass": "", "propertyValue": "", "content": ["in"]},
        "postfix": {"index": 1, "tag": "i", "cssClass": "", "propertyValue": "", "content": ["m"]},
    }
    # The first element's postfix comes before the second element's infix.
    assert value(spark, {**raw, "searchKeywords": keys}, page) == "1"


def test_static_and_array(spark):
    assert value(spark, {"staticValue": "fixed", "tag": "h1"}) == "fixed"
    assert value(spark, {"tag": "h1", "datatype": "string"}, as_array=True) == ["Head.line"]


def test_order_of_finishing(spark):
    raw = {"tag": "h1", "datatype": "string", "removal_patterns": ["Head"], "extraction_patterns": [r"\.(.*)e"]}
    assert value(spark, raw) == "lin"


SITE = {
    "seed": "http://s.example/", "permitted_urls_rules": [], "denied_urls_rules": [], "render_html": False,
    "keep_parameters": False, "keep_parameters_for_indexing": False, "page_counter": [], "start_page_counter_from": 1,
    "equal_crawled_features": ["url"], "decision_model": "m", "allArray": False, "csv_fields": [], "features": {},
}


def test_records_need_a_body(spark):
    site = Site.parse("s", {**SITE, "features": {"h": {"tag": "h1", "cssClass": "", "datatype": "string"}, "c": {"staticValue": "k"}}})
    pages = spark.createDataFrame(
        [("http://s.example/a?x=1#f", PAGE), ("http://s.example/b", "<html><h1>x</h1></html>"), ("http://s.example/c", None)],
        "url string, html string",
    )
    rows = page_records(pages, site).collect()
    assert [tuple(r) for r in rows] == [("http://s.example/a", "Head.line", "k")]
    assert page_records(pages, site).columns == ["url", "h", "c"]
    lists = Site.parse("s", {**SITE, "allArray": True, "features": {"h": {"tag": "h1", "cssClass": "", "datatype": "string"}}})
    assert page_records(pages, lists).first().asDict() == {"url": ["http://s.example/a"], "h": ["Head.line"]}


def test_location_feature_is_looked_up(spark):
    feature = {"tag": "h1", "cssClass": "", "datatype": "location", "extraction_patterns": ["in (.*)!"]}
    site = Site.parse("s", {**SITE, "features": {"where": feature}})
    pages = spark.createDataFrame(
        [("http://s.example/a", "<body><h1>in Oslo!</h1></body>"), ("http://s.example/b", "<body><h1>in Atlantis!</h1></body>")],
        "url string, html string",
    )
    cities = spark.createDataFrame([("NO", "oslo", "Oslo County", 5), ("XX", "Oslo", "", 9)], "country string, name string, subcountry string, geonameid bigint")
    got = dict(page_records(pages, site, gazetteer=cities).collect())
    assert got == {"http://s.example/a": "oslo, Oslo County, NO", "http://s.example/b": None}


def test_record_plan_has_no_shuffle(spark):
    site = Site.parse("s", {**SITE, "features": {"h": {"tag": "dd", "cssClass": "v", "datatype": "string", **anchor("prefix", tag="dt", content=["Note"])}}})
    pages = spark.createDataFrame([("http://s.example/a", PAGE)], "url string, html string")
    plan = page_records(pages, site)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1


def test_configuration_errors():
    with pytest.raises(ConfigError):
        Site.parse("s", {**SITE, "equal_crawled_features": []})
    with pytest.raises(ConfigError):
        Site.parse("s", {**SITE, "csv_fields": ["nothing"]})
    with pytest.raises(ConfigError):
        Site.parse("s", {k: v for k, v in SITE.items() if k != "seed"})


def test_many_elements_find_their_anchors_in_line_with_their_number(spark):
    """Each value follows its label; only the last label holds what is looked for."""
    raw = {
        "tag": "dd", "cssClass": "", "datatype": "string", "propertyValue": "", "htmlAllowed": False,
        "searchKeywords": {"prefix": {"index": 0, "tag": "dt", "cssClass": "", "propertyValue": "", "content": ["wanted"]}},
    }

    def seconds(n):
        items = "".join(f"<dt>{'wanted' if i == n - 1 else 'no'}</dt><dd>v{i}</dd>" for i in range(n))
        started = time.time()
        assert value(spark, raw, page=f"<html><body>{items}</body></html>") == f"v{n - 1}"
        return time.time() - started

    seconds(10)
    # Four times as many: quadratic work would take sixteen times as long.
    assert seconds(8000) < 9 * max(seconds(2000), 1)
