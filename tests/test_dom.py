import json
import random

import pyarrow as pa
from pyspark.sql import functions as F

from weblode.config import Feature
from weblode.functions import dom, html_nodes
from weblode.operators import extract

PAGE = (
    '<!DOCTYPE html><html><head><title>T&amp;x</title><script>var a="</p>";</script></head>'
    '<body class=" a  b "><p>one<b>two<br>three</p>four<!-- c --><div/>x<i CLASS=q id=1>y</i></span> '
    "<pre>  </pre>\n\n<u a=1 a=2 a>z</u></body></html>tail"
)


def nodes_of(spark, html, **pruned):
    page = spark.createDataFrame([(1, html)], "page_id int, html string")
    return dom.explode_nodes(dom.with_nodes(page, **pruned), "page_id").orderBy("pos").collect()


def test_tree_rules(spark):
    nodes = nodes_of(spark, PAGE)
    by_tag = {n["tag"]: n for n in nodes if n["tag"]}
    assert [n["pos"] for n in nodes] == list(range(len(nodes)))
    assert nodes[0]["kind"] == "comment" and nodes[0]["text"] == "DOCTYPE html"
    assert by_tag["body"]["classes"] == ["a", "b"] and by_tag["i"]["classes"] == ["q"]
    assert by_tag["u"]["attrs"] == {"a": ""}
    # The unclosed <b> ends with its paragraph; void and self-closed elements hold nothing.
    assert by_tag["b"]["end_pos"] == by_tag["p"]["end_pos"]
    assert by_tag["br"]["end_pos"] == by_tag["br"]["pos"] and by_tag["div"]["end_pos"] == by_tag["div"]["pos"]
    source = lambda n: PAGE[n["start"] : n["stop"]]
    assert source(by_tag["p"]) == "<p>one<b>two<br>three</p>"
    assert source(by_tag["b"]) == "<b>two<br>three"
    assert source(by_tag["i"]) == "<i CLASS=q id=1>y</i>"
    assert source(by_tag["html"]).startswith("<html>") and source(by_tag["html"]).endswith("</html>")
    texts = [n["text"] for n in nodes if n["kind"] == "text"]
    assert texts == ["T&x", "one", "two", "three", "four", "x", "y", " ", "  ", "\n", "z", "tail"]
    assert [n["text"] for n in nodes if n["kind"] == "raw"] == ['var a="</p>";']


def test_text_and_markup(spark):
    page = spark.createDataFrame([(PAGE,)], "html string")
    parsed = dom.with_nodes(page)

    def first(tag):
        return F.get(dom.elements(F.col("nodes"), tag), F.lit(0))

    row = parsed.select(
        dom.text_of(F.col("nodes"), first("p")).alias("p"),
        dom.raw_text(F.col("nodes"), first("body")).alias("body"),
        dom.raw_text(F.col("nodes"), first("script")).alias("script"),
        dom.text_of(F.col("nodes"), first("h1")).alias("none"),
        dom.markup_of(F.col("html"), first("pre")).alias("pre"),
    ).first()
    assert row["p"] == "onetwothree" and row["body"] == "onetwothreefourxy   \nz"
    assert row["script"] == 'var a="</p>";' and row["none"] is None and row["pre"] == "<pre>  </pre>"


def test_pruning_changes_no_position_and_no_text(spark):
    full = {(n["pos"], n["end_pos"], n["tag"]) for n in nodes_of(spark, PAGE) if n["tag"] in ("i", "p")}
    pruned = nodes_of(spark, PAGE, tags=["i"], text_tags=["p"])
    assert {(n["pos"], n["end_pos"], n["tag"]) for n in pruned if n["tag"]} == full
    assert [n["text"] for n in pruned if n["kind"] == "text"] == ["one", "two", "three"]
    page = dom.with_nodes(spark.createDataFrame([(PAGE,)], "html string"), ["i"], ["p"])
    p = F.get(dom.elements(F.col("nodes"), "p"), F.lit(0))
    assert page.select(dom.text_of(F.col("nodes"), p)).first()[0] == "onetwothree"


def test_random_markup_nests_properly(spark):
    rng = random.Random(7)
    pieces = ["<p>", "</p>", "<b>", "</b>", "<div class=x>", "</div>", "<br>", "text", "<", "&amp;", "&", "<!-- c", "-->",
              "<li", ">", '"', "</", "<script>", "</script>", "\n", " ", "<a href='/q?a=1&b=2'>", "</a>", "é"]
    pages = [(i, "".join(rng.choice(pieces) for _ in range(rng.randint(0, 60)))) for i in range(400)]
    frame = dom.with_nodes(spark.createDataFrame(pages, "page_id int, html string"))
    rows = dom.explode_nodes(frame, "page_id").collect()
    by_page = {}
    for r in rows:
        by_page.setdefault(r["page_id"], []).append(r)
    html = dict(pages)
    for page_id, nodes in by_page.items():
        nodes.sort(key=lambda n: n["pos"])
        assert [n["pos"] for n in nodes] == list(range(len(nodes)))
        stack = []
        for n in nodes:
            while stack and stack[-1]["end_pos"] < n["pos"]:
                stack.pop()
            if stack:
                assert n["end_pos"] <= stack[-1]["end_pos"]
                assert stack[-1]["start"] <= n["start"] and n["stop"] <= stack[-1]["stop"]
            assert 0 <= n["start"] <= n["stop"] <= len(html[page_id])
            if n["tag"]:
                assert html[page_id][n["start"] : n["start"] + 1 + len(n["tag"])].lower() == "<" + n["tag"]
                stack.append(n)


def test_empty_and_missing_pages(spark):
    pages = spark.createDataFrame([(1, ""), (2, None), (3, "just text")], "page_id int, html string")
    sizes = dom.with_nodes(pages).select("page_id", F.size("nodes").alias("n")).orderBy("page_id").collect()
    assert [r["n"] for r in sizes] == [0, 0, 1]


def test_nodes_are_given_out_in_pieces():
    """A worker holds the nodes of a piece, not of a whole Arrow batch."""
    page = "<p>" + "<b>x</b>" * 5000 + "</p>"
    htmls = ([page, "", None, "<i>y</i>"] * 100) + [None] * 3000
    batches = [pa.array(htmls[:150]), pa.array([], pa.string()), pa.array(htmls[150:])]
    pieces = list(html_nodes.read_batches(iter(batches), None, None))
    assert max(len(piece.flatten()) for piece in pieces) < 30 * 10_001
    assert max(map(len, pieces)) <= html_nodes.PIECE_PAGES
    assert [len(nodes) for piece in pieces for nodes in piece] == [10_001, 0, 0, 2] * 100 + [0] * 3000


def test_class_matching(spark):
    html = '<a class="x y">1</a><a class="y x">2</a><a>3</a><a class="">4</a><b class="x">5</b>'
    page = dom.with_nodes(spark.createDataFrame([(html,)], "html string"))
    nodes = F.col("nodes")

    def texts(tag, css):
        found = F.transform(dom.elements(nodes, tag, css), lambda n: dom.raw_text(nodes, n))
        return page.select(F.array_join(found, "")).first()[0]

    assert texts("a", "x") == "12" and texts("a", "x y") == "1" and texts("a", "") == "34"
    assert texts("", "x") == "125" and texts("a", None) == "1234"


def test_json_path(apply):
    texts = ['{"c":1}', '{"a":{"c":2}}', "bad", '{"a":{"b":{"d":1}}}', None, '{"a":"c"}', "[1]"]
    got = apply(texts, lambda c: dom.json_path(F.try_parse_json(c), "a.b.c"))
    assert got == ["1", "2", None, '{"d":1}', None, "c", None]


def test_parsing_happens_once(spark):
    page = spark.createDataFrame([("u", "<p>x</p>")], "url string, html string")
    frame = dom.with_nodes(page).where(F.size("nodes") > 0).select("url", F.size("nodes"), F.element_at("nodes", 1))
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1


def test_entities_are_read_as_a_browser_would(spark):
    html = "<p>a&ampb &lt;i&gt &copy; &nosuch; &#233;&eacute</p><a href='/x?a=1&amp;b=2&amp;amp;c=3'>l</a>"
    nodes = nodes_of(spark, html)
    assert [n["text"] for n in nodes if n["kind"] == "text"] == ["a&b <i> © &nosuch; éé", "l"]
    assert [n["attrs"]["href"] for n in nodes if n["tag"] == "a"] == ["/x?a=1&b=2&amp;c=3"]


def plain_path(document, path):
    hit, current = False, document
    for segment in path.split("."):
        if isinstance(current, dict) and segment in current:
            hit, current = True, current[segment]
    return current if hit else None


def test_json_paths_walked_together(apply):
    pick = random.Random(3)
    names = ["a", "b", "c", "x y"]

    def tree(depth):
        if depth == 0 or pick.random() < 0.2:
            return pick.choice(["v", "", "7", None])
        return {n: tree(depth - 1) for n in names if pick.random() < 0.7}

    paths = sorted({".".join(pick.choices(names, k=pick.randint(1, 4))) for _ in range(40)}, key=lambda p: pick.random())
    paths += ["a", "a.b.c", "a.b"]
    documents = [tree(3) for _ in range(60)]
    got = apply([json.dumps(d) for d in documents], lambda c: dom.json_paths(F.try_parse_json(c), paths))

    def plain(document, path):
        found = plain_path(document, path)
        return json.dumps(found, separators=(",", ":")) if isinstance(found, dict) else found

    assert [[v and (json.dumps(json.loads(v), separators=(",", ":")) if v[0] == "{" else v) for v in row] for row in got] == [
        [plain(d, p) for p in paths] for d in documents
    ]


def test_json_of_all_features_is_parsed_once_per_element(spark):
    html = '<script>{"a": {"b": 1}}</script><script>{"a": {"c": "two"}, "d": ""}</script>'
    paths = {"b": "a.b", "c": "a.c", "none": "e.f", "d": "d", "again": "a.b"}
    features = [Feature(n, "script", property_value=p, metadata_format="json") for n, p in paths.items()]
    parsed = dom.with_nodes(spark.createDataFrame([(html,), (None,)], "html string"))
    pages, place = extract.with_json(parsed, features)
    read = [extract.feature_text(f, F.col("html"), F.col("nodes"), json=place(f)).alias(f.name) for f in features]
    got = pages.select(*read)
    alone = parsed.select(*[extract.feature_text(f, F.col("html"), F.col("nodes")).alias(f.name) for f in features])
    assert got.collect() == alone.collect()
    assert got.first().asDict() == {"b": "1", "c": '{"b":1}', "none": None, "d": None, "again": "1"}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1
