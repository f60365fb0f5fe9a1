"""Document-node and extraction queries."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from weblode.catalog.registry import pages, query, table
from weblode.catalog.url_queries import sql_strip
from weblode.config import Anchor, Feature, Site
from weblode.functions import dom
from weblode.operators import extract, records
from weblode.plans.records import page_records


def sql_unescape(text: str) -> str:
    """These entities also count without their semicolon, as at the end of a text that was cut."""
    for entity, char in (("quot", '"'), ("middot", "·"), ("copy", "©"), ("lt", "<"), ("gt", ">"), ("amp", "&")):
        text = f"regexp_replace({text}, '&{entity};?', '{char}', 'g')"
    return text


def sql_text(html: str, opening: str, closing: str) -> str:
    """Text of a simple element, NULL if it is absent."""
    return sql_unescape(f"nullif(regexp_extract({html}, '(?s){opening}([^<]*){closing}', 1), '')")


# The navigation entries of a page in order, as source and as text.
SQL_ITEMS = r"""
m AS (SELECT page_id, regexp_extract_all(html, '<li><a [^>]*>[^<]*</a></li>') AS li FROM pages),
items AS (
  SELECT page_id, generate_subscripts(li, 1) AS i, unnest(li) AS li FROM m
),
parts AS (
  SELECT page_id, i, li, regexp_extract(li, '<a .*</a>') AS a,
         replace(regexp_extract(li, '>([^<]*)</a>', 1), '&amp;', '&') AS text
  FROM items
)"""


def node_pages(spark, sf_dir, *tags, texts=()):
    source = pages(spark, sf_dir)
    return dom.with_nodes(source, tags, texts) if tags or texts else dom.with_nodes(source)


def feature_query(spark, sf_dir, feature: Feature):
    """page_id and the feature's text."""
    tags, texts = extract.needed_nodes([feature])
    parsed = dom.with_nodes(pages(spark, sf_dir), tags, texts)
    return parsed.select("page_id", extract.feature_text(feature, F.col("html"), F.col("nodes")).alias("value"))


@query(
    "h1_nodes_per_tag",
    """
    SELECT page_id, tag, count(*) AS n
    FROM (SELECT page_id, unnest(regexp_extract_all(html, '<([a-z][a-z0-9]*)', 1)) AS tag FROM pages)
    GROUP BY page_id, tag
    """,
)
def nodes_per_tag(spark, sf_dir):
    flat = dom.explode_nodes(node_pages(spark, sf_dir), "page_id")
    return flat.where("kind = 'element'").groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query(
    "h1_document_text",
    f"""
    SELECT page_id, {sql_unescape("regexp_replace(regexp_replace(regexp_replace(html, '(?s)<!--.*?-->', '', 'g'), '(?s)<(script|style)>.*?</(script|style)>', '', 'g'), '<[^>]*>', '', 'g')")} AS text
    FROM pages
    """,
)
def document_text(spark, sf_dir):
    flat = dom.with_nodes(pages(spark, sf_dir), ["html"], ["html"])
    root = F.get(dom.elements(F.col("nodes"), "html"), F.lit(0))
    return flat.select("page_id", dom.raw_text(F.col("nodes"), root).alias("text"))


@query("h2_titles", f"SELECT page_id, {sql_text('html', '<title>', '</title>')} AS titles FROM pages")
def titles(spark, sf_dir):
    return node_pages(spark, sf_dir, texts=["title"]).select(
        "page_id", F.array_join(extract.titles(F.col("nodes")), "\n").alias("titles")
    )


@query(
    "h3_body_filter",
    """
    SELECT page_id, url FROM (
      SELECT page_id, url, CASE WHEN url LIKE '%?%' THEN replace(html, '<body>', '') ELSE html END AS html FROM pages)
    WHERE contains(html, '<body>')
    """,
)
def body_filter(spark, sf_dir):
    bodiless = F.when(F.contains("url", F.lit("?")), F.replace("html", F.lit("<body>"), F.lit("")))
    source = pages(spark, sf_dir).withColumn("html", F.coalesce(bodiless, F.col("html")))
    return dom.with_nodes(source, ["body"]).where(extract.has_body(F.col("nodes"))).select("page_id", "url")


@query(
    "h4_tag_stripping",
    f"""
    WITH p AS (SELECT page_id, replace(replace(html, '. ', '.' || chr(10) || chr(10)), '<footer>', '<footer>' || chr(10)) AS html FROM pages)
    SELECT page_id,
           trim(regexp_replace({sql_text("html", "<footer>", "</footer>")}, '\\n+', chr(10), 'g'), chr(10)) AS footer,
           trim(regexp_replace({sql_text("html", "<h1>", "</h1>")}, '\\n+', chr(10), 'g'), chr(10)) AS heading
    FROM p
    """,
)
def tag_stripping(spark, sf_dir):
    broken = F.replace(F.col("html"), F.lit(". "), F.lit(".\n\n"))
    broken = F.replace(broken, F.lit("<footer>"), F.lit("<footer>\n"))
    parsed = dom.with_nodes(pages(spark, sf_dir).withColumn("html", broken), [], ["footer", "h1"])

    def first(tag):
        return dom.text_of(F.col("nodes"), F.get(dom.elements(F.col("nodes"), tag), F.lit(0)))

    return parsed.select("page_id", first("footer").alias("footer"), first("h1").alias("heading"))


@query(
    "h5_select",
    f"""
    WITH {SQL_ITEMS}
    SELECT page_id, 'a' AS selector, text FROM parts
    UNION ALL
    SELECT page_id, 'div.ad' AS selector, {sql_text('html', '<div class="ad">', '</div>')} AS text FROM pages
    """,
)
def select_elements(spark, sf_dir):
    parsed = node_pages(spark, sf_dir, texts=["a", "div"])
    return extract.elements_table(parsed, [("a", ""), ("div", "ad")], "page_id").select("page_id", "selector", "text")


@query(
    "h6_single_match",
    f"""
    WITH {SQL_ITEMS},
    n AS (SELECT page_id, count(*) AS items, min(text) AS sole FROM parts GROUP BY page_id)
    SELECT page_id, {sql_text("html", "<h1>", "</h1>")} AS heading, CASE WHEN items = 1 THEN sole END AS item
    FROM pages LEFT JOIN n USING (page_id)
    """,
)
def single_match(spark, sf_dir):
    parsed = node_pages(spark, sf_dir, texts=["h1", "li"])
    heading, item = Feature("heading", "h1"), Feature("item", "li")
    return parsed.select(
        "page_id",
        extract.feature_text(heading, F.col("html"), F.col("nodes")).alias("heading"),
        extract.feature_text(item, F.col("html"), F.col("nodes")).alias("item"),
    )


@query(
    "h7_attribute",
    """
    SELECT page_id, nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS lang,
           nullif(regexp_extract(html, '<meta charset="([^"]*)"', 1), '') AS charset, CAST(NULL AS VARCHAR) AS missing
    FROM pages
    """,
)
def attribute(spark, sf_dir):
    parsed = node_pages(spark, sf_dir, "html", "meta")
    wanted = [
        Feature("lang", "html", property_value="lang"),
        Feature("charset", "meta", property_value="charset"),
        Feature("missing", "meta", property_value="id"),
    ]
    return parsed.select("page_id", *[extract.feature_text(f, F.col("html"), F.col("nodes")).alias(f.name) for f in wanted])


@query(
    "h8_html_passthrough",
    """
    SELECT page_id, regexp_extract(html, '(?s)<div class="ad">.*?</div>') AS ad, regexp_extract(html, '(?s)<h1>.*?</h1>') AS heading,
           regexp_extract(html, '(?s)<nav>.*?</nav>') AS navigation
    FROM pages
    """,
)
def html_passthrough(spark, sf_dir):
    parsed = node_pages(spark, sf_dir, "div", "h1", "nav")
    wanted = [
        Feature("ad", "div", "ad", html_allowed=True),
        Feature("heading", "h1", html_allowed=True),
        Feature("navigation", "nav", html_allowed=True),
    ]
    return parsed.select("page_id", *[extract.feature_text(f, F.col("html"), F.col("nodes")).alias(f.name) for f in wanted])


def event_pages(spark, sf_dir):
    """Every event as a page with its properties embedded as JSON."""
    html = F.concat(
        F.lit('<html><body><script type="application/ld+json">{"event": {"props": '),
        "props",
        F.lit(', "type": "<b>'),
        "event_type",
        F.lit('</b>"}}</script><p>not json</p></body></html>'),
    )
    return dom.with_nodes(table(spark, sf_dir, "events").select("event_id", html.alias("html")), ["script", "p"])


@query(
    "h9_embedded_json",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS k, ' ' || event_type || ' ' AS type, false AS text_is_json
    FROM events
    """,
)
def embedded_json(spark, sf_dir):
    parsed = event_pages(spark, sf_dir)
    script, other = (F.get(dom.elements(F.col("nodes"), t), F.lit(0)) for t in ("script", "p"))
    document = dom.embedded_json(F.col("html"), script)
    return parsed.select(
        "event_id",
        F.try_variant_get(document, "$.event.props.k", "string").alias("k"),
        F.try_variant_get(document, "$.event.type", "string").alias("type"),
        dom.embedded_json(F.col("html"), other).isNotNull().alias("text_is_json"),
    )


@query(
    "h10_json_path",
    """
    SELECT event_id, json_extract_string(props, '$.k') AS full_path, json_extract_string(props, '$.k') AS with_gaps,
           CAST(NULL AS VARCHAR) AS absent
    FROM events
    """,
)
def json_path(spark, sf_dir):
    paths = {"full_path": "event.props.k", "with_gaps": "nothing.event.here.props.k", "absent": "nothing.here"}
    wanted = [Feature(name, "script", property_value=path, metadata_format="json") for name, path in paths.items()]
    pages, json = extract.with_json(event_pages(spark, sf_dir), wanted)
    read = [extract.feature_text(f, F.col("html"), F.col("nodes"), json=json(f)).alias(f.name) for f in wanted]
    return pages.select("event_id", *read)


def first_item(condition: str, value: str = "text") -> str:
    return f"""
    WITH {SQL_ITEMS},
    near AS (SELECT *, lag(a) OVER w AS prev_a, lead(li) OVER w AS next_li, lag(text) OVER w AS prev_text
             FROM parts WINDOW w AS (PARTITION BY page_id ORDER BY i)),
    hits AS (SELECT page_id, min_by({value}, i) AS value FROM near WHERE {condition} GROUP BY page_id)
    SELECT page_id, value FROM pages LEFT JOIN hits USING (page_id)
    """


ITEM = Feature("item", "li")
LINK = Feature("link", "a")


@query("h11_infix_anchor", first_item("contains(a, 'th')"))
def infix_anchor(spark, sf_dir):
    return feature_query(spark, sf_dir, replace(ITEM, infix=Anchor("a", content=("th",))))


@query("h12_prefix_anchor", first_item("contains(prev_a, 'th')"))
def prefix_anchor(spark, sf_dir):
    return feature_query(spark, sf_dir, replace(ITEM, prefix=Anchor("a", content=("th",))))


@query("h13_postfix_anchor", first_item("contains(next_li, 'on') OR contains(next_li, 'er')"))
def postfix_anchor(spark, sf_dir):
    return feature_query(spark, sf_dir, replace(LINK, postfix=Anchor("li", content=("on", "er"))))


@query("h14_anchor_offset", first_item("contains(prev_a, 'th')", "prev_text"))
def anchor_offset(spark, sf_dir):
    return feature_query(spark, sf_dir, replace(LINK, prefix=Anchor("a", content=("th",), index=4)))


@query(
    "h15_precedence",
    first_item("contains(a, 'zz') OR contains(prev_a, 'ea') OR contains(next_li, 'ti')"),
)
def precedence(spark, sf_dir):
    feature = replace(
        ITEM,
        infix=Anchor("a", content=("zz",)),
        prefix=Anchor("a", content=("ea",)),
        postfix=Anchor("li", content=("ti",)),
    )
    return feature_query(spark, sf_dir, feature)


@query("h16_static_value", "SELECT page_id, 'archive' AS collection FROM pages")
def static_value(spark, sf_dir):
    feature = Feature("collection", static_value="archive")
    return pages(spark, sf_dir).select(
        "page_id", extract.feature_value(feature, F.col("html"), F.lit(None)).alias("collection")
    )


RECORD = Site.parse(
    "corpus",
    {
        "seed": "",
        "permitted_urls_rules": [],
        "denied_urls_rules": [],
        "render_html": False,
        "keep_parameters": False,
        "keep_parameters_for_indexing": False,
        "page_counter": [],
        "start_page_counter_from": 1,
        "equal_crawled_features": ["url", "heading"],
        "decision_model": "articles",
        "allArray": False,
        "csv_fields": ["url", "heading"],
        "features": {
            "title": {"tag": "title", "cssClass": "", "datatype": "string"},
            "heading": {"tag": "h1", "cssClass": "", "datatype": "string"},
            "advert": {"tag": "div", "cssClass": "ad", "datatype": "string", "removal_patterns": ["The "]},
            "language": {"tag": "html", "cssClass": "", "propertyValue": "lang", "datatype": "char"},
            "collection": {"staticValue": "archive"},
            "item": {
                "tag": "li",
                "cssClass": "",
                "datatype": "char",
                "searchKeywords": {"prefix": {"index": 1, "tag": "a", "cssClass": "", "content": ["th"]}},
            },
        },
    },
)


def sql_normal(text: str) -> str:
    return (
        f"replace(replace(replace(replace(replace({text}, chr(10), ' '), chr(13), ''), chr(9), ''), '  ', ''), '..', '.')"
    )


def sql_records(url: str) -> str:
    return f"""
WITH {SQL_ITEMS},
near AS (SELECT *, lag(a) OVER (PARTITION BY page_id ORDER BY i) AS prev_a FROM parts),
hits AS (SELECT page_id, min_by(text, i) AS item FROM near WHERE contains(prev_a, 'th') GROUP BY page_id),
records AS (
  SELECT page_id, {url} AS url,
         {sql_normal(sql_text("html", "<title>", "</title>"))} AS title,
         {sql_normal(sql_text("html", "<h1>", "</h1>"))} AS heading,
         replace({sql_normal(sql_text("html", '<div class="ad">', "</div>"))}, 'The ', '') AS advert,
         nullif(regexp_extract(html, '<html lang="([^"]*)"', 1), '') AS language,
         'archive' AS collection,
         {sql_normal("item")} AS item
  FROM pages LEFT JOIN hits USING (page_id)),
kept AS (
  SELECT * FROM records WHERE url IS NOT NULL AND heading IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY url, heading ORDER BY page_id) = 1)
SELECT url, title, heading, advert, language, collection, item FROM kept
"""


SQL_RECORDS = sql_records(sql_strip("url"))


@query("h17_page_records", SQL_RECORDS)
def page_record_table(spark, sf_dir):
    extracted = page_records(pages(spark, sf_dir), RECORD, keep=["page_id"])
    whole = records.complete(extracted, RECORD.identity)
    return records.first_of_each(whole, RECORD.identity, ["page_id"]).drop("page_id")
