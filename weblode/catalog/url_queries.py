"""URL, link and frontier queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from weblode.catalog.registry import pages, query, table
from weblode.config import Site
from weblode.functions import urls
from weblode.operators import frontier, links
from weblode.session import stored, work_path

SCHEME = r"[A-Za-z][A-Za-z0-9+.\-]*"

DENIED = (r"/th", r"\d{3}")
PERMITTED = (r"^https?://[^/]+/[a-m]", r"[?&]id=\d+")

SITE = Site.parse(
    "corpus",
    {
        "seed": "",
        "permitted_urls_rules": list(PERMITTED),
        "denied_urls_rules": list(DENIED),
        "render_html": False,
        "keep_parameters": False,
        "keep_parameters_for_indexing": False,
        "page_counter": [],
        "start_page_counter_from": 1,
        "equal_crawled_features": ["url"],
        "decision_model": "corpus",
        "allArray": False,
        "csv_fields": [],
        "features": {},
    },
)


def sql_strip(url: str) -> str:
    return (
        f"(lower(regexp_extract({url}, '^({SCHEME}):', 1)) || '://' || "
        f"regexp_extract({url}, '^(?:{SCHEME}:)?//([^/?#]*)', 1) || "
        f"regexp_replace(regexp_extract({url}, '^(?:{SCHEME}:)?(?://[^/?#]*)?([^?#]*)', 1), ';[^/]*$', ''))"
    )


def sql_origin(url: str) -> str:
    return f"regexp_extract({url}, '^{SCHEME}://[^/?#]*')"


def sql_host(url: str) -> str:
    return f"regexp_extract({url}, '^{SCHEME}://([^/?#]*)', 1)"


def sql_any(url: str, rules) -> str:
    return "(" + " OR ".join(f"regexp_matches({url}, '{r}')" for r in rules) + ")"


SQL_HREFS = r"""
hrefs AS (
  SELECT page_id, url AS src_url, generate_subscripts(h, 1) - 1 AS pos, unnest(h) AS href
  FROM (SELECT page_id, url, regexp_extract_all(html, '<a\s[^>]*?href="([^"]*)"', 1) AS h FROM pages)
)"""

# Own links of every page, and a binary tree over the pages so that the graph has depth.
SQL_LINKS = f"""
{SQL_HREFS},
links AS (
  SELECT src_url, {sql_origin("src_url")} || href AS url FROM hrefs WHERE href <> ''
  UNION ALL
  SELECT a.url, b.url FROM pages a JOIN pages b ON b.page_id IN (2 * a.page_id + 1, 2 * a.page_id + 2)
)"""


def tree_edges(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    child = F.explode(F.array(2 * F.col("page_id") + 1, 2 * F.col("page_id") + 2))
    children = p.select(F.col("url").alias("src_url"), child.alias("page_id"))
    return children.join(p, "page_id").select("src_url", "url")


def all_links(spark, sf_dir):
    found = links.hrefs(pages(spark, sf_dir).select(F.col("url").alias("src_url"), "html"), "src_url")
    own = links.valid_links(found, keep_parameters=True).select("src_url", "url")
    return own.unionByName(tree_edges(spark, sf_dir))


@query(
    "u1_url_validity",
    rf"""
    SELECT page_id, candidate, regexp_matches(candidate, '^{SCHEME}://[^/?#]') AS valid
    FROM (SELECT page_id, unnest([url, regexp_replace(url, '^[a-z]+:', ''), 'mailto:a@' || {sql_host("url")},
                                  '/' || page_id, 'http:///' || page_id]) AS candidate FROM pages)
    """,
)
def url_validity(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    candidates = F.array(
        "url",
        F.regexp_replace("url", "^[a-z]+:", ""),
        F.concat(F.lit("mailto:a@"), urls.netloc(F.col("url"))),
        F.concat(F.lit("/"), "page_id"),
        F.concat(F.lit("http:///"), "page_id"),
    )
    found = p.select("page_id", F.explode(candidates).alias("candidate"))
    return found.select("page_id", "candidate", urls.is_valid(F.col("candidate")).alias("valid"))


@query(
    "u2_strip_params",
    rf"""
    SELECT page_id, {sql_strip("url")} AS stripped, {sql_strip("with_params")} AS stripped_params
    FROM (SELECT page_id, url, regexp_replace(url, '^([^?#]*)', '\1;v=1;w') AS with_params FROM pages)
    """,
)
def strip_params(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.regexp_replace("url", "^([^?#]*)", "$1;v=1;w").alias("with_params")
    )
    return p.select(
        "page_id",
        urls.strip_parameters(F.col("url")).alias("stripped"),
        urls.strip_parameters(F.col("with_params")).alias("stripped_params"),
    )


@query(
    "u3_link_extraction",
    f"WITH {SQL_HREFS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM hrefs WHERE href <> ''",
)
def link_extraction(spark, sf_dir):
    return links.hrefs(pages(spark, sf_dir), "page_id")


@query(
    "u3_link_extraction_plain",
    f"WITH {SQL_HREFS} SELECT page_id, CAST(pos AS INTEGER) AS pos, href FROM hrefs WHERE href <> ''",
)
def link_extraction_plain(spark, sf_dir):
    return links.hrefs(table(spark, sf_dir, "pages"), "page_id", plain=True)


@query(
    "u4_resolve",
    rf"""
    WITH {SQL_HREFS},
    b AS (SELECT page_id, pos, substr(href, 2) AS word, src_url,
                 {sql_origin("src_url")} AS origin,
                 regexp_extract(src_url, '^({SCHEME}):', 1) AS scheme,
                 regexp_extract(src_url, '^{SCHEME}://[^/?#]*([^?#]*)', 1) AS path
          FROM hrefs WHERE href <> ''),
    d AS (SELECT *, CASE WHEN path = '' THEN '/' ELSE regexp_extract(path, '^.*/') END AS folder FROM b)
    SELECT page_id, CAST(pos AS INTEGER) AS pos,
           origin || '/' || word AS rooted,
           origin || folder || word AS relative,
           origin || CASE WHEN folder = '/' THEN '/' ELSE regexp_replace(folder, '[^/]+/$', '') END || word AS upward,
           scheme || '://cdn.example/' || word AS other_host,
           origin || path || '?q=' || word AS query_only,
           regexp_replace(src_url, '#.*$', '') || '#' || word AS fragment_only,
           'ftp://h.example/' || word AS absolute
    FROM d
    """,
)
def resolve(spark, sf_dir):
    found = links.hrefs(pages(spark, sf_dir).select("page_id", "url", "html"), "page_id", "url")
    word = F.expr("substr(href, 2)")
    base = F.col("url")

    def to(prefix):
        return urls.resolve(F.concat(F.lit(prefix), word), base)

    return found.select(
        "page_id",
        "pos",
        urls.resolve(F.col("href"), base).alias("rooted"),
        to("").alias("relative"),
        to("../").alias("upward"),
        to("//cdn.example/").alias("other_host"),
        to("?q=").alias("query_only"),
        to("#").alias("fragment_only"),
        to("ftp://h.example/").alias("absolute"),
    )


@query(
    "u5_same_site",
    f"""
    WITH {SQL_LINKS}
    SELECT src_url, url, contains(url, {sql_host("src_url")}) AS same_site,
           {sql_host("url")} = {sql_host("src_url")} AS same_host
    FROM links
    """,
)
def same_site(spark, sf_dir):
    url, src = F.col("url"), F.col("src_url")
    return all_links(spark, sf_dir).select(
        "src_url",
        "url",
        links.same_site(url, src).alias("same_site"),
        links.same_site(url, src, strict_host=True).alias("same_host"),
    )


@query("u6_deny_rules", f"WITH {SQL_LINKS} SELECT src_url, url FROM links WHERE NOT {sql_any('url', DENIED)}")
def deny_rules(spark, sf_dir):
    return all_links(spark, sf_dir).where(~links.denied(F.col("url"), DENIED))


@query(
    "u6_many_rules",
    f"WITH {SQL_LINKS} SELECT src_url, url FROM links WHERE NOT regexp_matches(url, '/[a-z]{{2}}/[1-9][0-9][02468](?:[^0-9]|$)')",
)
def many_rules(spark, sf_dir):
    """A rule for each even page number of three digits."""
    rules = [rf"/[a-z]{{2}}/{n}(?:\D|$)" for n in range(100, 1000, 2)]
    return all_links(spark, sf_dir).where(~links.denied(F.col("url"), rules))


@query(
    "u7_permit_rules",
    f"WITH {SQL_LINKS} SELECT src_url, url, {sql_any('url', PERMITTED)} AS permitted FROM links",
)
def permit_rules(spark, sf_dir):
    found = all_links(spark, sf_dir)
    return found.select("src_url", "url", links.permitted(F.col("url"), PERMITTED).alias("permitted"))


@query(
    "u7_link_table",
    f"""
    WITH {SQL_HREFS},
    l AS (SELECT src_url, {sql_strip(f'({sql_origin("src_url")} || href)')} AS url FROM hrefs WHERE href <> '')
    SELECT src_url, url, contains(url, {sql_host("src_url")}) AS internal, {sql_any("url", PERMITTED)} AS permitted
    FROM l WHERE NOT {sql_any("url", DENIED)}
    """,
)
def link_table(spark, sf_dir):
    return links.link_table(pages(spark, sf_dir), SITE)


@query(
    "u8_entity_cleanup",
    f"""
    WITH {SQL_LINKS}
    SELECT DISTINCT replace(url, 'amp;', '') AS url
    FROM (SELECT src_url, url || '?a=1&amp;b=2' AS url FROM links)
    WHERE {sql_any("url", PERMITTED)} AND contains(url, {sql_host("src_url")})
    """,
)
def entity_cleanup(spark, sf_dir):
    url = F.col("url")
    doubled = all_links(spark, sf_dir).withColumn("url", F.concat("url", F.lit("?a=1&amp;b=2")))
    return links.permitted_urls(
        doubled.select(
            "url",
            links.same_site(url, F.col("src_url")).alias("internal"),
            links.permitted(url, PERMITTED).alias("permitted"),
        )
    )


@query(
    "u9_seen_urls",
    f"""
    WITH {SQL_LINKS}
    SELECT DISTINCT url FROM links
    WHERE url NOT IN (SELECT url FROM links WHERE src_url LIKE '%?%')
    """,
)
def seen_urls(spark, sf_dir):
    found = stored(all_links(spark, sf_dir), work_path(spark, "links"))
    return links.new_links(found, found.where(F.contains("src_url", F.lit("?"))))


SQL_WALK = f"""
{SQL_LINKS},
edges AS (SELECT DISTINCT src_url, url FROM links),
walk AS (
  SELECT url, 0 AS depth FROM pages WHERE page_id = 0
  UNION
  SELECT e.url, w.depth + 1 FROM walk w JOIN edges e ON e.src_url = w.url
),
reached AS (SELECT url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY url)"""


def walk_inputs(spark, sf_dir):
    edges = stored(all_links(spark, sf_dir), work_path(spark, "edges"))
    seeds = table(spark, sf_dir, "pages").where("page_id = 0").select("url")
    return edges, seeds


@query("u10_frontier", f"WITH RECURSIVE {SQL_WALK} SELECT url, depth FROM reached")
def frontier_walk(spark, sf_dir):
    return frontier.crawl_order(*walk_inputs(spark, sf_dir), max_visits=None).select("url", "depth")


@query(
    "u11_visit_budget",
    f"""
    WITH RECURSIVE {SQL_WALK},
    ranked AS (SELECT url, depth, row_number() OVER (ORDER BY depth, url) AS n FROM reached),
    budget AS (SELECT count(*) // 2 AS visits FROM pages)
    SELECT url, depth FROM ranked, budget WHERE n <= visits
    """,
)
def visit_budget(spark, sf_dir):
    budget = table(spark, sf_dir, "pages").count() // 2
    walked = frontier.crawl_order(*walk_inputs(spark, sf_dir), max_visits=budget)
    return walked.where("visited").select("url", "depth")


@query(
    "u12_counter_pages",
    """
    SELECT page_id AS template, CAST(k AS INTEGER) AS k, replace(url || '/list?page={counter}', '{counter}', CAST(k AS VARCHAR)) AS url
    FROM pages, (SELECT unnest(range(1, 21)) AS k)
    """,
)
def counter_pages(spark, sf_dir):
    templates = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("template"), F.concat("url", F.lit("/list?page={counter}")).alias("pattern")
    )
    return frontier.counter_pages(templates, 1, 20)


TEMPLATES = 5


def sql_counter_walk() -> str:
    """Orders as a listing: one template per priority, one page per day, customers as links."""
    ctes = [
        "links AS (SELECT CAST(substr(o_orderpriority, 1, 1) AS INTEGER) - 1 AS template, "
        "date_diff('day', TIMESTAMP '1995-01-01', o_orderdate) AS k, 'customer/' || o_custkey AS url FROM orders)"
    ]
    for t in range(TEMPLATES):
        before = " UNION ALL ".join(f"SELECT url FROM seen{i}" for i in range(t))
        unseen = f"AND url NOT IN ({before})" if t else ""
        ctes += [
            f"hit{t} AS (SELECT DISTINCT k FROM (SELECT url, min(k) AS k FROM links WHERE template = {t} AND k >= 0 {unseen} GROUP BY url))",
            f"stop{t} AS (SELECT CASE WHEN min(k) IS NULL OR min(k) > 8 THEN 8 ELSE min(k) FILTER (WHERE NOT followed) + 9 END AS k "
            f"FROM (SELECT k, coalesce(lead(k) OVER (ORDER BY k) - k <= 9, false) AS followed FROM hit{t}))",
            f"seen{t} AS (SELECT {t} AS template, k, url FROM links WHERE template = {t} AND k >= 0 AND k <= (SELECT k FROM stop{t}))",
        ]
    every = " UNION ALL ".join(f"SELECT * FROM seen{t}" for t in range(TEMPLATES))
    stops = " UNION ALL ".join(f"SELECT {t} AS template, k AS last_page FROM stop{t}" for t in range(TEMPLATES))
    return (
        f"WITH {', '.join(ctes)}, firsts AS (SELECT url, min((template, k)) AS found FROM ({every}) GROUP BY url), "
        f"stops AS ({stops}) "
        "SELECT CAST(found[1] AS INTEGER) AS template, CAST(found[2] AS BIGINT) AS k, url, CAST(last_page AS BIGINT) AS last_page "
        "FROM firsts JOIN stops ON stops.template = found[1]"
    )


@query("u13_counter_stop", sql_counter_walk())
def counter_stop(spark, sf_dir):
    listing = table(spark, sf_dir, "orders").select(
        (F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("template"),
        F.date_diff("o_orderdate", F.lit("1995-01-01").cast("date")).cast("bigint").alias("k"),
        F.concat(F.lit("customer/"), "o_custkey").alias("url"),
    )
    walked, stops = frontier.counter_walk(listing, TEMPLATES, 0)
    last = F.element_at(F.array(*[F.lit(s) for s in stops]), F.col("template") + 1)
    return walked.select("template", "k", "url", last.cast("bigint").alias("last_page"))


@query(
    "u14_crawl_summary",
    f"""
    WITH {SQL_LINKS},
    per_url AS (SELECT url, bool_or(contains(url, {sql_host("src_url")})) AS internal,
                       bool_or(contains(url, {sql_host("src_url")}) AND {sql_any("url", PERMITTED)}) AS permitted
                FROM links GROUP BY url)
    SELECT count(*) FILTER (WHERE internal) AS internal, count(*) FILTER (WHERE NOT internal) AS external,
           count(*) FILTER (WHERE permitted) AS permitted, count(*) AS total, CAST(999999 AS BIGINT) AS max_urls
    FROM per_url
    """,
)
def crawl_summary(spark, sf_dir):
    url = F.col("url")
    found = all_links(spark, sf_dir).select(
        "url",
        links.same_site(url, F.col("src_url")).alias("internal"),
        links.permitted(url, PERMITTED).alias("permitted"),
    )
    return frontier.crawl_summary(found, frontier.MAX_VISITS)
