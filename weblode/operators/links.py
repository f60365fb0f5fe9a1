"""Links: extraction, resolution, and the rules that decide which are followed and indexed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.config import Site
from weblode.functions import dom, urls
from weblode.functions.core import MOST_PATTERNS, any_rlike
from weblode.functions.dictionary import any_rule

# Fast path for markup known to be plain: double-quoted href on an <a> outside comments and scripts.
PLAIN_HREF = r'<a\s[^>]*?href="([^"]*)"'


def link_hrefs(nodes: Column) -> Column:
    """The href of every ``<a>`` in order, NULL where it has none."""
    return F.transform(F.filter(nodes, lambda n: n["tag"] == "a"), lambda n: n["attrs"]["href"])


def hrefs(pages: DataFrame, *keys: str, plain: bool = False) -> DataFrame:
    """(keys, position in page, href) of every ``<a>`` with a non-empty href.

    ``plain`` reads the markup with a regular expression instead of parsing it.
    """
    if plain:
        found = F.regexp_extract_all("html", F.lit(PLAIN_HREF), F.lit(1))
        found = F.transform(found, lambda h: F.replace(h, F.lit("&amp;"), F.lit("&")))
        source = pages
    else:
        source = dom.with_nodes(pages, tags=["a"])
        found = link_hrefs(F.col("nodes"))
    return source.select(*keys, F.posexplode(found).alias("pos", "href")).where(F.col("href") != "")


def same_site(url: Column, page_url: Column, strict_host: bool = False) -> Column:
    """The page's authority occurs anywhere in the link; strictly, it is the link's authority."""
    host = urls.netloc(page_url)
    return urls.netloc(url) == host if strict_host else F.contains(url, host)


def fits(url: Column, rules) -> Column:
    """True if any rule is found anywhere in the URL; many are looked up by the texts they require."""
    rules = list(rules)
    return any_rule(url, rules, lambda few: any_rlike(url, few)) if len(rules) > MOST_PATTERNS else any_rlike(url, rules)


def denied(url: Column, rules) -> Column:
    return fits(url, rules)


def permitted(url: Column, rules) -> Column:
    return fits(url, rules)


def valid_links(found: DataFrame, keep_parameters: bool, page_url: str = "src_url") -> DataFrame:
    """Add ``url``: the href resolved against its page, parameters dropped unless kept; invalid ones go."""
    url = urls.resolve(F.col("href"), F.col(page_url))
    absolute = found.select("*", url.alias("url"))
    if not keep_parameters:
        absolute = absolute.withColumn("url", urls.strip_parameters(F.col("url")))
    return absolute.where(urls.is_valid(F.col("url")))


def judged_links(found: DataFrame, site: Site, strict_host: bool = False) -> DataFrame:
    """(src_url, url, internal, permitted) of every valid link that is not denied; all narrow steps.

    ``found`` is (src_url, href). ``internal`` marks links of the page's own site. Deny rules come
    before permit rules, and a link that is not permitted is still followed.
    """
    url = F.col("url")
    return (
        valid_links(found.where(F.col("href") != ""), site.keep_parameters)
        .where(~denied(url, site.denied))
        .select(
            "src_url",
            "url",
            same_site(url, F.col("src_url"), strict_host).alias("internal"),
            permitted(url, site.permitted).alias("permitted"),
        )
    )


def link_table(pages: DataFrame, site: Site, strict_host: bool = False, plain: bool = False) -> DataFrame:
    """The judged links of stored pages (``url``, ``html``)."""
    found = hrefs(pages.select(F.col("url").alias("src_url"), "html"), "src_url", plain=plain)
    return judged_links(found, site, strict_host)


def new_links(links: DataFrame, visited: DataFrame) -> DataFrame:
    """Distinct link URLs that were not seen before."""
    return links.select("url").distinct().join(visited.select("url").distinct(), "url", "left_anti")


def permitted_urls(links: DataFrame) -> DataFrame:
    """Distinct URLs to index, with doubly escaped ampersands repaired."""
    return (
        links.where(F.col("internal") & F.col("permitted"))
        .select(urls.clean_entities(F.col("url")).alias("url"))
        .distinct()
    )
