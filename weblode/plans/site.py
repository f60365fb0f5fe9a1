"""A whole site: walk the stored pages, extract the permitted ones, index the new records."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.config import MISSING, Site
from weblode.functions import urls
from weblode.operators import frontier, links, records
from weblode.operators.index import REPLACES, new_or_earlier, not_in_index, read_state, upsert
from weblode.operators.joins import hot_keys, looked_up
from weblode.plans.records import HREFS, read_features, to_records
from weblode.session import stored, work_path
from weblode.sources.writers import write_csv, write_json


def counter_of(url: Column, template: str) -> Column:
    """The page number if the URL is the template with a number put in, else NULL."""
    parts = [re.escape(p) for p in template.split("{counter}")]
    shape = "^" + parts[0] + "".join((r"(\d+)" if i == 0 else r"\d+") + p for i, p in enumerate(parts[1:])) + "$"
    number = F.regexp_extract(url, shape, 1)
    same = urls.counter_url(F.lit(template), number) == url
    return F.when(same, number.try_cast("bigint"))


def counter_links(found: DataFrame, site: Site) -> DataFrame:
    """(template, k, url) of the same-site links on counter pages."""
    hits = F.array(
        *[
            F.struct(F.lit(i).alias("template"), counter_of(F.col("src_url"), t).alias("k"))
            for i, t in enumerate(site.page_counter)
        ]
    )
    numbered = found.where("internal").select("url", F.explode(hits).alias("at"))
    return numbered.where(F.col("at.k").isNotNull()).select("at.template", "at.k", "url")


def walk_address(url: Column, site: Site) -> Column:
    """The URL under which the walk knows a page."""
    return url if site.keep_parameters else urls.strip_parameters(url)


def discovered(found: DataFrame, site: Site, max_visits: int | None) -> tuple[DataFrame, DataFrame, bool]:
    """(url, found_at) of the permitted pages the walk comes across; the links of the pages it visits; whether it was cut."""
    spark = found.sparkSession
    if site.page_counter:
        numbered = stored(counter_links(found, site), work_path(spark, "counter"))
        walked, stops = frontier.counter_walk(numbered, len(site.page_counter), site.start_counter)
        reached = walked.select("url", F.struct("template", "k").alias("found_at"))
        on_page = [
            (k := counter_of(F.col("src_url"), template)).isNotNull() & k.between(site.start_counter, stop)
            for template, stop in zip(site.page_counter, stops)
        ]
        visited_links, cut = found.where(reduce(lambda a, b: a | b, on_page)), False
    else:
        # The same link stands on a page many times; the walk reads each edge once per level.
        edges = found.where("internal").select(walk_address(F.col("src_url"), site).alias("src_url"), "url").distinct()
        edges = stored(edges, work_path(spark, "edges"))
        seed = spark.range(1).select(walk_address(F.lit(site.seed), site).alias("url")).first()["url"]
        walked = frontier.crawl_order(edges, spark.createDataFrame([(seed,)], "url string"), max_visits)
        reached = walked.where("depth > 0").select("url", "depth").unionByName(linked_seed(edges, walked, seed))
        reached = reached.select("url", F.struct(F.lit(0).alias("template"), F.col("depth").alias("k")).alias("found_at"))
        visited = walked.where("visited").select(F.col("url").alias("_visited"))
        visited_links = found.join(visited, walk_address(F.col("src_url"), site) == F.col("_visited"), "left_semi")
        cut = max_visits is not None and not walked.where("not visited").isEmpty()
    allowed = reached.where(links.permitted(F.col("url"), site.permitted))
    pages = allowed.groupBy(urls.clean_entities(F.col("url")).alias("url")).agg(F.min("found_at").alias("found_at"))
    return pages, visited_links, cut


def linked_seed(edges: DataFrame, walked: DataFrame, seed: str) -> DataFrame:
    """(url, depth) of the seed if visited pages link back to it: such a link is as new as any other.

    The seed is the most linked page of a site, and one literal: its links are filtered, not joined by it.
    """
    sources = walked.where("visited").select(F.col("url").alias("src_url"), "depth")
    back = edges.where(F.col("url") == seed).join(sources, "src_url")
    depth = back.agg((F.min("depth") + 1).cast("int").alias("depth"))
    return depth.where("depth is not null").select(F.lit(seed).alias("url"), "depth")


def index_site(
    pages: DataFrame,
    site: Site,
    index_path: str,
    files_path: str | None = None,
    countries: Sequence[tuple[str, str]] = (),
    gazetteer: DataFrame | None = None,
    max_visits: int | None = None,
    buckets: int = 64,
    strict_host: bool = False,
) -> DataFrame:
    """Run the site's configuration over stored pages (``url``, ``html``) and index what is new.

    Returns the crawl summary of the pages visited: the whole site, unless ``max_visits`` cuts the walk, which the
    summary's ``cut`` tells. With ``strict_host`` only links to a page's own host count as internal.
    """
    spark = pages.sparkSession
    # Links are cleaned of doubled ampersands before they are looked up, so the stored addresses are too.
    page_url = urls.clean_entities(walk_address(F.col("url"), site))
    keyed = pages.select(F.col("url").alias("src_url"), page_url.alias("page_url"), "url", "html")
    # Each page is parsed once, for its links and its features; markup goes no further than this table.
    read = read_features(keyed, site, countries, keep=["src_url", "page_url"], with_links=True)
    read = stored(read, work_path(spark, "pages"))
    hrefs = read.select("src_url", F.explode(HREFS).alias("href"))
    found = stored(links.judged_links(hrefs, site, strict_host), work_path(spark, "links"))
    targets, visited_links, cut = discovered(found, site, max_visits)
    # One URL may stand for many pages once its parameters are dropped.
    hot = hot_keys(read.select("page_url"), ["page_url"])
    reached = looked_up(
        read.drop(HREFS), targets.withColumnRenamed("url", "page_url"), ["page_url"], "found_at", hot
    )
    wanted = to_records(reached.where(F.col("found_at").isNotNull()).drop("page_url"), site, gazetteer)
    arrival = ["found_at", "src_url"]
    fresh = stored(new_records(wanted, site, index_path, arrival), work_path(spark, "records"))
    # The files of a run bear the number of the index it starts from: a run that is repeated after a failure
    # between the two steps overwrites what it wrote.
    save_files(fresh.drop(*arrival), site, files_path, f"run-{read_state(spark, index_path).version}")
    upsert_records(fresh, site, index_path, arrival, buckets)
    return frontier.crawl_summary(visited_links, max_visits).withColumn("cut", F.lit(cut))


def new_records(
    extracted: DataFrame, site: Site, index_path: str, arrival: Sequence[str], by_identity: bool = False
) -> DataFrame:
    """Complete records, the first of each identity, that the index does not hold yet.

    ``by_identity`` is for an index whose documents stand under their identity: records that arrived before the document
    of their identity are given too, marked by ``REPLACES``.
    """
    whole = records.complete(extracted, site.identity)
    first = records.first_of_each(whole, site.identity, arrival)
    if by_identity:
        return new_or_earlier(index_path, with_identity(first, site), "id", arrival).drop("id")
    keyed = with_id(first, site)
    return not_in_index(index_path, keyed, looked_up_by(site), document_key(site)).select(*first.columns)


def document_key(site: Site) -> str:
    return "id" if site.all_array else "url"


def looked_up_by(site: Site) -> list[str]:
    """The features by which a record is looked up in the index: the document's id where the URL alone identifies it."""
    return [document_key(site)] if set(site.identity) == {"url"} else list(site.identity)


def with_id(found: DataFrame, site: Site) -> DataFrame:
    """Records whose features are arrays get the URL as their id."""
    return found.withColumn("id", records.scalar(found, "url")) if site.all_array else found


def with_identity(found: DataFrame, site: Site) -> DataFrame:
    """Records with all their identity features as the id."""
    return found.withColumn("id", F.to_json(F.struct(*[records.scalar(found, c).alias(c) for c in site.identity])))


def save_files(fresh: DataFrame, site: Site, files_path: str | None, run: str) -> None:
    """Record files of one run or batch; written again, they replace what it wrote before."""
    if files_path:
        model = site.decision_model
        write_json(fresh, f"{files_path}/{model}", run, MISSING, "overwrite")
        write_csv(fresh, f"{files_path}/{model}.csv/{run}", site.csv_fields, MISSING, "overwrite")


def upsert_records(
    fresh: DataFrame,
    site: Site,
    index_path: str,
    arrival: Sequence[str] = (),
    buckets: int = 64,
    batch: str | None = None,
    by_identity: bool = False,
) -> None:
    """Put new records into the index by URL; ``arrival`` columns order them and are not indexed.

    Records that differ in another identity feature may share a URL; the last to arrive is indexed. With ``by_identity`` each
    has a document of its own, and the ``arrival`` columns are indexed, for later batches to be compared with.
    """
    if by_identity:
        upsert(index_path, with_identity(fresh, site), "id", buckets=buckets, batch=batch, only_new=True, identity=["id"])
        return
    key = document_key(site)
    keyed = with_id(fresh, site)
    if set(site.identity) != {"url"}:
        keyed = records.last_of_each(keyed, key, list(arrival) or [key])
    # What is new by its URL is added; by other features a record may be new whose URL is not.
    only_new = set(site.identity) == {"url"}
    upsert(index_path, keyed.drop(*arrival), key, buckets=buckets, batch=batch, only_new=only_new, identity=looked_up_by(site))
