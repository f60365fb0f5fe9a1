"""Pages to metadata records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblode.config import Feature, Site
from weblode.functions import dom, urls, values
from weblode.functions.countries import iso_countries
from weblode.operators.extract import feature_text, feature_value, has_body, needed_nodes, with_json
from weblode.operators.links import link_hrefs
from weblode.operators.places import locate

BODY, HREFS = "page_has_body", "page_hrefs"


def place_features(site: Site) -> list[Feature]:
    return [f for f in site.features if f.datatype == "location" and not f.static_value]


def read_features(
    pages: DataFrame,
    site: Site,
    countries: Sequence[tuple[str, str]] = (),
    keep: Sequence[str] = (),
    with_links: bool = False,
) -> DataFrame:
    """Per page: the kept columns, ``url``, whether it has a body, its links if asked for, every feature.

    Everything a page is parsed for comes from one parse, in one narrow stage. Location features
    are still the text to be looked up; country features use the ISO table if no other is given.
    """
    if any(f.datatype == "country" and not f.static_value for f in site.features):
        countries = countries or iso_countries(pages.sparkSession)
    tags, text_tags = needed_nodes(site.features)
    if with_links and tags is not None:
        tags = tags | {"a"}
    parsed = dom.with_nodes(pages.select(*keep, "url", "html"), tags, text_tags)
    parsed, json = with_json(parsed, site.features)
    html, nodes, places = F.col("html"), F.col("nodes"), place_features(site)
    url = F.col("url") if site.keep_parameters_for_indexing else urls.strip_parameters(F.col("url"))
    columns = [
        feature_text(f, html, nodes, countries, json(f))
        if f in places
        else feature_value(f, html, nodes, countries, site.all_array, json(f))
        for f in site.features
    ]
    return parsed.select(
        *keep,
        url.alias("url"),
        has_body(nodes).alias(BODY),
        *([link_hrefs(nodes).alias(HREFS)] if with_links else []),
        *[c.alias(f.name) for c, f in zip(columns, site.features)],
    )


def to_records(read: DataFrame, site: Site, gazetteer: DataFrame | None = None) -> DataFrame:
    """The pages with a body as records; location features need a gazetteer."""
    records = read.where(BODY).drop(BODY, HREFS)
    for f in place_features(site):
        if gazetteer is None:
            raise ValueError(f"location feature {f.name} needs a gazetteer")
        records = locate(records, f.name, gazetteer)
        found = values.finished(
            F.col(f.name), f.datatype, f.removal_patterns, f.extraction_patterns, site.all_array
        )
        records = records.withColumn(f.name, found)
    return records.withColumn("url", F.array("url")) if site.all_array else records


def page_records(
    pages: DataFrame,
    site: Site,
    countries: Sequence[tuple[str, str]] = (),
    gazetteer: DataFrame | None = None,
    keep: Sequence[str] = (),
) -> DataFrame:
    """One record per page that has a body: ``url`` and every configured feature, in order.

    A single narrow stage from the page scan to the record; only a location feature adds a join.
    """
    return to_records(read_features(pages, site, countries, keep), site, gazetteer)
