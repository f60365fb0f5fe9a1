"""Whole jobs run more than once: several streams, changed schemas, repeated batches, unusual sites."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from weblode.catalog.file_queries import RECORD_SCHEMA, SITE, WHOLE_URLS, land_pages, streamed_records
from weblode.catalog.page_queries import sql_records
from weblode.catalog.registry import pages, query, table
from weblode.config import Feature
from weblode.functions import dom, values
from weblode.functions.countries import iso_countries
from weblode.operators import extract, index, model, vocabulary
from weblode.plans.site import index_site
from weblode.session import work_path
from weblode.sources import readers
from weblode.streaming.ingest import ingest_stream, read_page_stream


@query("t1_two_streams", sql_records("url"))
def two_streams(spark, sf_dir):
    """Half of the pages arrive in one landing folder, half in another; both streams feed one index, which goes by page_id."""
    source, target = table(spark, sf_dir, "pages"), work_path(spark, "index")
    for half in (0, 1):
        landing, files = land_pages(spark, source.where(F.col("page_id") % 2 == half))
        stream = read_page_stream(spark, landing, source.schema, files_per_batch=files)
        ingest_stream(
            stream, WHOLE_URLS, target, work_path(spark, "checkpoint"), arrival=["page_id", "url"], buckets=8, by_identity=True
        ).awaitTermination()
    return streamed_records(spark, target)


SQL_LATEST = """
    latest AS (SELECT o_custkey AS id, o_orderpriority AS name, o_totalprice AS amount, o_orderstatus AS status FROM orders
               QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
"""


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("amount")
    )


def latest_orders(spark, sf_dir, *more):
    rows = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderpriority").alias("name"), F.col("o_totalprice").alias("amount"), *more, "o_orderkey"
    )
    return index.last_of_each(rows, "id", ["o_orderkey"]).drop("o_orderkey")


@query(
    "d4_new_column",
    f"""
    WITH {SQL_LATEST}
    SELECT id, name, amount, status FROM latest
    UNION ALL SELECT c_custkey, c_name, c_acctbal, NULL FROM customer WHERE c_custkey NOT IN (SELECT id FROM latest)
    """,
)
def new_column(spark, sf_dir):
    """A later batch brings a column; one after it does not, and takes nothing away."""
    path = work_path(spark, "index")
    index.upsert(path, customers(spark, sf_dir), "id", buckets=16)
    index.upsert(path, latest_orders(spark, sf_dir, F.col("o_orderstatus").alias("status")), "id", buckets=16)
    known = index.read_index(spark, path).where("status is null").drop("status")
    index.upsert(path, known, "id", buckets=16)
    return index.read_index(spark, path)


@query(
    "d4_retry",
    f"""
    WITH {SQL_LATEST}
    SELECT id, name, amount FROM latest
    UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT id FROM latest)
    """,
)
def retry(spark, sf_dir):
    """The first batch is delivered again after the second: it is committed already and rewinds nothing."""
    path = work_path(spark, "index")
    for batch, rows in (("a-0", customers), ("a-1", latest_orders), ("a-0", customers)):
        index.upsert(path, rows(spark, sf_dir), "id", buckets=16, batch=batch)
    return index.read_index(spark, path)


@query(
    "d6_index_types",
    """
    WITH latest AS (SELECT o_custkey AS id, CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_totalprice END AS amount FROM orders
                    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) = 1)
    SELECT id, amount FROM latest
    UNION ALL SELECT c_custkey, c_acctbal FROM customer WHERE c_custkey NOT IN (SELECT id FROM latest)
    """,
)
def index_types(spark, sf_dir):
    """A number column gets texts; those that are no numbers become NULL."""
    path = work_path(spark, "index")
    index.upsert(path, customers(spark, sf_dir).select("id", "amount"), "id", buckets=16)
    amount = F.when(F.col("status") == "F", "none yet").otherwise(F.col("amount").cast("string"))
    changed = latest_orders(spark, sf_dir, F.col("o_orderstatus").alias("status")).select("id", amount.alias("amount"))
    index.upsert(path, changed, "id", buckets=16)
    return index.read_index(spark, path)


@query("s3_any_name", "SELECT conv_id, turn, role, text FROM conversations")
def any_name(spark, sf_dir):
    """JSON lines in compressed and uncompressed text files of any name."""
    path = work_path(spark, "saved")
    turns = table(spark, sf_dir, "conversations").withColumn("even", F.col("conv_id") % 2 == 0)
    line = F.to_json(F.struct("conv_id", "turn", "role", "text"), {"ignoreNullFields": "false"}).alias("value")
    turns.where("even").select(line).write.text(f"{path}/plain")
    turns.where("not even").select(line).write.option("compression", "gzip").text(f"{path}/deep/packed")
    return readers.read_json_directory(spark, path, RECORD_SCHEMA, per_file=False).drop("file_path")


@query(
    "h7_attribute_markup",
    """
    SELECT p_partkey, p_name || ' of ' || p_brand AS content FROM part
    """,
)
def attribute_markup(spark, sf_dir):
    """An attribute that holds markup gives its text."""
    html = F.concat(F.lit('<html><meta content="&lt;b class=x&gt;'), "p_name", F.lit("&lt;/b&gt; of "), "p_brand", F.lit('"></html>'))
    parsed = dom.with_nodes(table(spark, sf_dir, "part").select("p_partkey", html.alias("html")), ["meta"])
    wanted = Feature("content", "meta", property_value="content")
    return parsed.select("p_partkey", extract.feature_text(wanted, F.col("html"), F.col("nodes")).alias("content"))


MANY = 2000


@query(
    "v5_category_many",
    f"SELECT p_partkey, CASE WHEN p_partkey < {MANY} THEN 'class ' || p_partkey % 7 ELSE 'Other Category' END AS category FROM part",
)
def category_many(spark, sf_dir):
    text = F.concat(F.lit("Part No"), "p_partkey", F.lit(" of a set"))
    keys = {f"No{i}": f"class {i % 7}" for i in range(MANY)} | {f"part No{i}": f"class {i % 7}" for i in range(MANY)}
    return table(spark, sf_dir, "part").select(
        "p_partkey", values.category(F.regexp_replace(text, "Part No", "part No"), keys).alias("category")
    )


@query(
    "m3_enumeration_many",
    f"SELECT p_partkey, CASE WHEN p_partkey < {MANY} THEN 'class ' || p_partkey % 7 ELSE 'none' END AS code FROM part",
)
def enumeration_many(spark, sf_dir):
    keys = {f"<{i}>": f"class {i % 7}" for i in range(MANY)}
    text = F.concat(F.lit("part <"), "p_partkey", F.lit(">"))
    return table(spark, sf_dir, "part").select("p_partkey", model.enumeration(text, keys, "none").alias("code"))


@query("c1_names_by_kind", "SELECT DISTINCT p_brand AS value FROM part ORDER BY value")
def names_by_kind(spark, sf_dir):
    places = table(spark, sf_dir, "part").select(
        F.col("p_type").alias("country"), F.col("p_name").alias("name"), F.col("p_brand").alias("subcountry"), F.col("p_partkey").alias("geonameid")
    )
    schools = table(spark, sf_dir, "supplier").select(F.col("s_name").alias("name"))
    return vocabulary.names_of_kind("province", places, schools)


SQL_REACHED = """
    WITH RECURSIVE reached AS (
      SELECT CAST(0 AS BIGINT) AS id
      UNION
      SELECT c.page_id FROM reached JOIN pages c ON c.page_id IN (2 * id + 1, 2 * id + 2)
      WHERE NOT regexp_matches('/p/' || c.page_id, '/p/[0-9]*7$'))
"""


def tree(spark, sf_dir, query_part=""):
    """Every page links to its two children, to a page of another site and to the first page."""
    own = F.col("page_id")
    children = [F.concat(F.lit('<a href="/p/'), 2 * own + i, F.lit(f'{query_part}">next</a>')) for i in (1, 2)]
    far = F.concat(F.lit('<a href="https://far.example/x'), own, F.lit('">far</a>'))
    title = F.concat(F.lit("<html><title>"), own, F.lit("</title><body>"))
    html = F.concat(title, *children, far, F.lit("</body></html>"))
    return pages(spark, sf_dir).select("page_id", html.alias("html"))


@query(
    "u14_site_summary",
    f"""
    {SQL_REACHED},
    links AS (SELECT unnest([2 * page_id + 1, 2 * page_id + 2]) AS id, page_id FROM pages JOIN reached ON id = page_id),
    inner_links AS (SELECT count(DISTINCT id) AS n FROM links WHERE NOT regexp_matches('/p/' || id, '/p/[0-9]*7$')),
    outer_links AS (SELECT count(*) AS n FROM pages JOIN reached ON id = page_id)
    SELECT i.n AS internal, o.n AS external, i.n AS permitted, i.n + o.n AS total,
           CAST(NULL AS BIGINT) AS max_urls, false AS cut
    FROM inner_links i, outer_links o
    """,
)
def site_summary(spark, sf_dir):
    """Denied pages are stored too, with all that hangs below them: only what is visited counts."""
    linked = tree(spark, sf_dir).select(F.concat(F.lit("https://site.example/p/"), "page_id").alias("url"), "html")
    return index_site(linked, SITE, work_path(spark, "index"), buckets=8)


@query(
    "u8_site_entities",
    f"""
    {SQL_REACHED}
    SELECT 'https://site.example/p/' || page_id || '?a=1&b=2' AS url, CAST(page_id AS VARCHAR) AS title, CAST(NULL AS VARCHAR) AS advert
    FROM pages JOIN reached ON id = page_id WHERE page_id > 0
    """,
)
def site_entities(spark, sf_dir):
    """Addresses stored, and linked, with an ampersand that was escaped twice; parameters are kept."""
    first = "https://site.example/p/0"
    address = F.when(F.col("page_id") == 0, first).otherwise(F.concat(F.lit("https://site.example/p/"), "page_id", F.lit("?a=1&amp;b=2")))
    linked = tree(spark, sf_dir, "?a=1&amp;amp;b=2").select(address.alias("url"), "html")
    kept = replace(SITE, keep_parameters=True, keep_parameters_for_indexing=True, denied=(r"/p/[0-9]*7\?",))
    path = work_path(spark, "index")
    index_site(linked, kept, path, buckets=8, strict_host=True)
    found = index.read_index(spark, path)
    return found.withColumn("url", F.replace("url", F.lit("amp;"), F.lit("")))


@query(
    "v6_category_votes_many",
    """
    WITH k AS (SELECT chr((97 + i // 26)::INT) || chr((97 + i % 26)::INT) AS key, i, 'class ' || i % 7 AS class FROM range(676) t(i)),
    v AS (SELECT p_partkey, class, count(*) * 1000 - min(i) AS score FROM part JOIN k ON contains(lower(p_name), key) GROUP BY ALL)
    SELECT p_partkey, coalesce(arg_max(class, score), 'Other Category') AS category FROM part LEFT JOIN v USING (p_partkey) GROUP BY p_partkey
    """,
)
def category_votes_many(spark, sf_dir):
    """All pairs of letters as keys: they overlap, and most texts hold many."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    keys = {a + b: f"class {(i * 26 + j) % 7}" for i, a in enumerate(letters) for j, b in enumerate(letters)}
    return table(spark, sf_dir, "part").select("p_partkey", values.category_by_votes(F.col("p_name"), keys).alias("category"))


SQL_NAMED = "CASE lang WHEN 'fr' THEN 'France' WHEN 'es' THEN 'Spain' WHEN 'de' THEN 'Germany' END"


@query(
    "v4_country_iso",
    f"""
    SELECT doc_id, CASE WHEN doc_id % 3 < 2 AND lang IN ('fr', 'es', 'de') THEN {SQL_NAMED} WHEN doc_id % 3 = 0 THEN 'somewhere' ELSE upper(lang) || CASE doc_id % 3 WHEN 2 THEN '?' ELSE '' END END AS country
    FROM documents
    """,
)
def country_iso(spark, sf_dir):
    """The default table of countries: names within a text, codes, and texts that are neither."""
    place = F.when(F.col("lang") == "fr", "in France today").when(F.col("lang") == "es", "Spain").when(F.col("lang") == "de", "ex-Germany").otherwise("somewhere")
    text = F.when(F.col("doc_id") % 3 == 0, place).when(F.col("doc_id") % 3 == 1, F.upper("lang")).otherwise(F.concat(F.upper("lang"), F.lit("?")))
    return table(spark, sf_dir, "documents").select("doc_id", values.country(text, iso_countries(spark)).alias("country"))
