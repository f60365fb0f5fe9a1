"""Source, sink, load and streaming queries; files they need are written to the work folder first."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.catalog.index_queries import (
    DELIMITERS,
    FORBIDDEN,
    LOOKUP,
    SQL_DIGITS,
    SQL_VOCABULARY,
    sql_canonical,
    sql_enumeration,
)
from weblode.catalog.page_queries import RECORD, sql_normal, sql_records, sql_text
from weblode.catalog.registry import pages, query, table
from weblode.config import SITE_KEYS, DecisionModel, Site
from weblode.operators import vocabulary
from weblode.operators.index import read_index
from weblode.plans.loads import load_model_index, reingest
from weblode.plans.site import index_site
from weblode.session import work_path
from weblode.sources import readers, writers
from weblode.streaming.ingest import ingest_stream, read_page_stream


@query(
    "s1_page_source",
    "SELECT page_id, url, length(html) AS characters, contains(html, '<body>') AS has_body FROM pages",
)
def page_source(spark, sf_dir):
    """Pages as raw bytes, decoded on reading."""
    path = work_path(spark, "raw-pages")
    latin = F.encode(F.regexp_replace("html", r"[^\x00-\xff]", "?"), "ISO-8859-1")
    table(spark, sf_dir, "pages").select("page_id", "url", latin.alias("html")).write.parquet(path)
    return readers.read_pages(spark, path).select(
        "page_id",
        "url",
        F.length("html").cast("bigint").alias("characters"),
        F.contains("html", F.lit("<body>")).alias("has_body"),
    )


RECORD_SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def saved_conversations(spark, sf_dir):
    """Conversation turns as JSON files in nested folders, by role and turn."""
    path = work_path(spark, "saved")
    turns = table(spark, sf_dir, "conversations")
    turns.withColumn("folder", F.col("role")).withColumn("deep", F.col("turn") % 4).write.partitionBy(
        "folder", "deep"
    ).option("ignoreNullFields", False).json(path)
    return path


@query("s3_json_directory", "SELECT conv_id, turn, role, text FROM conversations")
def json_directory(spark, sf_dir):
    path = saved_conversations(spark, sf_dir)
    return readers.read_json_directory(spark, path, RECORD_SCHEMA, per_file=False).drop("file_path")


def write_arrays(rows, key, element, path, wrap=None, pretty=False, most=1000):
    """JSON arrays of at most so many elements, one per line or, if pretty, over many lines."""
    grouped = rows.groupBy(F.floor(F.col(key) / most).alias("part")).agg(F.collect_list(element).alias("items"))
    items = F.col("items") if wrap is None else wrap(F.col("items"))
    text = F.to_json(items, {"pretty": str(pretty).lower()})
    grouped.select(text.alias("value")).write.text(path)
    return path


SQL_PLACES = "SELECT p_partkey AS geonameid, p_name AS name, p_brand AS subcountry, p_type AS country FROM part"


def saved_gazetteer(spark, sf_dir, pretty):
    place = F.struct(
        F.col("p_partkey").alias("geonameid"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("subcountry"),
        F.col("p_type").alias("country"),
    )
    return write_arrays(table(spark, sf_dir, "part"), "p_partkey", place, work_path(spark, "gazetteer"), pretty=pretty)


@query("s4_gazetteer", SQL_PLACES)
def gazetteer(spark, sf_dir):
    return readers.read_gazetteer(spark, saved_gazetteer(spark, sf_dir, False), whole_file=False)


@query("s4_gazetteer_array", SQL_PLACES)
def gazetteer_array(spark, sf_dir):
    return readers.read_gazetteer(spark, saved_gazetteer(spark, sf_dir, True))


SQL_PRIORITIES = "SELECT o_orderpriority AS priority FROM orders"


def as_hits(items):
    return F.struct(F.struct(items.alias("hits")).alias("hits"))


def saved_export(spark, sf_dir, pretty):
    hit = F.struct(F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("key"))
    return write_arrays(table(spark, sf_dir, "orders"), "o_orderkey", hit, work_path(spark, "export"), as_hits, pretty)


@query("s5_index_export", SQL_PRIORITIES)
def index_export(spark, sf_dir):
    return readers.read_index_export(spark, saved_export(spark, sf_dir, False), "priority", whole_file=False)


@query("s5_index_export_array", SQL_PRIORITIES)
def index_export_array(spark, sf_dir):
    return readers.read_index_export(spark, saved_export(spark, sf_dir, True), "priority")


@query("s5_document_hits", "SELECT text FROM documents")
def document_hits(spark, sf_dir):
    hit = F.struct("text", F.struct("doc_id", "lang").alias("about"))
    path = work_path(spark, "hits")
    write_arrays(table(spark, sf_dir, "documents"), "doc_id", hit, path, as_hits, pretty=True, most=100)
    return readers.read_index_export(spark, path, "text")


@query(
    "s6_json_sink",
    "SELECT c_custkey AS url, CASE WHEN c_acctbal < 0 THEN 'N/A' ELSE c_mktsegment END AS segment FROM customer",
)
def json_sink(spark, sf_dir):
    root = work_path(spark, "files")
    segment = F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))
    found = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("url"), segment.alias("segment"))
    writers.write_json(found, root, "customers", missing="N/A")
    return readers.read_json_directory(
        spark, f"{root}/customers", "url bigint, segment string", per_file=False
    ).drop("file_path")


@query(
    "s7_csv_sink",
    "SELECT '[\"' || p_name || '\"]' AS names, CAST(p_partkey AS VARCHAR) AS id, CASE WHEN p_size > 10 THEN 'N/A' ELSE p_brand END AS brand FROM part",
)
def csv_sink(spark, sf_dir):
    path = work_path(spark, "csv")
    found = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("id"),
        F.array("p_name").alias("names"),
        F.when(F.col("p_size") <= 10, F.col("p_brand")).alias("brand"),
        "p_type",
    )
    writers.write_csv(found, path, ["names", "id", "brand"], missing="N/A")
    schema = "names string, id string, brand string"
    return spark.read.schema(schema).option("escape", '"').csv(path)


@query("s8_vocabulary_sink", SQL_VOCABULARY)
def vocabulary_sink(spark, sf_dir):
    path = work_path(spark, "vocabulary")
    found = vocabulary.vocabulary(table(spark, sf_dir, "documents"), "text", DELIMITERS, FORBIDDEN)
    writers.write_vocabulary(found, path)
    return spark.read.schema("value string").json(path)


@query(
    "d5_reingest",
    "SELECT conv_id * 100000 + turn AS id, conv_id, turn, role, text FROM conversations",
)
def reingest_records(spark, sf_dir):
    path, target = work_path(spark, "saved"), work_path(spark, "index")
    turns = table(spark, sf_dir, "conversations")
    key = F.array((F.col("conv_id") * 100000 + F.col("turn")).alias("key"))
    shaped = turns.select(key.alias("key"), "conv_id", "turn", "role", "text")
    # Saved twice: the later folder wins.
    shaped.withColumn("text", F.lit("stale")).write.json(f"{path}/a/deep")
    shaped.write.json(f"{path}/b")
    reingest(spark, path, f"key array<bigint>, {RECORD_SCHEMA}", "key", target, per_file=False, buckets=8)
    return read_index(spark, target).drop("key")


MODEL = DecisionModel.parse(
    "parts",
    {
        "name": {
            "scoreCalculation": {"datatype": "enumeration"},
            "schemaMapping": {"schemaDataType": "keyword", "defaultValue": "other", "mappingScript": {"lookup": LOOKUP}},
        },
        "brand": {
            "scoreCalculation": {"datatype": "int"},
            "schemaMapping": {"schemaDataType": "integer", "defaultValue": "0"},
        },
        "price": {
            "scoreCalculation": {"datatype": "currency"},
            "schemaMapping": {"schemaDataType": "double", "defaultValue": None},
        },
        "type": {
            "scoreCalculation": {"datatype": "text"},
            "schemaMapping": {"schemaDataType": "text", "defaultValue": "plain"},
        },
        "score": {"scoreCalculation": {"datatype": "artificial"}, "schemaMapping": {"schemaDataType": "artificial"}},
        "keys": {
            "scoreCalculation": {"datatype": "text"},
            "schemaMapping": {
                "schemaDataType": "text",
                "isDrived": True,
                "mappingScript": {"operation": "mapping", "format": "list", "lookup": ["name", "type", "brand"]},
            },
        },
        "verdict": {
            "scoreCalculation": {"datatype": "text"},
            "schemaMapping": {
                "schemaDataType": "text",
                "isDrived": True,
                "mappingScript": {
                    "operation": "comparison",
                    "lookup": [{"op": "gte", "field": "size", "value": 25, "trueBody": "large", "falseBody": "small"}],
                },
            },
        },
    },
)


@query(
    "m9_model_load",
    f"""
    WITH saved AS (
      SELECT p_partkey AS id, p_name AS name, CASE WHEN p_size > 40 THEN NULL ELSE p_brand END AS brand,
             format('{{:.2f}}', p_retailprice) AS price, CASE WHEN p_size < 10 THEN NULL ELSE p_type END AS type, p_size AS size FROM part)
    SELECT id, {sql_enumeration("name", "'other'")} AS name,
           CASE WHEN brand IS NULL THEN 0 ELSE CAST({SQL_DIGITS.format("brand")} AS INTEGER) END AS brand,
           CAST({SQL_DIGITS.format("price")} AS DOUBLE) AS price, coalesce(type, 'plain') AS type,
           {sql_canonical("name")} || CASE WHEN type IS NULL THEN '' ELSE '|' || type || CASE WHEN brand IS NULL THEN '' ELSE '|' || brand END END AS keys,
           CASE WHEN size >= 25 THEN 'large' ELSE 'small' END AS verdict
    FROM saved
    """,
)
def model_load(spark, sf_dir):
    root, target = work_path(spark, "files"), work_path(spark, "index")
    size = F.col("p_size")
    saved = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("url"),
        F.col("p_name").alias("name"),
        F.when(size <= 40, F.col("p_brand")).alias("brand"),
        F.regexp_replace(F.format_number("p_retailprice", 2), ",", "").alias("price"),
        F.when(size >= 10, F.col("p_type")).alias("type"),
        size.cast("string").alias("size"),
    )
    writers.write_json(saved, root, "parts", missing="N/A")
    schema = "url string, name string, brand string, price string, type string, size string"
    load_model_index(spark, f"{root}/parts", schema, MODEL, target, per_file=False, buckets=8)
    loaded = read_index(spark, target)
    return loaded.select(
        F.col("id").cast("bigint").alias("id"), "name", "brand", "price", "type",
        F.array_join("keys", "|").alias("keys"), "verdict",
    )


def land_pages(spark, source, copies: int = 1):
    """Pages as files in a landing folder, each page arriving ``copies`` times; the folder, and how many files two thirds of a copy are.

    A copy is three files of a small table, and as many as a scan of a large one has tasks: they are written and read by all cores.
    """
    landing = work_path(spark, "landing")
    thirds = max(1, source.rdd.getNumPartitions() // 3)
    for _ in range(copies):
        source.repartition(3 * thirds, "page_id").write.mode("append").parquet(landing)
    return landing, 2 * thirds


# Addresses are kept whole. Some pages share one, and they may arrive in any order: the index goes by page_id.
WHOLE_URLS = replace(RECORD, keep_parameters_for_indexing=True)


def drained(spark, sf_dir, files_path=None):
    source, target = table(spark, sf_dir, "pages"), work_path(spark, "index")
    landing, files = land_pages(spark, source, copies=2)
    stream = read_page_stream(spark, landing, source.schema, files_per_batch=files)
    ingest_stream(
        stream, WHOLE_URLS, target, f"{target}/checkpoint", files_path, arrival=["page_id", "url"], buckets=8, by_identity=True
    ).awaitTermination()
    return target


def streamed_records(spark, target):
    """The records of an index that streams fed."""
    return read_index(spark, target).drop("id", "page_id")


@query("t1_stream_ingest", sql_records("url"))
def stream_ingest(spark, sf_dir):
    """Pages arriving twice, in micro-batches: the index holds each record once."""
    return streamed_records(spark, drained(spark, sf_dir))


@query("t2_stream_files", "SELECT url, coalesce(heading, 'N/A') AS heading FROM (" + sql_records("url") + ")")
def stream_files(spark, sf_dir):
    """CSV rows appended while the stream is drained."""
    files = work_path(spark, "files")
    drained(spark, sf_dir, files)
    schema = T.StructType().add("url", T.StringType()).add("heading", T.StringType())
    options = spark.read.schema(schema).option("escape", '"').option("recursiveFileLookup", True)
    return options.option("pathGlobFilter", "*.csv").csv(files)


SITE = Site.parse(
    "site",
    {
        **{key: [] for key in SITE_KEYS},
        "seed": "https://site.example/p/0",
        "permitted_urls_rules": ["/p/"],
        "denied_urls_rules": ["/p/[0-9]*7$"],
        "keep_parameters": False,
        "keep_parameters_for_indexing": False,
        "start_page_counter_from": 1,
        "equal_crawled_features": ["url", "title"],
        "decision_model": "site",
        "allArray": False,
        "features": {
            "title": {"tag": "title", "cssClass": "", "datatype": "string"},
            "advert": {"tag": "div", "cssClass": "ad", "datatype": "other"},
        },
    },
)


@query(
    "h17_site_index",
    f"""
    WITH RECURSIVE reached AS (
      SELECT CAST(0 AS BIGINT) AS id
      UNION
      SELECT c.page_id FROM reached JOIN pages c ON c.page_id IN (2 * id + 1, 2 * id + 2)
      WHERE NOT regexp_matches('/p/' || c.page_id, '/p/[0-9]*7$'))
    SELECT 'https://site.example/p/' || page_id AS url, {sql_normal(sql_text("html", "<title>", "</title>"))} AS title,
           {sql_text("html", '<div class="ad">', "</div>")} AS advert
    FROM pages JOIN reached ON id = page_id WHERE page_id > 0
    """,
)
def site_index(spark, sf_dir):
    """The whole job on one site: every page links to its two children in a tree over the pages."""
    own, path = F.col("page_id"), work_path(spark, "index")
    address = F.concat(F.lit("https://site.example/p/"), own)
    children = [F.concat(F.lit('<a href="/p/'), 2 * own + i, F.lit('">next</a>')) for i in (1, 2)]
    linked = pages(spark, sf_dir).select(address.alias("url"), F.concat("html", *children).alias("html"))
    index_site(linked, SITE, path, buckets=8)
    return read_index(spark, path)
