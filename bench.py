"""Time the headline queries at one scale and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from weblode.catalog import load  # noqa: E402
from weblode.session import name_work_root  # noqa: E402

HEADLINE = (
    "u3_link_extraction",
    "u4_resolve",
    "u7_link_table",
    "u9_seen_urls",
    "u10_frontier",
    "u13_counter_stop",
    "u14_crawl_summary",
    "h1_nodes_per_tag",
    "h1_document_text",
    "h10_json_path",
    "h15_precedence",
    "h17_page_records",
    "h17_site_index",
    "v6_category_votes",
    "v8_location",
    "v14_typed_columns",
    "d1_not_indexed",
    "d3_first_arrival",
    "d4_upsert",
    "m9_model_load",
    "c7_vocabulary",
    "t1_stream_ingest",
)


def in_many_files(spark: SparkSession, sf_dir: str, folder: str, files: int) -> str:
    """The tables as a lake holds them, in many files: a supplied one is a single row group, which one task reads alone."""
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            spark.read.parquet(f"{sf_dir}/{name}").repartition(files).write.parquet(f"{folder}/{name}")
    return folder


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("weblode-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if not spark.conf.get("spark.checkpoint.dir", None):
        name_work_root(tempfile.mkdtemp(prefix="bench-"))
    queries = load()[0]
    # Outside the measurements, as is what starts the JVM's and the Python workers' machinery.
    tables = in_many_files(spark, sf_dir, tempfile.mkdtemp(prefix="bench-tables-"), 2 * int(cpus))
    queries["h2_titles"](spark, tables).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in chosen:
        started = time.perf_counter()
        queries[name](spark, tables).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
