"""Walking the link graph: breadth-first expansion, budgets, page counters, totals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from weblode.functions import urls
from weblode.session import stored, work_path

# How many pages without a new link end a counter walk, and the visit limit.
EMPTY_PAGES = 9
MAX_VISITS = 999_999

# A frontier below this many bytes of URL text is broadcast to the edges instead of shuffling them.
BROADCAST_BYTES = 16 << 20

# A deep walk's level tables are merged now and then, so that no level reads many small ones.
MERGE_LEVELS = 16
WALK = "url string, depth int, visited boolean"

# Edges and found URLs lie in hash buckets of their URL; a bucket holds about so many bytes of edges.
BUCKET = "bucket"
BUCKET_BYTES = 64 << 20
MOST_BUCKETS = 4096


@dataclass(frozen=True)
class Bucketed:
    """A table with one folder per bucket, and the buckets that hold anything; None where all rows are one bucket."""

    path: str
    schema: StructType
    held: frozenset[int] | None

    def parts(self, wanted: frozenset[int] | None = None) -> list[str]:
        if self.held is None:
            return [self.path]
        return [f"{self.path}/{BUCKET}={b}" for b in sorted(self.held if wanted is None else self.held & wanted)]


def bucket(url: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(buckets)).cast("int")


def put_in_buckets(frame: DataFrame, url: str, buckets: int, path: str) -> Bucketed:
    """Write the frame by buckets of a URL column; rows of a bucket come together, a large one in several files."""
    if buckets == 1:
        frame.write.parquet(path)
        return Bucketed(path, frame.schema, None)
    placed = frame.withColumn(BUCKET, bucket(url, buckets))
    placed.hint("rebalance", BUCKET).write.partitionBy(BUCKET).parquet(path)
    written = frame.sparkSession.read.schema(placed.schema).parquet(path)
    # At most one small integer per bucket, from the names of the folders.
    return Bucketed(path, frame.schema, frozenset(r[0] for r in written.select(BUCKET).distinct().collect()))


def read_buckets(spark: SparkSession, tables: Sequence[Bucketed], wanted: frozenset[int] | None = None) -> DataFrame:
    """The rows of some buckets, or of all, of tables of one schema."""
    parts = [p for t in tables for p in t.parts(wanted)]
    return spark.read.schema(tables[0].schema).parquet(*parts) if parts else spark.createDataFrame([], tables[0].schema)


def first_rows(frame: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows in a total order, without bringing them together in one task.

    Rows are range-partitioned and stored, each range is counted, and only the range in which the
    limit falls is numbered.
    """
    spark = frame.sparkSession
    ranged = frame.repartitionByRange(*order).withColumn("range_id", F.spark_partition_id())
    ranged = stored(ranged, work_path(frame.sparkSession, "ranges"))
    # One small row per range.
    sizes = sorted((r["range_id"], r["count"]) for r in ranged.groupBy("range_id").count().collect())
    left, cut = n, None
    for range_id, size in sizes:
        if size > left:
            cut = range_id
            break
        left -= size
    if cut is None:
        return ranged.drop("range_id")
    whole = ranged.where(F.col("range_id") < cut)
    part = ranged.where(F.col("range_id") == cut).orderBy(*order).limit(left)
    return whole.unionByName(part).drop("range_id")


def crawl_order(
    edges: DataFrame, seeds: DataFrame, max_visits: int | None = None, buckets: int | None = None
) -> DataFrame:
    """(url, depth, visited) of every URL a breadth-first walk finds, each at its least depth.

    ``edges`` is (src_url, url), ``seeds`` (url). At most ``max_visits`` URLs are expanded, in order
    of depth and then URL; those found but not expanded have ``visited`` false. Every level is written
    as a table, so the plan does not grow and a lost executor costs no more than the current level.

    Edges are dealt once by the hash of their source, levels by the hash of their URL, to as many buckets as the edges' size
    asks for unless ``buckets`` says it. A level reads edges only where its URLs lie, and earlier
    levels only where what it found lies.
    """
    spark = edges.sparkSession
    root = work_path(spark, "walk")
    if buckets is None:
        size = edges.agg(F.coalesce(F.sum(F.octet_length("src_url") + F.octet_length("url")), F.lit(0))).first()[0]
        buckets = min(MOST_BUCKETS, max(1, -(-size // BUCKET_BYTES)))
    links = put_in_buckets(edges.select("src_url", "url"), "src_url", buckets, f"{root}/edges") if buckets > 1 else None
    budget = float("inf") if max_visits is None else max_visits
    fresh = seeds.select("url").distinct()
    depth, levels = 0, []

    def keep(found, name, visited):
        marked = found.select("url", F.lit(depth).alias("depth"), visited.alias("visited"))
        levels.append(put_in_buckets(marked, "url", buckets, f"{root}/{name}"))
        return read_buckets(spark, levels[-1:])

    while True:
        level = keep(fresh, f"level-{depth}", F.lit(budget > 0))
        size = level.agg(F.count("*").alias("n"), F.sum(F.octet_length("url")).alias("bytes")).first()
        if not size["n"] or not budget:
            # Without budget the level was only found, by the last expansion, and ends the walk.
            break
        if size["n"] > budget:
            chosen = first_rows(level.select("url"), ["url"], int(budget)).withColumn("chosen", F.lit(True))
            split = level.select("url").join(chosen, "url", "left")
            levels.pop()
            level = keep(split, f"split-{depth}", F.coalesce("chosen", F.lit(False))).where("visited")
            budget = 0
        else:
            budget -= size["n"]
        touched = levels[-1].held
        if len(levels) > MERGE_LEVELS:
            levels[:] = [put_in_buckets(read_buckets(spark, levels), "url", buckets, f"{root}/merged-{depth}")]
        found = _targets(read_buckets(spark, [links], touched) if links else edges, level, size["bytes"] or 0)
        hit = None
        if buckets > 1:
            # What was found is written first: its buckets are those in which it may have been found before.
            table = put_in_buckets(found, "url", buckets, f"{root}/found-{depth}")
            found, hit = read_buckets(spark, [table]), table.held
        fresh = found.join(read_buckets(spark, levels, hit).select("url"), "url", "left_anti")
        depth += 1
    return read_buckets(spark, levels)


def _targets(edges: DataFrame, frontier: DataFrame, frontier_bytes: int) -> DataFrame:
    """Distinct link targets of the frontier."""
    sources = frontier.select(F.col("url").alias("src_url"))
    if frontier_bytes <= BROADCAST_BYTES:
        sources = F.broadcast(sources)
    return edges.join(sources, "src_url", "left_semi").select("url").distinct()


def counter_pages(templates: DataFrame, start: int, end: int) -> DataFrame:
    """(template, k, url) for every page number of every template; ``templates`` is (template, pattern)."""
    numbered = templates.select("template", "pattern", F.explode(F.sequence(F.lit(start), F.lit(end))).alias("k"))
    return numbered.select("template", "k", urls.counter_url(F.col("pattern"), F.col("k")).alias("url"))


def last_counter_page(first_seen: DataFrame, start: int) -> int:
    """Number of the page that ends one template's walk: the ninth in a row without a new link.

    ``first_seen`` is (k) of the pages with new links. A page with new links is followed by the end
    if none of the next nine has any; the least such page decides. All steps are keyed by k, so no
    template has to fit into one task.
    """
    hits = first_seen.select("k").distinct()
    followed = hits.select(
        F.explode(F.sequence(F.col("k") - EMPTY_PAGES, F.col("k") - 1)).alias("k")
    ).distinct()
    marked = hits.join(followed.withColumn("followed", F.lit(True)), "k", "left")
    row = marked.agg(
        F.min("k").alias("first"), F.min(F.when(F.col("followed").isNull(), F.col("k"))).alias("end")
    ).first()
    if row["first"] is None or row["first"] > start + EMPTY_PAGES - 1:
        return start + EMPTY_PAGES - 1
    return row["end"] + EMPTY_PAGES


def counter_walk(links: DataFrame, templates: int, start: int) -> tuple[DataFrame, list[int]]:
    """Pages a counter walk visits, and the last page number of each template.

    ``links`` is (template, k, url): the same-site links of every counter page. A link is new where
    it is first found; what later templates see depends on where the earlier ones stopped, so they
    are cut one after the other. Result: (template, k, url) of the visited pages' new links.
    """
    inside = F.lit(False)
    stops: list[int] = []
    pages = links.where(F.col("k") >= start)
    for template in range(templates):
        seen = pages.where(inside).select("url").distinct()
        own = pages.where(F.col("template") == template).groupBy("url").agg(F.min("k").alias("k"))
        fresh = own.join(seen, "url", "left_anti") if template else own
        stops.append(last_counter_page(fresh, start))
        inside = inside | ((F.col("template") == template) & (F.col("k") <= stops[-1]))
    first = F.min(F.struct("template", "k"))
    visited = pages.where(inside).groupBy("url").agg(first.alias("at"))
    return visited.select("at.template", "at.k", "url"), stops


def crawl_summary(links: DataFrame, max_visits: int | None = None) -> DataFrame:
    """Distinct internal, external and permitted links, their total, and the visit limit (NULL if there is none)."""
    per_url = links.groupBy("url").agg(
        F.bool_or("internal").alias("internal"), F.bool_or(F.col("internal") & F.col("permitted")).alias("permitted")
    )
    return per_url.agg(
        F.count_if("internal").alias("internal"),
        F.count_if(~F.col("internal")).alias("external"),
        F.count_if("permitted").alias("permitted"),
        F.count("*").alias("total"),
        F.lit(max_visits).cast("bigint").alias("max_urls"),
    )
