"""Exact duplicates by sorting contents (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weblode.llm.common import SPACES, number_of, numbered, text_of, without

# A text with more than one in this many rows is spread over several tasks; there are always fewer such texts.
HOT_SHARE = 10_000
HEAD = 32  # letters of a text that a splitter holds
ADDED = ("keep_id", "group_size", "kept", "text_sha256")


def exact_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``.

    Texts are equal if they agree after all white space ``[\\x20\\x09-\\x0D]`` is deleted; a null text
    is an empty one. Of equal texts the row with the most code points stays, then the one with the
    smallest id (null ids last); of rows that tie in both, exactly one is ``kept``. Input columns that
    bear the name of an added one are replaced. An empty table gives an empty result.

    Sampled splitters deal the normalised texts into ranges by their beginning and hash, each range is sorted
    externally, and neighbours are compared in full. A text of more than ``1/HOT_SHARE`` of the rows is sorted in as many
    parts as its share asks for, cut by a hash of the id, so that a group of copies never meets in one task; what the
    parts have in common is counted beforehand with map-side combination, and has under ``HOT_SHARE`` rows.
    """
    key, text = F.col(number_of(docs, id_column)), text_of(number_of(docs, text_column))
    rows = numbered(docs).withColumns({"_norm": F.regexp_replace(text, SPACES, ""), "_points": F.length(text)})
    rows = rows.withColumn("text_sha256", F.sha2("_norm", 256))
    hot = hot_texts(rows, key)
    marked = rows.join(F.broadcast(hot), "text_sha256", "left")
    marked = marked.withColumn("_part", F.coalesce(F.pmod(F.xxhash64(key), F.col("_parts")), F.lit(0)))
    # Splitters are sampled on the driver, so they are short: the text's beginning, then its hash. Equal texts share both.
    short = marked.withColumns({"_head": F.substring("_norm", 1, HEAD), "_hash": F.xxhash64("_norm")})
    ranged = short.repartitionByRange("_head", "_hash", "_part")
    equals = Window.partitionBy("_head", "_hash", "_part", "_norm")
    best_first = equals.orderBy(F.desc("_points"), key.asc_nulls_last())
    placed = ranged.select(
        "*",
        F.row_number().over(best_first).alias("_place"),
        F.first(key).over(best_first).alias("_first_id"),
        F.count(F.lit(1)).over(best_first.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("_equal"),
    )
    is_hot = F.col("_parts").isNotNull()
    first = F.when(is_hot, F.col("_hot.id")).otherwise(F.col("_first_id"))
    return placed.select(
        *[F.col(number_of(docs, c)).alias(c) for c in without(docs, ADDED).columns],
        first.alias("keep_id"),
        F.when(is_hot, F.col("_rows")).otherwise(F.col("_equal")).alias("group_size"),
        ((F.col("_place") == 1) & (~is_hot | (key.eqNullSafe(F.col("_hot.id"))))).alias("kept"),
        "text_sha256",
    )


def hot_texts(rows: DataFrame, key) -> DataFrame:
    """Fewer than ``HOT_SHARE`` texts with their number of rows, parts and the row that stays."""
    counted = rows.groupBy("text_sha256").agg(F.count(F.lit(1)).alias("_rows"))
    total = rows.sparkSession.createDataFrame([(rows.count(),)], "total long")
    hot = counted.join(F.broadcast(total), F.col("_rows") * HOT_SHARE > F.col("total")).where("_rows > 1")
    parts = F.ceil(F.col("_rows") * HOT_SHARE / F.col("total")).alias("_parts")
    hot = hot.select("text_sha256", "_rows", parts)
    order = F.struct((-F.col("_points")).alias("points"), key.isNull().alias("no_id"), key.alias("id"))
    best = rows.join(F.broadcast(hot.select("text_sha256")), "text_sha256").groupBy("text_sha256").agg(F.min(order).alias("_hot"))
    return hot.join(F.broadcast(best), "text_sha256")
