"""One large JSON array, read by many tasks.

A JSON document has no line to split at, so a file is read as the pieces between closing braces: the text source finds
these at any byte range. Whether a piece starts inside a string, and how deep, is not seen from the piece. Blocks of pieces
are stored with what they add in either case; running sums over the blocks of a file, a few numbers each, tell how each
block starts, and then every block gives its elements on its own. Only elements that cross a block's border are shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.functions.text import valid_text
from weblode.session import stored, work_path
from weblode.sources import json_blocks

cloudpickle.register_pickle_by_value(json_blocks)

BLOCK = ("file", "split", "block")
# How so many blocks start is broadcast to them: a path and five numbers each.
MOST_BROADCAST = 100_000


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    """The files' blocks, stored: later jobs must not depend on how the files are split anew."""
    pieces = spark.read.option("lineSep", "}").text(path)
    placed = pieces.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        # With the brace it was cut at.
        F.concat("value", F.lit("}")).cast("binary").alias("piece"),
    )
    return stored(placed.mapInArrow(json_blocks.to_blocks, json_blocks.BLOCK_DDL), work_path(spark, "json-blocks"))


def _earlier(*order: str | Column) -> WindowSpec:
    """What stands before in the file."""
    return Window.partitionBy("file").orderBy("split", "block", *order).rowsBetween(Window.unboundedPreceding, -1)


def _sum_before(value: Column) -> Column:
    return F.coalesce(F.sum(value).over(_earlier()), F.lit(0))


def _starts(blocks: DataFrame) -> DataFrame:
    """Per block: whether it starts inside a string, and how deep; a file that does not end as it began is an error."""
    net = F.when(F.col("quoted") == 0, F.col("outside")).otherwise(F.col("inside"))
    known = (
        blocks.select(*BLOCK, "odd", "outside", "inside")
        .withColumn("quoted", _sum_before(F.col("odd")) % 2)
        .withColumn("net", net)
        .withColumn("depth", _sum_before(F.col("net")))
    )
    whole = Window.partitionBy("file")
    # A brace is added to a file's last piece, and there is none if the file ends with a brace.
    sound = F.sum("net").over(whole).isin(0, -1) & (F.sum("odd").over(whole) % 2 == 0)
    error = F.raise_error(F.concat(F.lit("not whole JSON: "), F.col("file"))).cast("long")
    return known.withColumn("sound", sound).select(*BLOCK, F.when(F.col("sound"), F.col("quoted")).otherwise(error).alias("quoted"), "depth")


def _joined(parts: DataFrame) -> DataFrame:
    """Elements that cross blocks: a tail, the blocks in the middle, and a head."""
    is_tail, is_head = F.col("part") == "tail", F.col("part") == "head"
    # A block's head comes before its tail.
    earlier = _earlier(is_tail)
    tails = F.coalesce(F.count_if(is_tail).over(earlier), F.lit(0)) + is_tail.cast("long")
    heads = F.coalesce(F.count_if(is_head).over(earlier), F.lit(0))
    chained = parts.withColumn("chain", tails).withColumn("ended", heads).where("chain > ended")
    pieces = F.sort_array(F.collect_list(F.struct("split", "block", "text", "wanted")))
    chains = chained.groupBy("file", "chain").agg(pieces.alias("pieces"))
    return chains.where(F.get("pieces", F.lit(0))["wanted"]).select(F.array_join("pieces.text", "").alias("text"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str, keys: Sequence[str] = ()) -> DataFrame:
    """One row per object of the array that each file is, or holds under ``keys``; a file is read by as many tasks as it has splits.

    Without ``keys`` the array is the whole document, with them the array of the last key so many levels deep. Several
    documents may follow each other in a file. Elements that are not objects are passed over, files that hold no such array
    give no rows, one that ends within a string or an element is an error, and an object that does not fit the schema has
    NULL there. The text is written once to the shared folder; a task holds a block and an element.
    """
    if any("}" in key or '"' in key or "\\" in key for key in keys):
        raise ValueError("keys with braces, quotes or backslashes")
    level, key = len(keys) + 1, keys[-1] if keys else None
    blocks = _blocks(spark, path)
    few = blocks.count() <= MOST_BROADCAST

    def found(starts: DataFrame, kind: str) -> DataFrame:
        starting = blocks.select(*BLOCK, "text").join(F.broadcast(starts) if few else starts, list(BLOCK))
        rows = starting.mapInArrow(json_blocks.finder(level, key, kind), json_blocks.FOUND_DDL)
        return rows.withColumn("text", F.col("text").cast("string"))

    starts = _starts(blocks)
    states = found(starts.withColumn("wanted", F.lit(False)), "state").select(*BLOCK, F.col("wanted").alias("turn"))
    before = F.coalesce(F.last("turn", ignorenulls=True).over(_earlier()), F.lit(False))
    known = starts.join(states, list(BLOCK), "left").select(*BLOCK, "quoted", "depth", before.alias("wanted"))
    known = stored(known, work_path(spark, "json-starts"))
    texts = found(known, "whole").select("text").unionAll(_joined(found(known, "parts")))
    return texts.select(F.from_json(valid_text(F.col("text")), schema).alias("record")).select("record.*")
