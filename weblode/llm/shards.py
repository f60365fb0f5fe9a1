"""A uniform shuffle into shards of exact size."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weblode.llm.common import named_back, numbered, without
from weblode.session import stored, work_path

ADDED = ("shard", "slot")
# Rows of a shard that one task puts in order.
BLOCK_ROWS = 10_000
POSITION_BITS = 33  # monotonically_increasing_id keeps the place within a partition in its low 33 bits


def communication_matrix(counts: np.ndarray, shards: int, rng: np.random.Generator) -> np.ndarray:
    """How many rows each partition sends to each shard: uniform among all ways to fill shards exactly.

    Shard sizes differ by one at most. Row after row is a multivariate hypergeometric draw from the
    places that are left.
    """
    total = int(counts.sum())
    left = np.full(shards, total // shards, dtype=np.int64)
    left[: total % shards] += 1
    matrix = np.zeros((len(counts), shards), dtype=np.int64)
    for i, n in enumerate(counts):
        matrix[i] = rng.multivariate_hypergeometric(left, int(n), method="marginals")
        left -= matrix[i]
    return matrix


def shuffled_shards(docs: DataFrame, shards: int = 8, seed: int = 0, stable: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """All rows with ``shard`` (0 to ``shards`` - 1) and ``slot`` (gapless from 0 in each shard).

    Every assignment of rows to (shard, slot) is equally likely, and shard sizes differ by one at most. Nothing
    in a row matters: nulls, repeated rows and any further columns are carried along; input columns
    named ``shard`` or ``slot`` are replaced. An empty table gives an empty result.

    The driver sees one number per partition and draws the matrix. A partition permutes the labels of
    its row of the matrix and deals them to its rows; shards are exchanged in blocks, and a
    second permutation orders each block. A row takes its block at random, so the order of a whole shard is
    uniform although no task holds it.

    A row is known by its partition and place, so rows must be read in the same order whenever a task is
    repeated. That holds for stored tables: pass ``stable=True`` for a frame read from one without
    a shuffle. Otherwise the frame is written to the shared folder first.
    """
    docs = without(docs, ADDED)
    spark = docs.sparkSession
    if not stable:
        docs = stored(docs, work_path(spark, "shards"))
    # Labels hang on the splits of the scan, which follow from files and settings, not from the columns read.
    names = docs.columns
    rows = numbered(docs).withColumn("_row", F.monotonically_increasing_id())
    counted = rows.groupBy(F.shiftright("_row", POSITION_BITS).alias("part")).agg(F.count(F.lit(1)).alias("n"))
    found = {r["part"]: r["n"] for r in counted.collect()}
    if not found:
        return docs.select("*", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    parts = np.array(sorted(found), dtype=np.int64)
    counts = np.array([found[p] for p in parts], dtype=np.int64)
    matrix = communication_matrix(counts, shards, np.random.default_rng(seed))
    blocks = max(1, -(-int(counts.sum()) // (shards * block_rows)))
    shared = spark.sparkContext.broadcast((parts, matrix))
    held: dict[int, tuple] = {}

    def deal(part: int):
        if part not in held:
            held.clear()
            known, rows = shared.value
            at = int(np.searchsorted(known, part))
            if at >= len(known) or known[at] != part:
                raise RuntimeError("a partition has appeared since the rows were counted")
            rng = np.random.default_rng([seed, part, 1])
            labels = rng.permutation(np.repeat(np.arange(shards, dtype=np.int32), rows[at]))
            held[part] = labels, rng.integers(0, blocks, len(labels), dtype=np.int32), rng.integers(0, 2**62, len(labels), dtype=np.int64)
        return held[part]

    @F.pandas_udf("struct<shard:int,block:int,lot:long>")
    def dealt(row: pd.Series) -> pd.DataFrame:
        out = []
        numbers = row.to_numpy(np.int64)
        part_of = numbers >> POSITION_BITS
        cuts = np.flatnonzero(np.diff(part_of)) + 1
        for chunk in np.split(numbers, cuts):
            if not len(chunk):
                continue
            labels, block, lot = deal(int(chunk[0] >> POSITION_BITS))
            at = chunk & ((1 << POSITION_BITS) - 1)
            if at[-1] >= len(labels):
                raise RuntimeError("a partition has grown since its rows were counted")
            out.append(pd.DataFrame({"shard": labels[at], "block": block[at], "lot": lot[at]}))
        return pd.concat(out) if out else pd.DataFrame({"shard": [], "block": [], "lot": []})

    placed = rows.withColumn("_to", dealt("_row"))
    # The same labels again, without the rows: how many rows each block of each shard gets.
    sizes = placed.groupBy("_to.shard", "_to.block").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start"))
    in_block = Window.partitionBy("shard", "_block").orderBy("_lot", "_row")
    moved = placed.select(
        "*",
        F.col("_to.shard").alias("shard"),
        F.col("_to.block").alias("_block"),
        F.col("_to.lot").alias("_lot"),
    ).withColumn("_place", F.row_number().over(in_block))
    # One row per block: far fewer than rows of the table, yet joined by size, not by decree.
    joined = moved.join(starts.select("shard", F.col("block").alias("_block"), "_start"), ["shard", "_block"])
    return joined.select(
        *named_back(names),
        "shard",
        (F.col("_start") + F.col("_place") - 1).cast("long").alias("slot"),
    )
