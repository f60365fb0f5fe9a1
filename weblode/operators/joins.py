"""Lookups that stay even when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A key with more than one in this many rows is hot, so there are always fewer hot keys than this.
HOT_SHARE = 1000


def hot_keys(rows: DataFrame, on: Sequence[str]) -> DataFrame:
    """The keys that hold more than their share of the rows; fewer than ``HOT_SHARE`` of them.

    Counts are combined before the shuffle, so finding a hot key is not itself skewed.
    """
    total = rows.agg(F.count("*").alias("total")).scalar()
    counted = rows.groupBy(*on).agg(F.count("*").alias("rows"))
    return counted.where(F.col("rows") * HOT_SHARE > total).select(*on)


def looked_up(
    rows: DataFrame, known: DataFrame, on: Sequence[str], value: str, hot: DataFrame | None = None
) -> DataFrame:
    """Rows with the ``value`` that ``known`` has for their key, NULL if it has none.

    ``known`` has one row per key. Rows of hot keys get theirs from a broadcast of the hot keys
    alone, whose number is bounded; all others are joined by key. In that join, hot rows and rows
    without a key carry spread-out keys, so no task receives a whole hot group.
    """
    hot = hot_keys(rows.select(*on), on) if hot is None else hot
    known = known.select(*[F.col(c).try_cast(rows.schema[c].dataType).alias(c) for c in on], value)
    hits = known.join(F.broadcast(hot), list(on)).select(*on, F.col(value).alias("hot_value"))
    flagged = hot.join(F.broadcast(hits), list(on), "left").withColumn("is_hot", F.lit(True))
    marked = rows.join(F.broadcast(flagged), list(on), "left")
    keyless = reduce(lambda a, b: a | b, (F.col(c).isNull() for c in on))
    # The second join key is the hash of the key itself, or of the whole row where rows are to be spread.
    # A constant would not do: the optimizer would take it out of the join keys.
    whole_row = F.xxhash64(*[f.name for f in rows.schema if not isinstance(f.dataType, T.MapType)])
    marked = marked.withColumn("spread", F.when(F.col("is_hot") | keyless, whole_row).otherwise(F.xxhash64(*on)))
    cold = known.select(*on, F.col(value).alias("cold_value"), F.xxhash64(*on).alias("spread"))
    joined = marked.join(cold, [*on, "spread"], "left")
    found = F.when(F.col("is_hot"), F.col("hot_value")).otherwise(F.col("cold_value"))
    return joined.select(*rows.columns, found.alias(value))
