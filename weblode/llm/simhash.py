"""Near duplicates by SimHash fingerprints, compared through distances to pivots."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.llm.common import quoted
from weblode.session import stored, work_path

SHINGLE = 4
SEED = 42
RADIUS = 4
PIVOTS = 48
# Fingerprints that agree in all but RADIUS bits agree in at least two of six groups of bits.
GROUPS = 6
# A bucket with more fingerprints is compared in pairs of blocks of this size.
BLOCK = 2_000


def fingerprint(text: str | None, size: int = SHINGLE, seed: int = SEED) -> int:
    """64 bits, each set if more than half of the shingles' hashes have it; 0 without words."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = np.array([xxhash.xxh64_intdigest(s, seed) for s in shingles], dtype="<u8")
    votes = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 16):
        part = hashes[i : i + (1 << 16)]
        votes += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(votes * 2 > len(hashes), bitorder="little")
    return int(bits.view("<u8")[0])


@F.pandas_udf(T.LongType())
def fingerprints(texts: pd.Series) -> pd.Series:
    """Fingerprints as signed numbers."""
    return pd.Series(np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64))


def pivots(n: int = PIVOTS) -> np.ndarray:
    return np.random.default_rng(7).integers(0, 2**64, n, dtype=np.uint64, endpoint=False)


def distances(prints: np.ndarray, to: np.ndarray) -> np.ndarray:
    return np.bitwise_count(prints[:, None] ^ to[None, :]).astype(np.int8)


def close_pairs(a: np.ndarray, b: np.ndarray, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of fingerprints at ``radius`` or fewer differing bits, in batches.

    By the triangle inequality two such fingerprints differ by no more than the radius in their distance to
    any pivot. Pairs are met in order of the distance to the first pivot, within a window of that
    width; the table's other coordinates discard nearly all others, and what survives all is verified.
    """
    refs = pivots()
    table_b = distances(b, refs)
    order = np.argsort(table_b[:, 0], kind="stable")
    sorted_first = table_b[order, 0]
    table_b = table_b[order]
    table_a = distances(a, refs)
    low = np.searchsorted(sorted_first, table_a[:, 0] - radius, "left")
    high = np.searchsorted(sorted_first, table_a[:, 0] + radius, "right")
    step = max(1, (1 << 20) // max(1, len(b)))
    for s in range(0, len(a), step):
        size = high[s : s + step] - low[s : s + step]
        i = np.repeat(np.arange(s, s + len(size)), size)
        j = np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + np.repeat(low[s : s + step], size)
        for p in range(1, PIVOTS):
            if len(i) < 64:
                break
            near = np.abs(table_a[i, p] - table_b[j, p]) <= radius
            i, j = i[near], j[near]
        j = order[j]
        near = np.bitwise_count(a[i] ^ b[j]) <= radius
        yield i[near], j[near]


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The smallest member of each of ``n`` members' component."""
    root = np.arange(n)
    for i, j in pairs:
        while len(i):
            a, b = root[i], root[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            np.minimum.at(root, high, low)
            while True:
                up = root[root]
                if (up == root).all():
                    break
                root = up
            apart = root[i] != root[j]
            i, j = i[apart], j[apart]
    return root


def group_keys(prints) -> list:
    """Columns with the bits of each group; neighbouring bits go to different groups."""
    masks = [sum(1 << bit for bit in range(g, 64, GROUPS)) for g in range(GROUPS)]
    return [prints.bitwiseAND(F.lit(m - (1 << 64) if m >= 1 << 63 else m)) for m in masks]


def links(prints: DataFrame) -> DataFrame:
    """(high, low): links whose components are those of all pairs at RADIUS or fewer bits.

    ``prints`` holds each fingerprint once. Two within the radius share the bits of two groups, so each
    fingerprint goes to one bucket per pair of groups. A bucket gives no more links than it has members.
    """
    groups = group_keys(F.col("print"))
    pairs = list(combinations(range(GROUPS), 2))
    keys = F.array(*[F.xxhash64(F.lit(k), groups[i], groups[j]) for k, (i, j) in enumerate(pairs)])
    spread = prints.select("print", F.explode(keys).alias("bucket"))
    sizes = spread.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stored(sizes, work_path(prints.sparkSession, "buckets"))
    member = spread.join(sizes, "bucket")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("print", F.lit(1)), F.col("blocks")).cast("int")
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("own")).alias("x"), F.greatest(o, F.col("own")).alias("y")))
    dealt = member.withColumn("blocks", blocks).withColumn("own", own).select("bucket", "print", "own", F.explode(meets).alias("at"))
    place = F.xxhash64("bucket", "at.x", "at.y").alias("place")
    tasks = max(1, int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    routed = dealt.select(place, "print", (F.col("own") == F.col("at.x")).alias("first"), (F.col("at.x") == F.col("at.y")).alias("same"))
    sorted_rows = routed.repartition(tasks, "place").sortWithinPartitions("place")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, prints_, first, same in whole_groups(batches):
            print_ = prints_.view(np.uint64)
            if same[0]:
                members = print_
                found = close_pairs(members, members)
            else:
                a, b = print_[first], print_[~first]
                members = np.concatenate((a, b))
                found = ((i, j + len(a)) for i, j in close_pairs(a, b))
            members_order = np.argsort(members.view(np.int64))
            rank = np.empty(len(members), dtype=np.int64)
            rank[members_order] = np.arange(len(members))
            root = forest(len(members), ((rank[i], rank[j]) for i, j in found))
            of = members.view(np.int64)[members_order]
            high = np.flatnonzero(root != np.arange(len(root)))
            if len(high):
                yield pa.RecordBatch.from_pydict({"high": of[high], "low": of[root[high]]})

    return sorted_rows.mapInArrow(compare, "high long, low long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch]):
    """Columns of each run of rows with one ``place``; runs may cross batches."""
    rest = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(batch.num_columns)]
        if rest is not None:
            columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
        place = columns[0]
        if not len(place):
            continue
        cuts = [0, *(np.flatnonzero(place[1:] != place[:-1]) + 1).tolist()]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                yield [c[a:b] for c in columns]
        rest = [c[cuts[-1] :] for c in columns]
    if rest is not None and len(rest[0]) > 1:
        yield rest


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) for every node of ``edges`` (high, low): root is the smallest node reachable.

    Large-star and small-star rounds; each is written to the shared folder. A star is a minimum per node,
    combined before the shuffle, and rows of one node are never gathered.
    """
    spark = edges.sparkSession
    edges = stored(edges.where("high <> low").select(F.greatest("high", "low").alias("high"), F.least("high", "low").alias("low")).distinct(), work_path(spark, name))
    while True:
        both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("least")).select(F.col("high").alias("node"), F.least("least", "high").alias("least"))
        # Minima are written before they are joined: rows of a hub are then split by adaptive execution.
        least = stored(least, work_path(spark, name))
        large = both.join(least, both.high == least.node).where("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        large = stored(large.where("high <> low").distinct(), work_path(spark, name))
        down = stored(large.groupBy("high").agg(F.min("low").alias("least")), work_path(spark, name))
        joined = large.join(down, "high")
        small = joined.select(F.col("low").alias("high"), F.col("least").alias("low")).where("high <> low").unionByName(down.select("high", F.col("least").alias("low"))).distinct()
        small = stored(small, work_path(spark, name))
        same = small.exceptAll(edges).isEmpty() and edges.exceptAll(small).isEmpty()
        edges = small
        if same:
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root"))


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: its id, ``fingerprint`` (16 hexadecimal digits) and ``component_id``.

    Words are what white space ``[\\x20\\x09-\\x0D]`` separates after lower-casing A-Z; each run of four, repeats
    included, votes with its XXH64 (seed 42). A text of fewer words is one run; a null or empty text has
    fingerprint zero and is linked like any other. Fingerprints at four or fewer differing bits are
    linked, and ``component_id`` is the smallest id that can be reached (null ids are passed over; null if there is
    no other). Repeated rows share a component. An empty table gives an empty result; further columns do not matter.

    Equal fingerprints are one node, so copies cost nothing after the first step. A crowded bucket
    is compared in blocks, and only links of a spanning forest leave a task.
    """
    spark = docs.sparkSession
    printed = docs.select(F.col(quoted(id_column)).alias("id"), fingerprints(F.col(quoted(text_column)).cast("string")).alias("print"))
    printed = stored(printed, work_path(spark, "prints"))
    nodes = stored(printed.groupBy("print").agg(F.min("id").alias("least_id")), work_path(spark, "nodes"))
    found = components(links(nodes.select("print")))
    rooted = nodes.join(found.withColumnRenamed("node", "print"), "print", "left").select("print", "least_id", F.coalesce("root", "print").alias("root"))
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    classes = rooted.join(named, "root").select("print", "component_id")
    # Copies of one text may be a large share of the rows; the join has no other operator on its key, so adaptive execution can split them.
    return printed.join(classes, "print").select(
        F.col("id").alias(id_column),
        F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows whose id is the smallest of their component; rows without an id stay."""
    classes = near_duplicates(docs.select(quoted(id_column), quoted(text_column)), id_column, text_column)
    classes = stored(classes, work_path(docs.sparkSession, "classes"))
    key = quoted(id_column)
    gone = classes.where(F.col(key) != F.col("component_id")).select(F.col(key).alias("_gone")).distinct()
    return docs.join(gone, F.col(key) == F.col("_gone"), "left_anti")
