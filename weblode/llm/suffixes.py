"""Repeated passages by interval expansion on a Burrows-Wheeler transform."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.llm.common import quoted
from weblode.session import stored, work_path

LENGTH = 400
CHUNK_BYTES = 1 << 21  # documents are read in parts of about this size
RUN_BYTES = 1 << 20  # strings of one transform
HOT_CONTEXTS = 1_000  # a key with more different contexts is settled window by window
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
LETTERS = np.random.default_rng(11).integers(1, 2**63, 256, dtype=np.uint64)


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def window_minima(keys: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by running minima from both ends of blocks."""
    n = len(keys) - width + 1
    padded = np.full(-(-len(keys) // width) * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(keys)] = keys
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def contexts(data: np.ndarray, ends: np.ndarray, length: int):
    """(anchor hash, context hash, first byte, starts) for the windows of ``length`` bytes inside texts.

    ``ends`` holds each byte's end of text. A window belongs to the leftmost of its half-windows with the smallest hash;
    windows with one such anchor follow each other, and all bytes they cover are the anchor's context. Equal
    windows have equal anchors, so they meet under the anchor's hash, and each window is in one context.
    """
    gram = length // 2
    none = np.zeros(0, dtype=np.int64)
    if len(data) < length:
        return none.view(np.uint64), none.view(np.uint64), none, none
    scale = powers(BASE, len(data))
    total = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(LETTERS[data] * scale, out=total[1:])
    back = powers(INVERSE, len(data))
    hashes = mixed((total[gram:] - total[:-gram]) * back[: len(data) - gram + 1])
    keys = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
    anchor = (window_minima(keys, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    starts = np.flatnonzero(np.arange(len(anchor)) + length <= ends[: len(anchor)])
    if not len(starts):
        return none.view(np.uint64), none.view(np.uint64), none, none
    own = anchor[starts]
    cut = np.flatnonzero((np.diff(starts) != 1) | (np.diff(own) != 0)) + 1
    first = starts[np.concatenate(([0], cut))]
    count = np.diff(np.concatenate(([0], cut, [len(starts)])))
    at = anchor[first]
    # Where the anchor lies within the context is part of what is compared.
    whole = mixed((total[first + count + length - 1] - total[first]) * back[first])
    whole = mixed(whole ^ (count.astype(np.uint64) << np.uint64(32)) ^ (at - first).astype(np.uint64))
    return hashes[at], whole, first, count


ANCHOR_DDL = "kind int, h long, c long, n int, row long, at int, starts int"


def anchor_rows(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Contexts (kind 0), once per part of the documents with their number, and spans that repeat in the part (kind 1)."""
    for rows, texts in text_parts(batches):
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        offsets = np.cumsum(sizes) - sizes
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        h, c, first, count = contexts(data, np.repeat(offsets + sizes, sizes), length)
        if not len(h):
            continue
        order = np.lexsort((first, c, h))
        h, c, first, count = h[order], c[order], first[order], count[order]
        new = np.concatenate(([True], (h[1:] != h[:-1]) | (c[1:] != c[:-1])))
        heads = np.flatnonzero(new)
        n = np.diff(np.concatenate((heads, [len(h)])))
        doc = np.searchsorted(offsets, first, "right") - 1
        # Empty texts share their offset with the text that follows them; the last one at an offset holds it.
        row, at = np.array(rows, dtype=np.int64)[doc], first - offsets[doc]
        often = np.flatnonzero(np.repeat(n > 1, n))
        spans = merged(row[often], at[often], at[often] + count[often] - 1 + length)
        yield pa.RecordBatch.from_pydict(
            {
                "kind": pa.array(np.concatenate((np.zeros(len(heads)), np.ones(len(spans[0])))), pa.int32()),
                "h": pa.array(np.concatenate((h[heads].view(np.int64), spans[0] * 0))),
                "c": pa.array(np.concatenate((c[heads].view(np.int64), spans[0] * 0))),
                "n": pa.array(np.concatenate((np.minimum(n, 2), spans[0] * 0)), pa.int32()),
                "row": pa.array(np.concatenate((row[heads], spans[0]))),
                "at": pa.array(np.concatenate((at[heads], spans[1])), pa.int32()),
                "starts": pa.array(np.concatenate((count[heads], spans[2] - spans[1] - length + 1)), pa.int32()),
            }
        )


def merged(row: np.ndarray, start: np.ndarray, stop: np.ndarray):
    """Spans of each row joined where they overlap or touch."""
    order = np.lexsort((start, row))
    row, start, stop = row[order], start[order], stop[order]
    if not len(row):
        return row, start, stop
    base = np.concatenate(([0], np.cumsum(row[1:] != row[:-1]))) * (np.int64(1) << 40)
    reach = np.maximum.accumulate(stop + base)
    new = np.concatenate(([True], (start + base)[1:] > reach[:-1]))
    heads = np.flatnonzero(new)
    tails = np.concatenate((heads[1:], [len(row)])) - 1
    return row[heads], start[heads], reach[tails] - base[tails]


def text_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[bytes]]]:
    rows, texts, size = [], [], 0
    for batch in batches:
        for row, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            rows.append(row)
            texts.append(text.as_py() or b"")
            size += len(texts[-1])
            if size >= CHUNK_BYTES:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes sorted by their first ``depth`` symbols or more (symbols up to 256), by doubling."""
    n = len(text)
    packed = np.zeros(n, dtype=np.int64)
    padded = np.concatenate((text.astype(np.int64), np.zeros(8, dtype=np.int64)))
    for i in range(7):
        packed = (packed << 9) | padded[i : i + n]
    seen = 7
    while True:
        order = np.argsort(packed, kind="stable")
        new = np.concatenate(([0], packed[order[1:]] != packed[order[:-1]]))
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(new)
        if seen >= depth or new.sum() == n - 1:
            return order
        ahead = np.zeros(n, dtype=np.int64)
        ahead[: n - seen] = rank[seen:] + 1
        packed = (rank << 32) | ahead
        seen *= 2


def expanded(bwt: np.ndarray, length: int) -> np.ndarray:
    """Boundaries between neighbouring suffixes whose common prefix is shorter than ``length``.

    Intervals of strings grow to the left by one symbol per round, breadth first, so that a boundary is met first by the
    shortest string that ends there: common prefixes come in increasing order, and the walk stops at ``length``.
    Symbol 0 separates strings and is never taken.
    """
    n = len(bwt)
    by_symbol = np.argsort(bwt, kind="stable")
    to = np.empty(n, dtype=np.int64)
    to[by_symbol] = np.arange(n)
    same = bwt[by_symbol[1:]] == bwt[by_symbol[:-1]]
    following, previous = np.full(n, n, dtype=np.int64), np.full(n, -1, dtype=np.int64)
    following[by_symbol[:-1][same]] = by_symbol[1:][same]
    previous[by_symbol[1:][same]] = by_symbol[:-1][same]
    known = np.zeros(n + 1, dtype=bool)
    low, high = np.array([0]), np.array([n])
    for _ in range(length):
        size = high - low
        rows = np.arange(size.sum()) + np.repeat(low - (np.cumsum(size) - size), size)
        taken = bwt[rows] != 0
        firsts = np.sort(to[rows[taken & (previous[rows] < np.repeat(low, size))]])
        lasts = np.sort(to[rows[taken & (following[rows] >= np.repeat(high, size))]]) + 1
        new = ~known[lasts]
        low, high = firsts[new], lasts[new]
        known[high] = True
        if not len(low):
            break
    return known


def repeated_starts(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string the places where ``length`` bytes begin that also begin somewhere else among the strings."""
    sizes = np.array([len(s) for s in strings], dtype=np.int64)
    stops = np.cumsum(sizes + 1) - 1
    text = np.frombuffer(b"\x00".join(strings) + b"\x00", dtype=np.uint8).astype(np.int16) + np.int16(1)
    text[stops] = 0
    order = suffix_order(text, length + 1)
    known = expanded(text[order - 1], length)
    left = np.repeat(stops, sizes + 1) - np.arange(len(text))
    long_enough = left[order] >= length
    alike = ~known[1:-1] & long_enough[1:] & long_enough[:-1]
    found = np.zeros(len(text), dtype=bool)
    found[order[1:][alike]] = True
    found[order[:-1][alike]] = True
    return [np.flatnonzero(found[stop - size : stop]) for stop, size in zip(stops, sizes, strict=True)]


def settle(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Spans (row, start, stop) of single contexts; rows of a key ``h`` follow each other."""

    def run(held):
        rows, starts, stops = [], [], []
        for (_, n, row, at, _), found in zip(held, repeated_starts([x[4] for x in held], length), strict=True):
            if n == 1 and len(found):
                rows.append(np.full(len(found), row))
                starts.append(found + at)
        if rows:
            row, start = np.concatenate(rows), np.concatenate(starts)
            row, start, stop = merged(row, start, start + length)
            yield pa.RecordBatch.from_pydict({"row": pa.array(row, pa.int64()), "start": pa.array(start, pa.int32()), "stop": pa.array(stop, pa.int32())})

    held, size, last = [], 0, None
    for batch in batches:
        for x in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if size >= RUN_BYTES and x[0] != last:
                yield from run(held)
                held, size = [], 0
            held.append(x)
            size += len(x[4])
            last = x[0]
    if held:
        yield from run(held)


def repeated_spans(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(row, start, stop): bytes covered by a string of ``length`` bytes that starts elsewhere too.

    ``docs`` has ``row`` (unique) and ``data`` (binary). Every window has one context. A context that occurs twice repeats
    whole, wherever it stands; a key with one context needs nothing more. Only where a key has different contexts are their bytes
    fetched, each once, and compared by the transform. A key with more than ``HOT_CONTEXTS`` of them (a passage
    in very many documents has as many different surroundings) is counted window by window instead.
    """
    spark = docs.sparkSession
    found = docs.select("row", "data").mapInArrow(lambda b: anchor_rows(b, length), ANCHOR_DDL)
    found = stored(found, work_path(spark, "contexts"))
    rows = found.where("kind = 0").drop("kind")
    near = found.where("kind = 1")
    end = (F.col("at") + F.col("starts") + (length - 1)).alias("stop")
    spans = near.select("row", F.col("at").alias("start"), end)

    # One row per context, and per key how many contexts it has; both are combined before they are shuffled.
    per_context = rows.groupBy("h", "c").agg(F.sum("n").alias("n"), F.min(F.struct("row", "at", "starts")).alias("one"))
    per_key = per_context.groupBy("h").agg(F.count(F.lit(1)).alias("m"), F.sum("n").alias("all"))
    keys = stored(per_key.where("all > 1"), work_path(spark, "keys"))
    kept = stored(per_context.join(keys.select("h", "m"), "h"), work_path(spark, "shared"))

    often = kept.where("n > 1").select("h", "c", F.lit(True).alias("often"))
    whole = rows.where("n = 1").join(often, ["h", "c"]).select("row", F.col("at").alias("start"), end)

    ones = kept.where("m > 1").select("h", F.least("n", F.lit(2)).cast("int").alias("n"), F.col("one.row").alias("row"), F.col("one.at").alias("at"), F.col("one.starts").alias("starts"), "m")
    taken = ones.join(docs.select("row", "data"), "row")
    taken = taken.select("h", "n", "row", "at", F.substring("data", F.col("at") + 1, F.col("starts") + (length - 1)).alias("bytes"), "starts", "m")
    taken = stored(taken, work_path(spark, "bytes"))

    tasks = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cold = taken.where(F.col("m") <= HOT_CONTEXTS).select("h", "n", "row", "at", "bytes").repartition(tasks, "h").sortWithinPartitions("h")
    settled = cold.mapInArrow(lambda b: settle(b, length), "row long, start int, stop int")

    each = taken.where(F.col("m") > HOT_CONTEXTS).select("n", "row", "at", "bytes", F.explode(F.sequence(F.lit(0), F.col("starts") - 1)).alias("i"))
    window = F.substring("bytes", F.col("i") + 1, length)
    each = each.select("n", "row", (F.col("at") + F.col("i")).cast("int").alias("start"), F.xxhash64(F.lit(1), window).alias("x"), F.xxhash64(F.lit(2), window).alias("y"))
    twice = each.groupBy("x", "y").agg(F.sum("n").alias("all")).where("all > 1").select("x", "y")
    hot = each.where("n = 1").join(twice, ["x", "y"]).select("row", "start", (F.col("start") + length).cast("int").alias("stop"))
    return spans.unionByName(whole).unionByName(settled).unionByName(hot)


def without_repeats(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", length: int = LENGTH, stable: bool = False) -> DataFrame:
    """One row per row of ``docs``: its id, ``n_bytes``, removed ``spans`` and the ``kept`` bytes.

    Texts are UTF-8 bytes, null counts as empty. Every byte covered by a string of ``length`` bytes that also starts anywhere
    else, in the same text or another, is removed; strings never cross texts and are judged on the input. What is kept need not be
    valid UTF-8. Repeated rows are each other's copies, so their long texts go; an empty table gives an empty result; further columns
    do not matter.

    Rows are known by a number that is written to the shared folder with their text, once, and read from there by every
    later job. ``stable`` changes nothing; it is kept for callers that pass it.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(quoted(id_column)).alias("id"), F.coalesce(F.col(quoted(text_column)).cast("string"), F.lit("")).cast("binary").alias("data"))
    numbered = stored(texts.withColumn("row", F.monotonically_increasing_id()), work_path(spark, "texts"))
    spans = repeated_spans(numbered, length)
    per_row = spans.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("marks"))

    @F.pandas_udf(T.StructType.fromDDL("kept binary, spans array<struct<start:int,stop:int>>"))
    def cut(data: pd.Series, marks: pd.Series) -> pd.DataFrame:
        kept, removed = [], []
        for text, found in zip(data, marks, strict=True):
            if found is None or not len(found):
                kept.append(text)
                removed.append([])
                continue
            at = np.array([(m["start"], m["stop"]) for m in found], dtype=np.int64)
            _, start, stop = merged(np.zeros(len(at), dtype=np.int64), at[:, 0], at[:, 1])
            edges = [0, *np.stack((start, stop), axis=1).ravel().tolist(), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
            removed.append([{"start": a, "stop": b} for a, b in zip(start.tolist(), stop.tolist(), strict=True)])
        return pd.DataFrame({"kept": kept, "spans": removed})

    joined = numbered.join(per_row, "row", "left").withColumn("cut", cut("data", "marks"))
    return joined.select(F.col("id").alias(id_column), F.octet_length("data").cast("long").alias("n_bytes"), "cut.spans", "cut.kept")
