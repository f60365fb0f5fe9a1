"""An interpolated modified Kneser-Ney bigram model, counted and looked up in Spark."""

from __future__ import annotations

import tempfile
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.llm.common import quoted
from weblode.session import stored, work_path

BLOCK_BYTES = 6 << 20  # text that one block of documents holds, about
HOT_TOKENS = 1 << 20  # a context's continuations are dealt to one more bucket for each so many tokens
END = b""  # the end of a text; also what stands before its first word
ROW_DDL = "kind int, block long, bucket int, a binary, b binary, c binary, d binary, e binary"
STREAM, WORDS, BACK, PART, STATS = range(5)


def pack(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on, byte plane after byte plane, compressed."""
    values = np.ascontiguousarray(values, dtype="<u8")
    width = max(1, (int(values.max()).bit_length() + 7) // 8) if len(values) else 1
    planes = values.view(np.uint8).reshape(-1, 8)[:, :width].T
    return bytes([width]) + zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(data: bytes) -> np.ndarray:
    width, planes = data[0], np.frombuffer(zstandard.ZstdDecompressor().decompress(data[1:]), dtype=np.uint8)
    n = len(planes) // width
    out = np.zeros((n, 8), dtype=np.uint8)
    out[:, :width] = planes.reshape(width, n).T
    return out.view("<u8").ravel().astype(np.int64)


def pack_sorted(values: np.ndarray) -> bytes:
    """Ascending unsigned numbers as steps."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).view(np.uint64), dtype=np.uint64)


def mapped(values: np.ndarray) -> np.ndarray:
    """The array in an unnamed file, mapped into memory: the system may drop its pages at any time."""
    if not values.nbytes:
        return values
    with tempfile.TemporaryFile() as file:
        values.tofile(file)
        file.flush()
        return np.memmap(file, dtype=values.dtype, mode="r", shape=values.shape)


def scattered(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(31))


def rows_of(kind: int, block, bucket, *payloads) -> dict:
    return {"kind": kind, "block": block, "bucket": bucket} | dict(zip("abcde", payloads, strict=False))


def batch_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in rows], f.type) for f in schema], schema=schema)


ROW_ARROW = pa.schema([("kind", pa.int32()), ("block", pa.int64()), ("bucket", pa.int32()), *[(n, pa.binary()) for n in "abcde"]])


def count_words(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per block of documents: a stream of word numbers (STREAM) and, per bucket, the sorted hashes of its words (WORDS).

    The numbers go by (bucket, hash), so the block's words are the buckets' arrays one after the other.
    """
    number, schema = 0, None
    ids, learn, sizes, sequence, size = [], [], [], [], 0
    known = defaultdict()
    known.default_factory = known.__len__

    def block():
        words = list(known)
        hashes = np.array([xxhash.xxh64_intdigest(w) for w in words], dtype=np.uint64)
        of = (hashes % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((hashes, of))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        tokens = place[np.array(sequence, dtype=np.int64)]
        lengths = np.array(sizes, dtype=np.int64)
        counts = np.bincount(tokens[np.repeat(np.array(learn, dtype=bool), lengths)], minlength=len(words))
        name = (TaskContext.get().partitionId() << 24) + number
        rows = [rows_of(STREAM, name, -1, pack(tokens), pack(lengths), pack(place[known[END] : known[END] + 1])) | {"ids": ids, "learn": learn}]
        cuts = np.searchsorted(of[order], np.arange(buckets + 1))
        for b in np.flatnonzero(np.diff(cuts)).tolist():
            at = order[cuts[b] : cuts[b + 1]]
            rows.append(rows_of(WORDS, name, b, pack_sorted(hashes[at]), pack(counts[cuts[b] : cuts[b + 1]])))
        return batch_of(rows, schema)

    for batch in batches:
        schema = pa.schema([*ROW_ARROW, pa.field("ids", pa.list_(batch.schema.field("id").type)), pa.field("learn", pa.list_(pa.bool_()))])
        for key, keep, text in zip(batch.column("id").to_pylist(), batch.column("learn").to_pylist(), batch.column("text"), strict=True):
            data = (text.as_py() or "").encode().lower()
            words = data.split()
            words.append(END)
            sequence += map(known.__getitem__, words)
            ids.append(key)
            learn.append(keep)
            sizes.append(len(words))
            size += len(data)
            if size >= BLOCK_BYTES:
                yield block()
                number += 1
                ids, learn, sizes, sequence, size = [], [], [], [], 0
                known.clear()
    if ids:
        yield block()


def number_words(table: pa.Table, buckets: int) -> pa.Table:
    """A number for each word of a bucket, the most frequent first, and its count: returned to each block (WORDS)."""
    rows = table.to_pylist()
    hashes = [unpack_sorted(r["a"]) for r in rows]
    counts = np.concatenate([unpack(r["b"]) for r in rows])
    words, of = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(of, weights=counts, minlength=len(words)).astype(np.int64)
    rank = np.empty(len(words), dtype=np.int64)
    rank[np.lexsort((words, -total))] = np.arange(len(words))
    bucket = rows[0]["bucket"]
    out, at = [], 0
    for r, h in zip(rows, hashes, strict=True):
        own = of[at : at + len(h)]
        at += len(h)
        out.append(rows_of(WORDS, r["block"], bucket, pack(rank[own] * buckets + bucket), pack(total[own])))
    out.append(rows_of(STATS, -1, bucket, pack(np.array([total.sum(), (total > 0).sum()]))))
    return pa.Table.from_batches([batch_of(out, ROW_ARROW)])


class Block:
    """A block's documents with the global numbers and counts of its words."""

    def __init__(self, table: pa.Table):
        rows = table.select([n for n in table.column_names if n not in ("ids", "learn")]).to_pylist()
        words = sorted((r for r in rows if r["kind"] == WORDS), key=lambda r: r["bucket"])
        stream = next(i for i, r in enumerate(rows) if r["kind"] == STREAM)
        self.name = rows[stream]["block"]
        self.rows = rows
        self.ids = table.column("ids")[stream].as_py()
        self.learn = np.array(table.column("learn")[stream].as_py(), dtype=bool)
        self.tokens, self.lengths = unpack(rows[stream]["a"]), unpack(rows[stream]["b"])
        end = int(unpack(rows[stream]["c"])[0])
        self.number = np.concatenate([unpack(r["a"]) for r in words])
        self.count = np.concatenate([unpack(r["b"]) for r in words])
        before = np.concatenate(([end], self.tokens[:-1]))
        before[np.cumsum(self.lengths)[:-1]] = end
        self.pairs, self.pair_of = np.unique(before * len(self.number) + self.tokens, return_inverse=True)
        self.first, self.second = np.divmod(self.pairs, len(self.number))

    def routed(self, buckets: int):
        """(order, cuts) of the pairs by bucket, then by number. A frequent context is dealt to several buckets by its continuation."""
        u, w = self.number[self.first], self.number[self.second]
        ways = 1 + self.count[self.first] // HOT_TOKENS
        part = (scattered(w, w) % ways.astype(np.uint64)).astype(np.int64)
        of = (scattered(u, part) % np.uint64(buckets)).astype(np.int64)
        order = np.lexsort((w, u, of))
        return order, np.searchsorted(of[order], np.arange(buckets + 1))


def count_pairs(table: pa.Table, buckets: int) -> pa.Table:
    """A block's distinct pairs with their training counts, by bucket."""
    block = Block(table)
    learned = np.bincount(block.pair_of[np.repeat(block.learn, block.lengths)], minlength=len(block.pairs))
    order, cuts = block.routed(buckets)
    u, w, n = block.number[block.first[order]], block.number[block.second[order]], learned[order]
    out = []
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = slice(cuts[b], cuts[b + 1])
        contexts, runs = np.unique(u[own], return_counts=True)
        out.append(rows_of(BACK, block.name, b, pack_sorted(contexts), pack(runs), pack(w[own]), pack(n[own])))
    return pa.Table.from_batches([batch_of(out, ROW_ARROW)])


def add_pairs(table: pa.Table, buckets: int) -> pa.Table:
    """Corpus counts of a bucket's pairs: for each block (BACK), summed by context and by continuation (PART), and their counts' counts."""
    rows = table.to_pylist()
    bucket = rows[0]["bucket"]
    u = np.concatenate([np.repeat(unpack_sorted(r["a"]).astype(np.int64), unpack(r["b"])) for r in rows])
    w = np.concatenate([unpack(r["c"]) for r in rows])
    n = np.concatenate([unpack(r["d"]) for r in rows])
    contexts, context_of = np.unique(u, return_inverse=True)
    continuations, continuation_of = np.unique(w, return_inverse=True)
    pairs, pair_of = np.unique(context_of * len(continuations) + continuation_of, return_inverse=True)
    total = np.bincount(pair_of, weights=n, minlength=len(pairs)).astype(np.int64)
    back, out, at = total[pair_of], [], 0
    for r in rows:
        size = int(unpack(r["b"]).sum())
        out.append(rows_of(BACK, r["block"], bucket, pack(back[at : at + size])))
        at += size
    of_context, of_word = np.divmod(pairs, len(continuations))
    seen = total > 0
    sums = np.bincount(of_context, weights=total, minlength=len(contexts)).astype(np.int64)
    classes = [np.bincount(of_context[(total == k) if k < 3 else (total >= 3)], minlength=len(contexts)) for k in (1, 2, 3)]
    kinds = np.bincount(of_word[seen], minlength=len(continuations))
    numbers = np.union1d(contexts[sums > 0], continuations[kinds > 0])
    values = np.zeros((5, len(numbers)), dtype=np.int64)
    values[0, np.searchsorted(numbers, continuations[kinds > 0])] = kinds[kinds > 0]
    for i, v in enumerate((sums, *classes), start=1):
        values[i, np.searchsorted(numbers, contexts[sums > 0])] = v[sums > 0]
    home = numbers % buckets
    order = np.lexsort((numbers, home))
    cuts = np.searchsorted(home[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        own = order[cuts[b] : cuts[b + 1]]
        out.append(rows_of(PART, -1, b, pack_sorted(numbers[own]), pack(values[:, own].ravel())))
    out.append(rows_of(STATS, -1, bucket, pack(np.array([seen.sum(), *[(total == k).sum() for k in (1, 2, 3, 4)]]))))
    return pa.Table.from_batches([batch_of(out, ROW_ARROW)])


def add_parts(table: pa.Table, buckets: int) -> pa.Table:
    """For each block, what its words are as continuations and as contexts (PART): kinds before it, tokens and kinds after it."""
    rows = table.to_pylist()
    bucket = rows[0]["bucket"]
    asked = [(r["block"], unpack(r["a"]) // buckets) for r in rows if r["kind"] == WORDS]
    given = [(unpack_sorted(r["a"]).astype(np.int64) // buckets, unpack(r["b"])) for r in rows if r["kind"] == PART]
    n = 1 + max([0, *(int(x.max()) for _, x in asked), *(int(x.max()) for x, _ in given)])
    values = np.zeros((5, n), dtype=np.int64)
    for rank, found in given:
        values[:, rank] += found.reshape(5, -1)
    out = [rows_of(PART, block, bucket, pack(values[:, rank].ravel())) for block, rank in asked]
    kinds = values[0]
    out.append(rows_of(STATS, -1, bucket, pack(np.array([kinds.sum(), *[(kinds == k).sum() for k in (1, 2, 3, 4)]]))))
    return pa.Table.from_batches([batch_of(out, ROW_ARROW)])


def discounts(n1: int, n2: int, n3: int, n4: int) -> np.ndarray:
    """What is taken from counts 0, 1, 2 and 3 or more; plain fractions where counts of counts are missing."""
    if not min(n1, n2, n3, n4):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    out = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
    return np.array([0, *[min(max(d, 0.05), k - 0.05) for k, d in enumerate(out, start=1)]])


def score_block(table: pa.Table, buckets: int, totals: dict, schema: pa.Schema) -> pa.Table:
    """The scores of a block's documents from the part of the model that its words and pairs need."""
    block = Block(table)
    order, _ = block.routed(buckets)
    back = sorted((r for r in block.rows if r["kind"] == BACK), key=lambda r: r["bucket"])
    parts = sorted((r for r in block.rows if r["kind"] == PART), key=lambda r: r["bucket"])
    pair_count = np.empty(len(block.pairs), dtype=np.int64)
    pair_count[order] = np.concatenate([unpack(r["a"]) for r in back])
    values = np.concatenate([unpack(r["a"]).reshape(5, -1) for r in parts], axis=1)
    kinds, after = values[0], values[1]
    tokens, distinct, pairs = totals["tokens"], totals["distinct"], totals["pairs"]
    low, high = discounts(*totals["kind_counts"]), discounts(*totals["pair_counts"])
    even = 1 / (distinct + 1)
    if pairs:
        counts = np.array(totals["kind_counts"][:2], dtype=float)
        taken = low[1] * counts[0] + low[2] * counts[1] + low[3] * (totals["words_after"] - counts.sum())
        single = np.maximum(kinds - low[np.minimum(kinds, 3)], 0) / pairs + taken / pairs * even
    else:
        single = np.full(len(kinds), even)
    weight = np.where(after > 0, (high[1:, None] * values[2:]).sum(axis=0) / np.maximum(after, 1), 1.0)
    own = np.maximum(pair_count - high[np.minimum(pair_count, 3)], 0) / np.maximum(after[block.first], 1)
    of_pair = mapped(np.log10(own + weight[block.first] * single[block.second]))
    of_word = mapped(np.log10((block.count + 0.1) / (tokens + 0.1 * (distinct + 1))))
    starts = np.cumsum(block.lengths) - block.lengths
    out = {
        "id": pa.array(block.ids, schema.field("id").type),
        "learn": block.learn,
        "n_tokens": block.lengths,
        "n_known": np.add.reduceat((block.count > 0)[block.tokens].astype(np.int64), starts),
        "base_score": np.add.reduceat(of_word[block.tokens], starts),
        "score": np.add.reduceat(of_pair[block.pair_of], starts),
    }
    return pa.table(out, schema=schema)


def learned_from(id_column: str = "doc_id") -> Column:
    """Nine rows in ten; rows without an id are learned from."""
    return F.coalesce(F.crc32(F.col(quoted(id_column)).cast("string").cast("binary")) % 10 != 0, F.lit(True))


def summed(table: DataFrame, n: int) -> list[int]:
    """The sums of the short lists in a table's STATS rows: one row per bucket, added in Spark."""
    read = F.udf(lambda data: unpack(bytes(data)).tolist(), T.ArrayType(T.LongType()))
    lists = table.where(F.col("kind") == STATS).select(read("a").alias("v"))
    row = lists.agg(*[F.coalesce(F.sum(F.col("v")[i]), F.lit(0)).alias(f"v{i}") for i in range(n)]).first()
    return list(row)


def scored(docs: DataFrame, learn: Column | None = None, id_column: str = "doc_id", text_column: str = "text", buckets: int | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``learn``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and ``score``.

    Tokens are what white space ``[\\x20\\x09-\\x0D]`` separates after lower-casing A-Z, then one end. ``score`` is the text's log10 probability under a
    bigram model learned from the rows where ``learn`` holds; ``base_score`` is that of single tokens with 0.1 added to counts. A null or empty
    text is one end. Repeated rows count as often as they occur. Without a row to learn from every token has the same probability. An
    empty table gives an empty result; further columns do not matter.

    The text is read once, into blocks of about ``BLOCK_BYTES``: numbers of words in a stream, and sorted hash arrays by bucket. Buckets
    number words, most frequent first, add up pairs, and send every block the counts its own words and pairs need. So no task holds the
    model, whatever its size, and a block is scored from arrays mapped into memory. Continuations of a frequent context are dealt to several
    buckets. Tables between steps are in the shared folder.
    """
    spark = docs.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    learn = learned_from(id_column) if learn is None else learn
    texts = docs.select(F.col(quoted(id_column)).alias("id"), learn.alias("learn"), F.col(quoted(text_column)).cast("string").alias("text"))
    id_kind = texts.schema["id"].dataType
    block_schema = T.StructType([*T.StructType.fromDDL(ROW_DDL).fields, T.StructField("ids", T.ArrayType(id_kind)), T.StructField("learn", T.ArrayType(T.BooleanType()))])

    def kept(frame: DataFrame, purpose: str) -> DataFrame:
        return stored(frame, work_path(spark, purpose))

    def each(frame: DataFrame, key: str, step, schema, *more) -> DataFrame:
        return frame.groupBy(key).applyInArrow(lambda table: step(table, buckets, *more), schema)

    counted = kept(texts.mapInArrow(lambda batches: count_words(batches, buckets), block_schema), "lm-blocks")
    streams = counted.where(F.col("kind") == STREAM)
    words = kept(each(counted.where(F.col("kind") == WORDS).drop("ids", "learn"), "bucket", number_words, ROW_DDL), "lm-words")
    of_blocks = streams.unionByName(words.where(F.col("kind") == WORDS), allowMissingColumns=True)
    pairs = kept(each(each(of_blocks, "block", count_pairs, ROW_DDL), "bucket", add_pairs, ROW_DDL), "lm-pairs")
    asked = words.where(F.col("kind") == WORDS).unionByName(pairs.where(F.col("kind") == PART))
    parts = kept(each(asked, "bucket", add_parts, ROW_DDL), "lm-parts")

    tokens, distinct = summed(words, 2)
    pair_kinds, *pair_counts = summed(pairs, 5)
    kinds, *kind_counts = summed(parts, 5)
    totals = {"tokens": tokens, "distinct": distinct, "pairs": kinds, "pair_counts": pair_counts, "kind_counts": kind_counts, "words_after": distinct}
    out_schema = T.StructType([T.StructField("id", id_kind), *T.StructType.fromDDL("learn boolean, n_tokens long, n_known long, base_score double, score double").fields])
    everything = of_blocks.unionByName(pairs.where(F.col("kind") == BACK), allowMissingColumns=True).unionByName(parts.where(F.col("kind") == PART), allowMissingColumns=True)

    def last(table: pa.Table, of: int) -> pa.Table:
        kind = table.schema.field("ids").type.value_type
        schema = pa.schema([("id", kind), ("learn", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base_score", pa.float64()), ("score", pa.float64())])
        return score_block(table, of, totals, schema)

    found = each(everything, "block", last, out_schema)
    return found.select(F.col("id").alias(id_column), "learn", "n_tokens", "n_known", F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")
