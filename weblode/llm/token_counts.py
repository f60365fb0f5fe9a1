"""Token counts: pieces are counted once per distinct pre-token and summed by documents' pre-token frequencies."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.llm.blocks import Counts, in_blocks, packed, row_sums, unpacked
from weblode.llm.common import partitions_of
from weblode.llm.pretokens import ByteLevel
from weblode.session import stored, work_path

LIMIT = 512
# Text of the pre-tokens that one bucket may hold, in bytes: a bound of a task's memory.
BUCKET_BYTES = 2 << 20
FIELDS = [
    T.StructField("n_bytes", T.BinaryType()),
    T.StructField("sizes", T.BinaryType()),
    T.StructField("keys", T.BinaryType()),
    T.StructField("times", T.BinaryType()),
    T.StructField("hash_steps", T.BinaryType()),
    T.StructField("order", T.BinaryType()),
    T.StructField("lengths", T.BinaryType()),
    T.StructField("words", T.BinaryType()),
    T.StructField("word_bytes", T.LongType()),
]


def frequencies(path: str) -> Callable[[list[str]], list]:
    """A function from texts to one block: each text's pre-token frequencies, the dictionary in order of a hash."""
    vocabulary = ByteLevel(path)

    def block(texts: list[str]) -> list:
        index: dict[str, int] = {}
        counts, n_bytes = Counts(), []
        for text in texts:
            n_bytes.append(len(text.encode()))
            times = Counter(vocabulary.cut_added(text))
            keys = np.fromiter((index.setdefault(w, len(index)) for w in times), np.int64, len(times))
            order = np.argsort(keys)
            counts.add(keys[order], np.fromiter(times.values(), np.int64, len(times))[order])
        words = [w.encode() for w in index]
        hashes = np.fromiter((xxhash.xxh32_intdigest(w) for w in words), np.int64, len(words))
        order = np.argsort(hashes)
        joined = b"".join([words[i] for i in order.tolist()])
        lengths = np.fromiter(map(len, words), np.int64, len(words))[order]
        # Places of the block's dictionary are in order of first use; ``words`` are in order of their hash.
        steps = np.diff(hashes[order], prepend=0)
        return [packed(np.array(n_bytes, np.int64)), *counts.packed(), packed(steps), packed(order), packed(lengths), joined, len(joined)]

    return block


def bucket_words(buckets: int) -> Callable:
    """(bucket, block, lengths, words): each block's dictionary cut by ranges of the hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, steps, lengths, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                sizes = unpacked(lengths)
                bucket = (np.cumsum(unpacked(steps)) * buckets) >> 32
                cuts = [0, *(np.flatnonzero(np.diff(bucket)) + 1).tolist(), len(sizes)] if len(sizes) else [0]
                ends = np.concatenate(([0], np.cumsum(sizes)))
                rows = [(int(bucket[a]), block, packed(sizes[a:b]), words[ends[a] : ends[b]]) for a, b in zip(cuts, cuts[1:], strict=False)]
                for at in range(0, len(rows), 4096):
                    part = list(zip(*rows[at : at + 4096], strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(part[0], pa.int32()), pa.array(part[1], pa.int64()), pa.array(part[2], pa.binary()), pa.array(part[3], pa.binary())], names=["bucket", "block", "lengths", "words"])

    return run


def counted(path: str) -> Callable:
    """(block, bucket, pieces): the number of pieces of each word; a bucket's distinct words are counted once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, known, at = ByteLevel(path), {}, None
        for batch in batches:
            out: list[tuple] = []
            for bucket, block, lengths, words in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != at:
                    at, known = bucket, {}
                stops = np.cumsum(unpacked(lengths)).tolist()
                cut = [words[a:b] for a, b in zip([0, *stops], stops, strict=False)]
                for word in cut:
                    if word not in known:
                        text = word.decode()
                        known[word] = 1 if text in vocabulary.added else len(vocabulary.pieces(text))
                out.append((block, bucket, packed(np.array([known[w] for w in cut], np.int64))))
            columns = list(zip(*out, strict=True)) or [(), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), pa.array(columns[2], pa.binary())], names=["block", "bucket", "pieces"])

    return run


def summed(limit: int) -> Callable:
    """Each document's sum of pieces times frequency."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                n_bytes, sizes, keys, times, order, parts = (batch.column(c)[i].as_py() for c in ("n_bytes", "sizes", "keys", "times", "order", "parts"))
                in_order = np.concatenate([np.zeros(0, np.int64), *[unpacked(p["pieces"]) for p in parts or []]])
                pieces = np.zeros(len(in_order), np.int64)
                pieces[unpacked(order)] = in_order
                totals = row_sums(unpacked(sizes), pieces[unpacked(keys)] * unpacked(times))
                ids = batch.column("ids")[i].values
                yield pa.RecordBatch.from_arrays([ids, pa.array(unpacked(n_bytes)), pa.array(totals), pa.array(totals > limit)], names=["id", "n_bytes", "n_tokens", "over_limit"])

    return run


def token_counts(docs: DataFrame, vocabulary_path: str, id_column: str = "doc_id", text_column: str = "text", limit: int = LIMIT) -> DataFrame:
    """(id, ``n_bytes``, ``n_tokens``, ``over_limit``) of every row, for a byte-level BPE file of the tokenizers library.

    The tokens are those of the library without begin, end or added tokens; a special token's string in a text is that one
    token. No ids of a document are made: a text gives how often each of its pre-tokens occurs, every distinct
    pre-token of the corpus is cut into pieces once, in the bucket of its hash, and their numbers come back to the blocks.

    A null or empty text has 0 bytes and 0 tokens. Repeated rows and null ids are rows like others. A text of any length is one
    row of one block; a word of any length is one pre-token, whose merging the library does with a heap. An empty table gives an
    empty result; further columns do not matter, whatever their names. The vocabulary is a file of the workers'
    machines; one of another kind is a ValueError.
    """
    spark = docs.sparkSession
    made = in_blocks(docs, id_column, text_column, lambda: frequencies(vocabulary_path), FIELDS)
    path = work_path(spark, "pretokens")
    made.write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(made.schema).parquet(path)
    total = blocks.agg(F.coalesce(F.sum("word_bytes"), F.lit(0))).first()[0]
    # The dictionaries together are at least as large as the distinct pre-tokens.
    buckets = max(partitions_of(docs), -(-total // BUCKET_BYTES))
    words = blocks.select("block", "hash_steps", "lengths", "words").mapInArrow(bucket_words(buckets), "bucket int, block long, lengths binary, words binary")
    pieces = words.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(counted(vocabulary_path), "block long, bucket int, pieces binary")
    # One entry per bucket that a block has words in; a block's dictionary is bounded, so is this list.
    back = pieces.groupBy("block").agg(F.sort_array(F.collect_list(F.struct("bucket", "pieces"))).alias("parts"))
    back = stored(back, work_path(spark, "pieces"))
    own = blocks.select("block", "ids", "n_bytes", "sizes", "keys", "times", "order")
    schema = T.StructType([T.StructField("id", docs.schema[id_column].dataType), *T.StructType.fromDDL("n_bytes long, n_tokens long, over_limit boolean")])
    return own.join(back, "block", "left").mapInArrow(summed(limit), schema).withColumnRenamed("id", id_column)
