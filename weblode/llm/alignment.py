"""Token groups and links between two tokenizers, by the byte offsets at which tokens of both end."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.llm.blocks import Counts, in_blocks, packed, row_sums, unpacked
from weblode.llm.pretokens import ByteLevel
from weblode.session import stored, work_path

# A place where both tokenizers begin a token: one space between characters that are none.
BORDER = re.compile(r"(?<=\S) (?=\S)")
SPACE_MARK = "▁"
# Words a worker remembers and the letters it aligns at a time: bounds of memory, not of results.
KNOWN_WORDS = 300_000
SEGMENT_CHARS = 1 << 18

FIELDS = [
    *[T.StructField(n, T.BinaryType()) for n in ("n_a", "n_b", "n_groups", "sizes", "keys", "times")],
    T.StructField("digests", T.ArrayType(T.StringType())),
    T.StructField("pairs", T.BinaryType()),
    T.StructField("pair_times", T.BinaryType()),
]


# Tokens of A and of B, the groups as written, the links.
Aligned = tuple[int, int, str, list[int]]


class Pair:
    """Tokenizer A, byte-level BPE, reads a space and the text; tokenizer B, a sentencepiece model, adds that space itself."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece

        self.a = ByteLevel(path_a)
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces) or b"identity" not in self.b.serialized_model_proto():
            raise ValueError(f"{path_b}: a piece that goes over a space, or a normalizer that changes texts")
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(SPACE_MARK, " ").encode() for i, p in enumerate(pieces)]
        self.a_bytes = [self.a.bytes_by_id.get(i, b"") for i in range(max(self.a.bytes_by_id) + 1)]
        if not all(self.a.bytes_by_id.values()) or not all(self.b_bytes):
            raise ValueError("a token without bytes")
        self.a_sizes, self.b_sizes = (np.array(list(map(len, x)), np.int64) for x in (self.a_bytes, self.b_bytes))
        self.names = [str(i) for i in range(max(len(self.a_bytes), len(self.b_bytes)))]
        self.words: dict[str, Aligned | None] = {}

    def learn(self, words: list[str]) -> None:
        """Align the words that are not known yet: what stands between two borders is aligned once and remembered."""
        new = [w for w in dict.fromkeys(words) if w not in self.words]
        # Words with outer white space (only the first and last of a text have any) would run into each other.
        inner = [w for w in new if not w[0].isspace() and not w[-1].isspace()]
        for batch in [inner, *[[w] for w in new if w[0].isspace() or w[-1].isspace()]]:
            self.words.update(zip(batch, self.aligned(batch), strict=True))

    def forget(self) -> None:
        if len(self.words) > KNOWN_WORDS:
            self.words.clear()

    def aligned(self, words: list[str]) -> list[Aligned | None]:
        """Of each word the numbers of tokens, the groups in their written form, and the linked pairs as ``a << 32 | b``.

        The words are laid end to end; both tokenizers have an end at the end of each, so no group goes over it. None where the
        tokens' bytes are not those of a space and the word; such words are found by halving.
        """
        if not words:
            return []
        spaced = [" " + w for w in words]
        whole = "".join(spaced)
        flat_a = [i for piece in self.a.cut(whole) for i in self.a.pieces(piece)]
        b = self.b.encode(words, num_threads=1)
        flat_b, sizes_b = list(chain.from_iterable(b)), np.array(list(map(len, b)))
        ends_a, ends_b = np.cumsum(self.a_sizes[flat_a]), np.cumsum(self.b_sizes[flat_b])
        last = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in spaced])
        spelled = b"".join([self.a_bytes[i] for i in flat_a]) == whole.encode() == b"".join([self.b_bytes[i] for i in flat_b])
        if not spelled or (sizes_b == 0).any() or (ends_b[np.cumsum(sizes_b) - 1] != last).any() or not np.isin(last, ends_a).all():
            half = len(words) // 2
            return [*self.aligned(words[:half]), *self.aligned(words[half:])] if half else [None]
        # From each cumulative end to the number of tokens that have ended there.
        at_a = dict(zip(ends_a.tolist(), range(1, len(flat_a) + 1), strict=True))
        at_b = dict(zip(ends_b.tolist(), range(1, len(flat_b) + 1), strict=True))
        common = sorted(at_a.keys() & at_b.keys())
        stops_a, stops_b = [at_a[e] for e in common], [at_b[e] for e in common]
        names_a, names_b = [self.names[t] for t in flat_a], [self.names[t] for t in flat_b]
        slices = zip([0, *stops_a], stops_a, [0, *stops_b], stops_b, strict=False)
        groups = [(names_a[i] if x - i == 1 else ",".join(names_a[i:x])) + "|" + (names_b[j] if y - j == 1 else ",".join(names_b[j:y])) for i, x, j, y in slices]
        # No token is empty, so one token of each ends at a common end: the last of the slice.
        links = (np.array(flat_a)[np.array(stops_a) - 1] << 32) | np.array(flat_b)[np.array(stops_b) - 1]
        sizes_a = np.diff([at_a[e] for e in last.tolist()], prepend=0)
        cuts = (np.searchsorted(common, last) + 1).tolist()
        return [(x, y, ";".join(groups[g:h]), links[g:h].tolist()) for x, y, g, h in zip(sizes_a.tolist(), sizes_b.tolist(), [0, *cuts], cuts, strict=False)]


class Text:
    """What is known of a text so far."""

    def __init__(self):
        self.fine, self.n_a, self.n_b, self.n_groups = True, 0, 0, 0
        self.digest, self.links = hashlib.sha256(), [np.zeros(0, np.int64)]

    def add(self, words: list[Aligned | None]) -> None:
        if None in words:
            self.fine = False
        if not self.fine:
            return
        self.digest.update((";" * bool(self.n_groups) + ";".join([w[2] for w in words])).encode())
        self.links.append(np.array([k for w in words for k in w[3]], np.int64))
        self.n_a += sum([w[0] for w in words])
        self.n_b += sum([w[1] for w in words])
        self.n_groups += len(self.links[-1])


def segments(texts: list[str]) -> Iterator[list[tuple[int, list[str]]]]:
    """Texts' words, so many characters at a time: (place of the text, words) pairs."""
    held, size = [], 0
    for place, text in enumerate(texts):
        words = BORDER.split(text) if text else []
        start = 0
        for i, word in enumerate(words):
            size += len(word) + 1
            if size >= SEGMENT_CHARS:
                yield [*held, (place, words[start : i + 1])]
                held, size, start = [], 0, i + 1
        if start < len(words):
            held.append((place, words[start:] if start else words))
    if held:
        yield held


def aligned_texts(path_a: str, path_b: str) -> Callable[[list[str]], list]:
    """A function from texts to one block: numbers and digest of each text, its links, and the block's sum of each pair."""
    pair = Pair(path_a, path_b)

    def block(texts: list[str]) -> list:
        found = [Text() for _ in texts]
        for segment in segments(texts):
            pair.learn([w for _, words in segment for w in words])
            for place, words in segment:
                found[place].add([pair.words[w] for w in words])
            pair.forget()
        counts, digests, numbers = Counts(), [], []
        for text in found:
            own = text if text.fine else Text()
            numbers.append((own.n_a, own.n_b, own.n_groups))
            digests.append(own.digest.hexdigest() if own.n_groups else "")
            counts.add(*np.unique(np.concatenate(own.links), return_counts=True))
        pairs, place = np.unique(np.concatenate([np.zeros(0, np.int64), *counts.keys]), return_inverse=True)
        times = np.concatenate([np.zeros(0, np.int64), *counts.times])
        # Keys become their place among the block's pairs.
        sums = np.bincount(place, weights=times, minlength=len(pairs)).astype(np.int64)
        columns = [packed(np.array(c, np.int64)) for c in zip(*numbers, strict=True)]
        return [*columns, packed(np.array(counts.sizes, np.int64)), packed(place.astype(np.int64)), packed(times), pa.array(digests, pa.string()), packed(pairs), packed(sums)]

    return block


def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, place, a, b, n) of every block's distinct pairs."""
    for batch in batches:
        for block, pairs, sums in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            keys, n = unpacked(pairs), unpacked(sums)
            columns = [np.full(len(keys), block), np.arange(len(keys), dtype=np.int32), (keys >> 32).astype(np.int32), (keys & 0xFFFFFFFF).astype(np.int32), n]
            for at in range(0, len(keys), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[at : at + (1 << 16)]) for c in columns], names=["block", "place", "a", "b", "n"])


def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each document's numbers, from its links and what the corpus says of the block's pairs."""
    names = ["id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    for batch in batches:
        for i in range(batch.num_rows):
            values = {c: batch.column(c)[i].as_py() for c in ("n_a", "n_b", "n_groups", "sizes", "keys", "times", "found")}
            count, best = np.zeros(len(values["found"] or ()), np.int64), np.zeros(len(values["found"] or ()), bool)
            for f in values["found"] or ():
                count[f["place"]], best[f["place"]] = f["count"], f["best"]
            sizes, keys, times = (unpacked(values[c]) for c in ("sizes", "keys", "times"))
            columns = [unpacked(values[c]) for c in ("n_a", "n_b", "n_groups")]
            columns += [row_sums(sizes, v) for v in (times, times * best[keys], times * count[keys])]
            yield pa.RecordBatch.from_arrays([batch.column("ids")[i].values, *map(pa.array, columns), batch.column("digests")[i].values], names=names)


def alignments(docs: DataFrame, path_a: str, path_b: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, ``n_a``, ``n_b``, ``n_groups``, ``n_links``, ``n_best``, ``count_sum`` and ``groups_sha256``.

    A (byte-level BPE) reads a space and the text, B (sentencepiece) the text, which it begins with a space itself; strings of special
    tokens are plain text. Stretches between borders that both keep (one space between other characters) are aligned each by itself.
    Ends that both have cut the tokens into groups, written ``a1,a2|b1;a3|b2,b3``; the two tokens that end
    at such a place are a link. ``count_sum`` adds up how many links of the corpus join the same two ids, ``n_best``
    counts links whose number is the highest of their id of B.

    A null or empty text, and one whose tokens' bytes are not a space and the text, has no tokens: zeros and an empty digest.
    Repeated rows and null ids are rows like others. A text of any length is one row, read in such stretches, so the
    dictionaries of ends stay small; only a stretch without a border is taken as a whole. An empty table gives an empty result; further columns do not matter.
    """
    spark = docs.sparkSession
    made = in_blocks(docs, id_column, text_column, lambda: aligned_texts(path_a, path_b), FIELDS)
    path = work_path(spark, "alignments")
    made.write.option("compression", "zstd").parquet(path)
    blocks = spark.read.schema(made.schema).parquet(path)
    listed_pairs = blocks.select("block", "pairs", "pair_times").mapInArrow(listed, "block long, place int, a int, b int, n long")
    listed_pairs = stored(listed_pairs, work_path(spark, "pairs"))
    counts = stored(listed_pairs.groupBy("a", "b").agg(F.sum("n").alias("count")), work_path(spark, "counts"))
    highest = counts.groupBy("b").agg(F.max("count").alias("highest"))
    judged = counts.join(highest, "b").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    # One entry per distinct pair of a block.
    found = listed_pairs.join(judged, ["a", "b"]).groupBy("block").agg(F.collect_list(F.struct("place", "count", "best")).alias("found"))
    own = blocks.drop("pairs", "pair_times").join(found, "block", "left")
    schema = T.StructType(
        [T.StructField("id", docs.schema[id_column].dataType), *T.StructType.fromDDL("n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")]
    )
    return own.mapInArrow(summed, schema).withColumnRenamed("id", id_column)
