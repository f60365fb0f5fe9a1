"""Benchmark passages in training documents."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblode.llm.common import quoted, with_fields, without
from weblode.session import stored, work_path

WINDOW = 10
# Windows of one hash set; a benchmark with more is searched in several sets, one after the other.
SET_WINDOWS = 1_000_000
ADDED_DDL = "n_words long, n_hit long, items array<string>, spans array<struct<start:int,stop:int>>"
ADDED = ("n_words", "n_hit", "items", "spans")
BLOOM_BITS = 22

IS_WORD = np.zeros(256, dtype=bool)
IS_WORD[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
MIX = np.uint64(0x9E3779B97F4A7C15)


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


WORD_POWERS = powers(0x100000001B3, 1 << 10)


def word_table(data: np.ndarray):
    """(start, stop, hash) of each word in lower-cased bytes."""
    inside = IS_WORD[data]
    edges = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).view(np.int8)))
    starts, stops = edges[::2], edges[1::2]
    if not len(starts):
        return starts, stops, np.zeros(0, dtype=np.uint64)
    letters = data[inside].astype(np.uint64) + np.uint64(1)
    sizes = stops - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(len(letters)) - np.repeat(first, sizes)
    weights = WORD_POWERS if sizes.max() <= len(WORD_POWERS) else powers(0x100000001B3, int(sizes.max()))
    letters *= weights[place]
    hashes = np.add.reduceat(letters, first)
    hashes ^= hashes >> np.uint64(32)
    hashes *= MIX
    hashes ^= hashes >> np.uint64(29)
    return starts, stops, hashes


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for weight, i in zip(powers(0xD6E8FEB86659FD93, size), range(size), strict=True):
        out += words[i : i + n] * weight
    return out ^ (out >> np.uint64(31))


def benchmark_windows(benchmark: DataFrame, id_column: str, text_column: str, window: int) -> DataFrame:
    """(item, size, window) with the distinct windows of each item as words joined by one space."""
    lowered = F.translate(F.col(quoted(text_column)).cast("string"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.regexp_extract_all(lowered, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), 1)
    items = benchmark.select(F.col(quoted(id_column)).cast("string").alias("item"), words.alias("words")).where("size(words) > 0 and item is not null")
    size = F.least(F.size("words"), F.lit(window))
    runs = F.transform(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1), lambda i: F.array_join(F.slice("words", i, F.col("size")), " "))
    return items.withColumn("size", size).select("item", "size", F.explode(runs).alias("window")).distinct()


class WindowSet:
    """A hash set of benchmark windows: hits are confirmed by their words."""

    def __init__(self, rows):
        self.by_size = {}
        for size in sorted({r[1] for r in rows}):
            known: dict[bytes, list[str]] = {}
            for item, n, window in rows:
                if n == size:
                    known.setdefault(window.encode(), []).append(item)
            joined = list(known)
            hashes = np.array([window_hashes(word_table(np.frombuffer(w, dtype=np.uint8))[2], size)[0] for w in joined], dtype=np.uint64)
            bits = np.zeros(1 << BLOOM_BITS, dtype=bool)
            bits[hashes >> np.uint64(64 - BLOOM_BITS)] = True
            self.by_size[size] = np.sort(hashes), bits, known

    def hits(self, lowered: bytes, table) -> list[tuple[int, int, list[str]]]:
        """(first word, size, items) of every place where a benchmark window stands."""
        starts, stops, words = table
        out = []
        for size, (sorted_hashes, bits, known) in self.by_size.items():
            found = window_hashes(words, size)
            at = np.flatnonzero(bits[found >> np.uint64(64 - BLOOM_BITS)])
            if len(at):
                place = np.minimum(np.searchsorted(sorted_hashes, found[at]), len(sorted_hashes) - 1)
                at = at[sorted_hashes[place] == found[at]]
            for i in at.tolist():
                window = b" ".join(lowered[starts[j] : stops[j]] for j in range(i, i + size))
                if window in known:
                    out.append((i, size, known[window]))
        return out


ADDED_ARROW = pa.schema(
    [
        ("n_words", pa.int64()),
        ("n_hit", pa.int64()),
        ("items", pa.list_(pa.string())),
        ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))),
    ]
)


def marked(text: str | None, sets: WindowSet, spans, items):
    """(words, hit words, items, byte spans) of a text, on top of spans and items that are known already."""
    lowered = (text or "").encode().lower()
    table = word_table(np.frombuffer(lowered, dtype=np.uint8))
    starts, stops, _ = table
    step = np.zeros(len(starts) + 1, dtype=np.int32)
    names = set(items)
    for span in spans:
        step[np.searchsorted(starts, span["start"])] += 1
        step[np.searchsorted(starts, span["stop"])] -= 1
    for first, size, of in sets.hits(lowered, table):
        step[first] += 1
        step[first + size] -= 1
        names.update(of)
    covered = np.cumsum(step[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], covered, [False])).view(np.int8)))
    runs = [{"start": int(starts[a]), "stop": int(stops[b - 1])} for a, b in zip(edges[::2], edges[1::2], strict=True)]
    return len(covered), int(covered.sum()), sorted(names), runs


def marked_batches(batches: Iterator[pa.RecordBatch], text_column: str, carried: list[str], sets: WindowSet) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(text_column).to_pylist()
        before = [batch.column(n).to_pylist() if n in batch.schema.names else [()] * len(texts) for n in ("spans", "items")]
        rows = [marked(text, sets, spans, items) for text, spans, items in zip(texts, *before, strict=True)]
        added = [pa.array([r[i] for r in rows], field.type) for i, field in enumerate(ADDED_ARROW)]
        kept = [batch.column(n) for n in carried]
        fields = [batch.schema.field(n) for n in carried]
        yield pa.RecordBatch.from_arrays([*kept, *added], schema=pa.schema([*fields, *ADDED_ARROW]))


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    window: int = WINDOW,
    set_windows: int = SET_WINDOWS,
) -> DataFrame:
    """Every row with ``n_words``, ``n_hit``, the benchmark ``items`` found in it and the hit ``spans``.

    Words are runs of ``0-9``, ``a-z`` (after lower-casing A-Z) and characters beyond ASCII. ``window``
    consecutive words of an item are a window; a shorter item is one window. A word of a document inside
    any occurrence of a window is hit. ``spans`` are byte ranges of the UTF-8 text, from the first to the
    last word of each run of hit words; ``items`` is sorted as strings. Null texts have no words, items without words or
    without id match nothing, repeated rows are judged alike. Input columns that bear the name of an added one are replaced.

    The windows of a set are broadcast; a set has ``set_windows`` of them at most. A larger benchmark is
    dealt over several sets by a hash of the window. Each is searched in a pass of its own, whose result
    is written before the next one starts, so that one set at a time is in memory.
    """
    spark = docs.sparkSession
    frame = docs = without(docs, ADDED)
    windows = stored(benchmark_windows(benchmark, item_column, item_text_column, window), work_path(spark, "windows"))
    sets = max(1, -(-windows.count() // set_windows))
    for part in range(sets):
        own = windows.where(F.pmod(F.xxhash64("window"), F.lit(sets)) == part)
        frame = searched(frame, docs, text_column, own)
        if part < sets - 1:
            frame = stored(frame, work_path(spark, "hits"))
    return frame


def searched(frame: DataFrame, docs: DataFrame, text_column: str, windows: DataFrame) -> DataFrame:
    shared = frame.sparkSession.sparkContext.broadcast([tuple(r) for r in windows.collect()])
    carried = docs.columns
    held: list[WindowSet] = []

    def scan(batches):
        if not held:
            held.append(WindowSet(shared.value))
        return marked_batches(batches, text_column, carried, held[0])

    return frame.mapInArrow(scan, with_fields(docs, ADDED_DDL))


def without_spans(frame: DataFrame, text_column: str = "text") -> DataFrame:
    """The texts of ``contaminated`` with every hit span cut out (byte ranges, so it works on UTF-8)."""
    data = F.encode(F.coalesce(F.col(quoted(text_column)), F.lit("")), "UTF-8")
    ends = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length(data)))
    begins = F.concat(F.array(F.lit(0)), F.transform("spans", lambda s: s["stop"]))
    pieces = F.zip_with(begins, ends, lambda a, b: F.decode(F.substring(data, a + 1, b - a), "UTF-8"))
    return frame.withColumn(text_column, F.array_join(pieces, ""))
