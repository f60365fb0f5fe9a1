"""Hard negatives: scores of anchors with all rows, sorted by (anchor, descending score, id) and read as a stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.llm.common import partitions_of, quoted
from weblode.session import stored, work_path

SCALE = 256
POSITIVES = 5
NEGATIVES = 3
LOWEST, HIGHEST = 50, 95  # a negative's score, in hundredths of the positive's
# Bytes of anchors that a task holds, and how many such pieces one job compares: bounds of memory.
PIECE_BYTES = 4 << 20
PIECES = 8
# Tasks over the rows for each piece: no more than so many partial results per anchor are shuffled.
SLABS = 64
TILE = 1024
ROWS = 4096
NONE = -(1 << 62)  # below every score


class Matches:
    """What an anchor's rows may still contribute: for each of its ranges of scores the best so many rows."""

    def __init__(self, low: np.ndarray, high: np.ndarray, most: int):
        self.low, self.high, self.most = low.copy(), high, most
        self.found = [np.zeros(0, np.int64)] * 3
        self.new: list[list[np.ndarray]] = []
        self.size = 0

    def add(self, anchors: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        self.new.append([anchors, scores, ids])
        self.size += len(anchors)
        if self.size > max(1 << 18, 2 * len(self.found[0])):
            self.reduce()

    def reduce(self) -> None:
        anchors, scores, ids = (np.concatenate(x) for x in zip(self.found, *self.new, strict=True))
        order = np.lexsort((ids, -scores, anchors))
        anchors, scores, ids = anchors[order], scores[order], ids[order]
        first = np.searchsorted(anchors, anchors)
        kept = np.zeros(len(anchors), bool)
        for j in range(self.low.shape[1]):
            inside = (scores <= self.high[anchors, j]) & (scores >= self.low[anchors, j])
            before = np.concatenate(([0], np.cumsum(inside)))
            rank = before[1:] - before[first]
            kept |= inside & (rank <= self.most)
            last = inside & (rank == self.most)
            self.low[anchors[last], j] = scores[last]
        self.found, self.new, self.size = [anchors[kept], scores[kept], ids[kept]], [], 0


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of whole numbers, exact: the caller has bounded them."""
    return a @ b.T


def compared(piece: dict, same: bool, kind: int, most: int) -> Callable:
    """Rows to (anchor_id, score, kind, id): for each anchor of the piece and range the best rows of a task.

    ``same`` takes rows of the anchor's label other than itself, else those of other labels.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, labels, vectors = piece["ids"], piece["labels"], piece["vectors"]
        matches = Matches(piece["low"], piece["high"], most)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                row_ids, row_labels = (part.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
                rows = part.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(row_ids), vectors.shape[1]).astype(vectors.dtype)
                for label in np.unique(labels).tolist():
                    own_rows = np.flatnonzero((row_labels == label) == same)
                    own_anchors = np.flatnonzero(labels == label)
                    for tile in (own_anchors[i : i + TILE] for i in range(0, len(own_anchors), TILE)):
                        meet(matches, tile, ids[tile], vectors[tile], row_ids[own_rows], rows[own_rows], same)
        matches.reduce()
        anchors, scores, found = matches.found
        for at in range(0, len(anchors), 1 << 16):
            part = slice(at, at + (1 << 16))
            yield pa.RecordBatch.from_pydict({"anchor_id": ids[anchors[part]], "score": scores[part], "kind": np.full(len(anchors[part]), kind, np.int32), "id": found[part]})

    return run


def meet(matches: Matches, tile: np.ndarray, ids: np.ndarray, vectors: np.ndarray, row_ids: np.ndarray, rows: np.ndarray, same: bool) -> None:
    """Offer the scores of some anchors with some rows."""
    if not len(row_ids):
        return
    scores = products(vectors, rows)
    if same:
        scores[ids[:, None] == row_ids[None, :]] = NONE
        if len(row_ids) > matches.most:
            # At least so many rows of this batch are as good; worse ones cannot be among the best.
            bound = np.partition(scores, -matches.most, axis=1)[:, -matches.most]
            matches.low[tile, 0] = np.maximum(matches.low[tile, 0], np.maximum(bound, NONE + 1).astype(np.int64))
    low, high = matches.low[tile].min(axis=1), matches.high[tile].max(axis=1)
    i, j = np.nonzero((scores >= low[:, None]) & (scores <= high[:, None]))
    matches.add(tile[i], scores[i, j].astype(np.int64), row_ids[j])


def first_positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first rows of each anchor in sorted order."""
    at, n = None, 0
    for batch in batches:
        keep = []
        for anchor in batch.column(0).to_pylist():
            n = n + 1 if anchor == at else 1
            at = anchor
            keep.append(n <= POSITIVES)
        yield batch.filter(pa.array(keep, pa.bool_()))


def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One walk over the sorted scores: a positive opens a window, the first negatives that fall into it leave with it.

    Of an anchor no more is held than its open windows.
    """
    names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    at, opened = None, []
    for batch in batches:
        out = []
        for anchor, score, kind, key in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if anchor != at:
                at, opened = anchor, []
            if kind == 0:
                opened.append([key, score, 0])
                continue
            for window in opened:
                if LOWEST * window[1] <= 100 * score <= HIGHEST * window[1] and window[2] < NEGATIVES:
                    window[2] += 1
                    out.append((anchor, window[0], window[2], key, window[1], score))
        columns = list(zip(*out, strict=True)) or [()] * 6
        types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)


def taking_part(rows: DataFrame, id_column: str, label_column: str, vector_column: str, anchor: Column) -> DataFrame:
    """(id, label, vector, anchor): whole-numbered vectors of one length; rows that are not whole are left out."""
    vector = F.col(quoted(vector_column))
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)))
    named = rows.select(
        F.col(quoted(id_column)).cast("long").alias("id"), F.col(quoted(label_column)).cast("long").alias("label"), vector.alias("vector"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"), finite.alias("finite"),
    )
    named = named.where("id is not null and label is not null and vector is not null and finite")
    scaled = F.transform("vector", lambda x: F.floor(x.cast("double") * SCALE))
    whole = stored(named.select("id", "label", scaled.alias("vector"), "anchor"), work_path(rows.sparkSession, "vectors"))
    width = whole.agg(F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("most"), F.coalesce(F.min(F.size("vector")), F.lit(0)).alias("least")).first()
    if width["least"] < width["most"]:
        whole = whole.withColumn("vector", F.concat("vector", F.array_repeat(F.lit(0).cast("long"), F.lit(width["most"]) - F.size("vector"))))
    if not whole.groupBy("id").count().where("count > 1").isEmpty():
        rest = whole.groupBy("id").agg(F.min(F.struct("label", "vector", "anchor")).alias("r"))
        whole = stored(rest.select("id", "r.label", "r.vector", "r.anchor"), work_path(rows.sparkSession, "vectors"))
    return whole


def hard_negatives(rows: DataFrame, anchor: Column, id_column: str, label_column: str, vector_column: str) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for the rows that ``anchor`` marks.

    A component x counts as floor(256 * x), a score is the inner product, higher ones first, ties by smaller id. An anchor's
    positives are its first five other rows of the same label; each takes the first three rows of other labels with
    50 to 95 hundredths of its score.

    Each task meets anchors, in pieces of bounded bytes, with its share of the rows, and passes on only what can be among the
    first of its anchor or window: five positives, then, with the windows known, three negatives each. These scores are keyed
    by (anchor, descending score, id), dealt by anchor and sorted within partitions, positives before negatives
    of the same score, and read as a stream.

    Rows with a null id, label, vector or component, or one that is not finite, take no part. Of rows with one id the least by
    label and vector does; shorter vectors count as followed by zeros. Labels are whole numbers. An empty table, or none without
    anchors or positives, gives an empty result; further columns do not matter. Vectors whose scores
    might exceed 2**55 are a ValueError.
    """
    spark = rows.sparkSession
    whole = taking_part(rows, id_column, label_column, vector_column, anchor)
    sizes = whole.agg(
        F.count_if("anchor").alias("anchors"),
        F.coalesce(F.max(F.size("vector")), F.lit(0)).alias("width"),
        F.max(F.array_max(F.transform("vector", lambda x: F.abs(x.cast("double"))))).alias("largest"),
    ).first()
    bound = (sizes["largest"] or 0.0) ** 2 * max(1, sizes["width"])
    if bound >= 2.0**55:
        raise ValueError("components so large that scores may exceed 2**55")
    kind = np.float64 if bound < 2.0**53 else np.int64
    pieces = max(1, -(-sizes["anchors"] * max(1, sizes["width"]) * 8 // PIECE_BYTES))
    anchors = whole.where("anchor").select("id", "label", "vector", F.pmod(F.xxhash64("id"), F.lit(pieces)).alias("piece"))
    shared = whole.select("id", "label", "vector").coalesce(SLABS)

    def scores(of: DataFrame, same: bool, most: int, purpose: str) -> DataFrame:
        """What each piece's anchors find among all rows; a few pieces at a time are sent to the tasks."""
        path, schema = work_path(spark, purpose), "anchor_id long, score long, kind int, id long"
        spark.createDataFrame([], schema).write.parquet(f"{path}/none")
        for start in range(0, pieces, PIECES):
            frame = spark.createDataFrame([], schema)
            for p in range(start, min(start + PIECES, pieces)):
                found = of.where(F.col("piece") == p).toArrow()
                if not found.num_rows:
                    continue
                low = np.array(found.column("low").to_pylist(), np.int64).reshape(found.num_rows, -1)
                high = np.array(found.column("high").to_pylist(), np.int64).reshape(found.num_rows, -1)
                flat = found.column("vector").combine_chunks().flatten().to_numpy(zero_copy_only=False)
                piece = {"ids": found.column("id").to_numpy(), "labels": found.column("label").to_numpy(), "vectors": flat.reshape(found.num_rows, sizes["width"]).astype(kind), "low": low, "high": high}
                frame = frame.unionAll(shared.mapInArrow(compared(piece, same, 0 if same else 1, most), schema))
            frame.write.parquet(f"{path}/{start}")
        return spark.read.schema(schema).parquet(f"{path}/*")

    def dealt(frame: DataFrame) -> DataFrame:
        return frame.repartition(partitions_of(frame), "anchor_id").sortWithinPartitions("anchor_id", F.desc("score"), "kind", "id")

    everything = anchors.withColumn("low", F.array(F.lit(NONE + 1))).withColumn("high", F.array(F.lit(-NONE)))
    positives = dealt(scores(everything, True, POSITIVES, "positives")).mapInArrow(first_positives, "anchor_id long, score long, kind int, id long")
    positives = stored(positives, work_path(spark, "positives"))
    # At most five scores per anchor; the first of a range above the second is a range without scores.
    ranges = positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list("score"), asc=False).alias("scores"))
    at = [f"get(filter(scores, s -> s >= 0), {i})" for i in range(POSITIVES)]
    low = F.array(*[F.expr(f"coalesce(({s} * {LOWEST} + 99) div 100, 1L)") for s in at])
    high = F.array(*[F.expr(f"coalesce(({s} * {HIGHEST}) div 100, 0L)") for s in at])
    ranged = anchors.join(ranges, anchors.id == ranges.anchor_id).select("id", "label", "vector", "piece", low.alias("low"), high.alias("high"))
    ranged = stored(ranged, work_path(spark, "anchors"))
    negatives = scores(ranged, False, NEGATIVES, "negatives")
    return dealt(positives.unionByName(negatives)).mapInArrow(windows, "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
