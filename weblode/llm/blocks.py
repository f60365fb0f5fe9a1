"""Documents in blocks: counts of keys per document, packed, with one dictionary of keys per block.

A key that stands in every document stands once in a block, so what is shuffled afterwards are the blocks'
dictionaries, and no key holds more rows than there are blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.llm.common import quoted

# Text that a block holds, in characters, unless one text alone is longer: a bound of memory, not of results.
BLOCK_CHARS = 16 << 20


def packed(numbers: np.ndarray) -> bytes:
    """Whole numbers from 0 on: their bytes by place, compressed."""
    planes = np.ascontiguousarray(numbers, dtype="<u8").view(np.uint8).reshape(-1, 8)
    width = max((8 - int(np.argmax(planes.any(axis=0)[::-1])) if planes.any() else 1), 1)
    return bytes([width]) + zstandard.compress(planes[:, :width].T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    width, planes = blob[0], np.frombuffer(zstandard.decompress(blob[1:]), dtype=np.uint8)
    out = np.zeros((len(planes) // width, 8), dtype=np.uint8)
    out[:, :width] = planes.reshape(width, -1).T
    return out.view("<u8").reshape(-1).astype(np.int64)


class Counts:
    """The keys of each document with their numbers, row by row."""

    def __init__(self):
        self.sizes: list[int] = []
        self.keys: list[np.ndarray] = []
        self.times: list[np.ndarray] = []

    def add(self, keys: np.ndarray, times: np.ndarray) -> None:
        self.sizes.append(len(keys))
        self.keys.append(keys)
        self.times.append(times)

    def packed(self, place: np.ndarray | None = None) -> tuple[bytes, bytes, bytes]:
        """Sizes of the rows, keys (moved to ``place``) and how often each occurs."""
        keys = np.concatenate([np.zeros(0, np.int64), *self.keys])
        return packed(np.array(self.sizes, np.int64)), packed(keys if place is None else place[keys]), packed(np.concatenate([np.zeros(0, np.int64), *self.times]))


def row_sums(sizes: np.ndarray, values: np.ndarray) -> np.ndarray:
    """The sum of each row's values; rows follow one another and may be empty."""
    ends = np.concatenate(([0], np.cumsum(values, dtype=np.int64)))
    stops = np.cumsum(sizes)
    return ends[stops] - ends[stops - sizes]


def in_blocks(docs: DataFrame, id_column: str, text_column: str, build: Callable[[], Callable], fields: Sequence[T.StructField]) -> DataFrame:
    """(block, ids, *fields): ``build()`` gives a worker's function from a block's texts (null is empty) to its fields.

    Block numbers are made once, by the task that writes the block, and are only good in a table that is stored.
    """
    id_type = docs.schema[id_column].dataType
    schema = T.StructType([T.StructField("block", T.LongType()), T.StructField("ids", T.ArrayType(id_type)), *fields])
    held: list[Callable] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(build())
        number = TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list[str] = []
        size = 0

        def row() -> pa.RecordBatch:
            lists = pa.array(ids, type=id_arrow), *held[0](texts)
            columns = [pa.array([number], pa.int64())]
            columns += [pa.ListArray.from_arrays([0, len(v)], v) if isinstance(v, pa.Array) else pa.array([v]) for v in lists]
            return pa.RecordBatch.from_arrays(columns, names=[f.name for f in schema])

        for batch in batches:
            id_arrow = batch.column(0).type
            for key, text in zip(batch.column(0).to_pylist(), (t.as_py() for t in batch.column(1)), strict=True):
                text = text or ""
                if texts and size + len(text) > BLOCK_CHARS:
                    yield row()
                    ids, texts, size, number = [], [], 0, number + 1
                ids.append(key)
                texts.append(text)
                # A row counts for something even without text, so that a block does not hold any number of them.
                size += len(text) + 16
        if ids:
            yield row()

    return docs.select(F.col(quoted(id_column)).alias("id"), F.col(quoted(text_column)).cast("string").alias("text")).mapInArrow(run, schema)
