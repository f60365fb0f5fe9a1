"""A byte-level convolutional network that tells good documents from bad ones."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.llm.common import quoted, without

CELL = 16  # bytes; a chunk is two cells, and chunks overlap by one
WIDTH = 6  # learned numbers per byte value
LAGS = range(1, 25)  # a chunk also shows how many of its bytes equal the byte so far before
FILTERS = 16
# The network is fitted on so many labelled rows at most, of texts of so many bytes at most.
SAMPLE_ROWS = 3_000
SAMPLE_BYTES = 1 << 15
EPOCHS = 14
BATCH = 50
CHUNK_BYTES = 1 << 20
ADDED = ("score", "predicted")


@dataclass
class Cells:
    """Texts cut into cells; each text is followed by two empty ones, so that none sees its neighbour."""

    cells: np.ndarray
    lags: np.ndarray
    first: np.ndarray
    count: np.ndarray


def cut(texts: list[bytes]) -> Cells:
    count = np.array([max(2, -(-len(t) // CELL)) for t in texts], dtype=np.int64)
    first = np.cumsum(count + 2) - count - 2
    data = np.zeros(int((count + 2).sum()) * CELL, dtype=np.uint8)
    for text, at in zip(texts, (first * CELL).tolist(), strict=True):
        data[at : at + len(text)] = np.frombuffer(text, dtype=np.uint8)
    lags = np.zeros((len(data) // CELL, len(LAGS)), dtype=np.float32)
    filled = data != 0
    for i, lag in enumerate(LAGS):
        same = np.zeros(len(data), dtype=np.uint8)
        np.logical_and(data[lag:] == data[:-lag], filled[lag:], out=same[lag:].view(bool))
        lags[:, i] = same.reshape(-1, CELL).sum(axis=1, dtype=np.uint8)
    return Cells(data.reshape(-1, CELL), lags, first, count)


class Network:
    """Filters over chunks, their largest response in the whole text, and one logistic unit."""

    def __init__(self, seed: int = 0):
        rng = np.random.default_rng(seed)
        wide = CELL * WIDTH

        def start(*shape, scale):
            return rng.normal(0, scale, shape).astype(np.float32)

        self.weights = {
            "byte": start(256, WIDTH, scale=0.5),
            "left": start(wide, FILTERS, scale=0.1),
            "right": start(wide, FILTERS, scale=0.1),
            "lag": start(len(LAGS), FILTERS, scale=0.3),
            "shift": np.zeros(FILTERS, dtype=np.float32),
            "out": start(FILTERS, scale=0.3),
            "bias": np.zeros(1, dtype=np.float32),
        }

    def chunks(self, part: Cells):
        """(values of each cell, lag values and responses of each chunk)."""
        w = self.weights
        values = w["byte"][part.cells].reshape(len(part.cells), -1)
        lags = ((part.lags[:-1] + part.lags[1:]) / (2 * CELL)) ** 3
        responses = (values @ w["left"])[:-1] + (values @ w["right"])[1:] + lags @ w["lag"] + w["shift"]
        return values, lags, responses

    def scores(self, texts: list[bytes]) -> np.ndarray:
        part = cut(texts)
        _, _, responses = self.chunks(part)
        bounds = np.stack((part.first, part.first + part.count - 1), axis=1).ravel()
        pooled = np.maximum.reduceat(responses, bounds, axis=0)[::2]
        logits = np.tanh(pooled) @ self.weights["out"] + self.weights["bias"]
        return 1 / (1 + np.exp(-logits.astype(np.float64)))

    def gradients(self, part: Cells, labels: np.ndarray):
        w = self.weights
        values, lags, responses = self.chunks(part)
        best = np.array([f + responses[f : f + n - 1].argmax(axis=0) for f, n in zip(part.first, part.count, strict=True)])
        hidden = np.tanh(responses[best, np.arange(FILTERS)])
        error = 1 / (1 + np.exp(-(hidden @ w["out"] + w["bias"]))) - labels
        error = (error / len(labels)).astype(np.float32)
        back = error[:, None] * w["out"] * (1 - hidden**2)
        out = {"out": hidden.T @ error, "bias": error.sum(keepdims=True), "shift": back.sum(axis=0)}
        out["lag"] = np.einsum("df,dfl->lf", back, lags[best])
        out["byte"] = np.zeros_like(w["byte"])
        for name, at in (("left", best), ("right", best + 1)):
            out[name] = np.einsum("df,dfx->xf", back, values[at])
            by_byte = (back[:, :, None] * w[name].T).reshape(-1, WIDTH)
            np.add.at(out["byte"], part.cells[at].ravel(), by_byte)
        return out


def fitted(texts: list[bytes], labels: np.ndarray, seed: int = 0, epochs: int = EPOCHS) -> Network:
    """A network fitted with Adam; without both labels it answers with the share of label 1."""
    network = Network(seed)
    w = network.weights
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    w["bias"][:] = np.log(share / (1 - share))
    if len(set(labels.tolist())) < 2:
        w["out"][:] = 0
        return network
    rng = np.random.default_rng(seed)
    mean = {k: np.zeros_like(v) for k, v in w.items()}
    square = {k: np.zeros_like(v) for k, v in w.items()}
    step = 0
    steps = epochs * -(-len(texts) // BATCH)
    for _ in range(epochs):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            step += 1
            rate = 0.02 * (1 - step / (steps + 1))
            for k, g in network.gradients(cut([texts[i] for i in rows]), labels[rows]).items():
                mean[k] += 0.1 * (g - mean[k])
                square[k] += 0.01 * (g * g - square[k])
                w[k] -= rate * (mean[k] / (1 - 0.9**step)) / (np.sqrt(square[k] / (1 - 0.99**step)) + 1e-7)
    return network


def held_out(id_column: str = "doc_id") -> Column:
    """One row in three is never learned from; null ids are."""
    return F.coalesce(F.crc32(F.col(quoted(id_column)).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text", label_column: str = "quality") -> Network:
    """A network for ``docs`` from a sample of the labelled rows that are not held out.

    The sample has ``SAMPLE_ROWS`` rows at most, those with the smallest hash of their id; texts of more than ``SAMPLE_BYTES`` are
    left out of it. A document with two labels counts as the worse, null labels and ids are passed over.
    """
    key = F.col(quoted(id_column))
    known = labels.where(key.isNotNull() & F.col(quoted(label_column)).isNotNull() & ~held_out(id_column))
    chosen = known.groupBy(key.alias("id")).agg(F.min(quoted(label_column)).alias("label")).orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS)
    texts = docs.select(key.alias("id"), F.coalesce(F.col(quoted(text_column)).cast("string"), F.lit("")).alias("text"))
    texts = texts.where(F.octet_length("text") <= SAMPLE_BYTES)
    rows = texts.join(F.broadcast(chosen), "id").orderBy(F.xxhash64("id", "text")).limit(SAMPLE_ROWS).collect()
    return fitted([r["text"].encode() for r in rows], np.array([r["label"] for r in rows], dtype=np.float32))


def parts(texts: Iterator[bytes]) -> Iterator[list[bytes]]:
    held, size = [], 0
    for text in texts:
        held.append(text)
        size += len(text)
        if size >= CHUNK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def scored(docs: DataFrame, network: Network, text_column: str = "text") -> DataFrame:
    """Every row with ``score`` (0 to 1, higher is better) and ``predicted`` (1 if score >= 0.5, else 0).

    The whole text is read; a null text counts as an empty one, which has a score too. Repeated rows score alike.
    Input columns that bear the name of an added one are replaced; an empty table gives an empty result.
    """

    @F.pandas_udf(T.DoubleType())
    def score(texts: pd.Series) -> pd.Series:
        encoded = ((t or "").encode() for t in texts)
        found = [network.scores(part) for part in parts(encoded)]
        return pd.Series(np.concatenate(found) if found else np.zeros(0))

    value = score(F.col(quoted(text_column)).cast("string"))
    kept = without(docs, ADDED, keep=(text_column,))
    with_score = kept.withColumn("_quality_score", value) if text_column.lower() not in ADDED else kept.withColumn("_quality_score", value)
    names = [quoted(c) for c in without(docs, ADDED).columns]
    return with_score.select(*names, F.col("_quality_score").alias("score"), (F.col("_quality_score") >= 0.5).cast("int").alias("predicted"))
