import numpy as np
import pytest

from weblode.llm import quality, queries


LONG = "a plain text of words and more words here " * 5_000


@pytest.fixture
def network():
    return quality.Network(3)


def hash_finder():
    """Weights by hand: one filter responds to the byte '#', and a response means a bad text."""
    network = quality.Network()
    for values in network.weights.values():
        values[:] = 0
    network.weights["byte"][ord("#"), 0] = 1
    for name in ("left", "right"):
        network.weights[name][:: quality.WIDTH, 0] = 1
    network.weights["out"][0], network.weights["bias"][:] = -9, 3
    return network


def test_rows_are_scored_whole(spark, documents):
    network = hash_finder()
    rows = [(1, None), (1, ""), (2, "plain words"), (3, LONG + "of### words$$$ and### "), (4, LONG), (None, "é\x00" * 50), (2, "plain words")]
    frame = quality.scored(documents(rows, "score string, Predicted int, x int"), network)
    got = frame.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == sorted(rows, key=str)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    by = {r.doc_id: r.predicted for r in got}
    assert by[3] == 0 and by[4] == 1  # what decides stands at the very end
    assert quality.scored(documents([]), network).count() == 0
    assert [c.lower() for c in frame.columns].count("predicted") == 1


def test_scores_equal_a_plain_convolution(network):
    texts = [b"", b"x", b"ab " * 40, bytes(range(256)) * 3]
    w = network.weights
    for text, score in zip(texts, network.scores(texts), strict=True):
        data = text + bytes(-len(text) % 16 or (16 if not text else 0))
        data += bytes(max(0, 32 - len(data)))
        responses = []
        for at in range(0, len(data) - 16, 16):
            r = w["shift"].astype(float).copy()
            for half, name in ((0, "left"), (16, "right")):
                r += w["byte"][list(data[at + half : at + half + 16])].ravel() @ w[name]
            for i, lag in enumerate(quality.LAGS):
                same = sum(1 for p in range(at, at + 32) if p >= lag and data[p] and data[p] == data[p - lag])
                r += (same / 32) ** 3 * w["lag"][i]
            responses.append(r)
        logit = np.tanh(np.max(responses, axis=0)) @ w["out"] + w["bias"][0]
        assert abs(score - 1 / (1 + np.exp(-logit))) < 1e-4


def test_gradients_are_those_of_the_loss(network):
    part, labels = quality.cut([b"some### text", b"plain " * 9]), np.array([0, 1], dtype=np.float32)
    found = network.gradients(part, labels)

    def loss():
        p = network.scores([b"some### text", b"plain " * 9])
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    for name in ("out", "left", "byte", "lag"):
        at = np.unravel_index(np.abs(found[name]).argmax(), found[name].shape)
        old, step = network.weights[name][at], 1e-2
        ends = []
        for sign in (1, -1):
            network.weights[name][at] = old + sign * step
            ends.append(loss())
        network.weights[name][at] = old
        assert abs((ends[0] - ends[1]) / (2 * step) - found[name][at]) < 0.05 * abs(found[name][at]) + 1e-4


def test_training_rows_and_few_labels(spark, documents):
    docs = documents([(i, "x") for i in range(30)])
    labels = spark.createDataFrame([(i, 1) for i in range(30)] + [(None, 0), (3, None)], "doc_id long, quality int")
    scores = {r.score for r in quality.scored(docs, quality.trained(docs, labels)).collect()}
    assert len(scores) == 1 and scores.pop() > 0.9
    assert {r.score for r in quality.scored(docs, quality.trained(docs, labels.limit(0))).collect()} == {0.5}


def test_held_out_accuracy(spark):
    base = "/root/testdata/sf0.01"
    scored = queries.op1(spark, base)
    labels = spark.read.parquet(f"{base}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").select("predicted", "quality", "score").collect()
    right = np.mean([r.predicted == r.quality for r in rows])
    kept = np.mean([r.predicted for r in rows if r.quality == 1])
    assert scored.count() == 1000 and right > 0.93 and kept > 0.97, (right, kept)
