import hashlib
import re

import numpy as np
import pyarrow.dataset as ds
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.test_decontaminate import plain as plain_hits
from tests.llm.test_simhash import plain_components
from weblode.llm import quality
from weblode.llm.queries import tokenizer_path

BASE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def inputs():
    return ds.dataset(f"{BASE}/documents.parquet").to_table().to_pylist(), ds.dataset(f"{BASE}/benchmark.parquet").to_table().to_pylist()


def test_run_equals_plain_stages(spark, inputs):
    docs, bench = inputs
    frame = spark.read.parquet(f"{BASE}/documents.parquet")
    network = quality.trained(frame, spark.read.parquet(f"{BASE}/labels.parquet"))
    scores = np.concatenate([network.scores([d["text"].encode()]) for d in docs])
    left = [d for d, s in zip(docs, scores, strict=True) if s >= 0.5]
    best = {}
    for d in left:
        key = re.sub(r"[\x20\x09-\x0D]", "", d["text"])
        best[key] = min(best.get(key, d), d, key=lambda x: (-len(x["text"]), x["doc_id"]))
    left = list(best.values())
    component = {k: c for k, _, c in plain_components([(d["doc_id"], d["text"]) for d in left])}
    left = [d for d in left if component[d["doc_id"]] == d["doc_id"]]
    hit = {k: n for k, _, n, _ in plain_hits([(d["doc_id"], d["text"]) for d in left], [(b["item_id"], b["text"]) for b in bench])}
    left = [d for d in left if not hit[d["doc_id"]]]
    library = Tokenizer.from_file(tokenizer_path())
    want = []
    for d in left:
        ids = library.encode(d["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((d["doc_id"], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    got = [tuple(r) for r in corpus_pipeline.run(spark, BASE).collect()]
    assert sorted(got) == sorted(want) and 0 < len(got) < len(docs)


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_awkward_tables(spark, documents, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    extra = "score int, kept string, fingerprint string, spans int, decoded string, h int, _part int"
    rows = [(None, None), (None, ""), (1, ""), (1, None), (2, "some plain words " * 20_000), (3, "é\x00 \U0001f600"), (3, "é\x00 \U0001f600")]
    docs = documents(rows, extra)
    out = stage(spark, docs, BASE)
    assert out.columns == docs.columns or name == "bpe"
    assert out.count() <= len(rows)
    assert stage(spark, documents([], extra), BASE).count() == 0
