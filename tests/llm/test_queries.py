"""The registered queries: against their SQL where there is one, else against plain versions."""

import hashlib
import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow.dataset as ds
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tests.llm import test_alignment, test_lm, test_simhash, test_suffixes, test_token_counts
from tests.test_catalog import rows_of
from weblode.llm import queries

BASE = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(BASE), reason="supplied tables are not here")


def sha(data):
    return hashlib.sha256(data).hexdigest()


def crc(key):
    return zlib.crc32(str(key).encode())


@pytest.fixture(scope="module")
def docs():
    return [(d["doc_id"], d["text"]) for d in ds.dataset(f"{BASE}/documents.parquet").to_table().to_pylist()]


def result(spark, name, columns):
    return sorted(map(tuple, entry.queries()[name](spark, BASE).select(*columns).collect()))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    db = duckdb.connect()
    for file in os.listdir(BASE):
        db.execute(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{BASE}/{file}'")
    frame = entry.queries()[name](spark, BASE)
    found = db.execute(entry.oracle_sql()[name])
    names = [c[0] for c in found.description]
    assert sorted(frame.columns) == sorted(names)
    assert rows_of(frame.columns, frame.collect()) == rows_of(names, found.fetchall())


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert set(queries.QUERIES) | {"pipeline"} <= set(entry.queries())


def test_shards(spark, docs):
    got = result(spark, "op2_shuffled_shards", ["doc_id", "size", "text_crc32", "law", "grown_shard", "shard", "slot"])
    assert [g[:5] for g in got] == sorted((k, len(t.encode()) + 1, zlib.crc32(t.encode()), "rows", None) for k, t in docs)
    sizes = Counter(g[5] for g in got)
    assert sorted(g[5:] for g in got) == sorted((s, i) for s in range(8) for i in range(sizes[s]))
    assert max(sizes.values()) - min(sizes.values()) <= 1


def test_tokens(spark, docs):
    library = Tokenizer.from_file(queries.tokenizer_path())
    want = []
    for k, t in docs:
        ids = library.encode(t, add_special_tokens=False).ids
        want.append((k, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False).encode())))
    assert result(spark, "op5_speculative_bpe", ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]) == sorted(want)


def test_counts_of_tokens(spark, docs):
    assert result(spark, "op11_token_counts", ["doc_id", "n_bytes", "n_tokens", "over_limit"]) == sorted(test_token_counts.plain(docs))


def test_groups_and_links(spark, docs):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert result(spark, "op12_alignment", names) == sorted(test_alignment.plain(docs))


def test_scores(spark, docs):
    want = [(k, not keep, *rest) for k, keep, *rest in test_lm.plain([(k, t, crc(k) % 10 != 0) for k, t in docs])]
    got = result(spark, "op6_kneser_ney", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    assert [g[:5] for g in got] == [w[:5] for w in sorted(want)]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in sorted(want)])


def test_kept_bytes(spark, docs):
    texts = [t.encode() for _, t in docs]
    want = []
    for (k, _), t, gone in zip(docs, texts, test_suffixes.plain(texts, 400), strict=True):
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        want.append((k, len(t), int(gone.sum()), runs, sha(np.frombuffer(t, np.uint8)[~gone].tobytes())))
    assert result(spark, "op9_interval_expansion", ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]) == sorted(want)


def test_components(spark, docs):
    assert result(spark, "op10_simhash_pivots", ["doc_id", "fingerprint", "component_id"]) == sorted(test_simhash.plain_components(docs))


def test_held_out_rows_of_the_classifier(spark, docs):
    got = result(spark, "op1_byte_network", ["doc_id", "held_out", "predicted", "score"])
    assert [g[:2] for g in got] == sorted((k, crc(k) % 3 == 1) for k, _ in docs)
    assert all(g[2] == int(g[3] >= 0.5) for g in got)
