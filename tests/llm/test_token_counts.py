import json
import random

import pytest
from tokenizers import Tokenizer

from weblode.llm import blocks, token_counts
from weblode.llm.pretokens import ByteLevel
from weblode.llm.queries import tokenizer_path

PATH = tokenizer_path("byte_bpe_50k.json")


def plain(rows, limit=512):
    library = Tokenizer.from_file(PATH)
    out = []
    for k, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False).ids)
        out.append((k, len((t or "").encode()), n, n > limit))
    return out


def texts():
    rng = random.Random(4)
    parts = ["It's", " they've", "''s", "\n\n ", "\t", "  ", " 12³", "Ⅷ", "\x85", "　", "᠎", "\x1c", "é", "é", "中文", "!?", "'", "<|endoftext|>", "<|endoftext", "\U0001f600", "࢏", "\U00010940", "ᲀ", "\x00", "word", " Word", "_", "ß"]
    mixed = ["".join(rng.choices(parts, k=rng.choice([1, 3, 20, 200]))) for _ in range(150)]
    return [None, "", " ", "x" * 20_000, "ab " * 30_000, "<|endoftext|>", *mixed, *mixed[:5]]


@pytest.mark.parametrize("chars", [blocks.BLOCK_CHARS, 50])
def test_equals_library(spark, documents, monkeypatch, chars):
    monkeypatch.setattr(blocks, "BLOCK_CHARS", chars)
    rows = [(None if i % 40 == 0 else i, t) for i, t in enumerate(texts())]
    docs = documents(rows, "id string, block int, n_tokens string, words string, pieces int")
    got = [tuple(r) for r in token_counts.token_counts(docs, PATH).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_many_buckets(spark, documents, monkeypatch):
    monkeypatch.setattr(token_counts, "BUCKET_BYTES", 64)
    rows = list(enumerate(texts()[-40:]))
    assert sorted(map(tuple, token_counts.token_counts(documents(rows), PATH, limit=20).collect())) == plain(rows, 20)


def test_empty_table(spark, documents):
    out = token_counts.token_counts(documents([]), PATH)
    assert out.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"] and out.count() == 0


def test_each_pretoken_is_one_alone(spark):
    vocabulary = ByteLevel(PATH)
    for text in texts()[6:]:
        words = vocabulary.cut(text)
        assert words == vocabulary.by_library(text) and "".join(words) == text
        assert all(vocabulary.by_library(w) == [w] for w in words)


def test_other_kinds_are_refused(tmp_path):
    with pytest.raises(ValueError):
        ByteLevel(tokenizer_path())
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"] = {"type": "NFC"}
    (tmp_path / "v.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        ByteLevel(str(tmp_path / "v.json"))
