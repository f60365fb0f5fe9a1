import hashlib
import random
import time

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from weblode.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_padding()
    tokenizer.no_truncation()
    return tokenizer


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary(PATH)


TEXTS = [
    None, "", " \n\t ", "Hello World's 123 cats'll", "İstanbul ΟΔΟΣ ΣΑΣ ǅ ﬁ ẞ", "éä ẛ̣", "a<|endoftext|>b <|startoftext|><|x|>",
    "日本語のテキスト 👩‍👩‍👧 ½ ²", "\u0085  x\x00\x1c​y", "aaaaaaaa" * 50, "thththth ingingthe", "x" * 5000, "!!!??!!…—''s's", "re've d'll 'S 'LL", "؀ ३ ⅷ \U0001d7d8",
]


def test_like_the_library(spark, documents, library):
    rng = random.Random(1)
    parts = ["ing", "th", "the", "an", "er", "é", "ö", "tion", "q", "zz", " ", "'", "1", "ñ", "ß", "o", "n", "e"]
    texts = TEXTS + ["".join(rng.choice(parts) for _ in range(rng.randrange(300))) for _ in range(300)]
    frame = bpe.encoded(documents(list(enumerate(texts)), "decoded int, Token_ids string, x int"), PATH)
    for row in frame.collect():
        want = library.encode(row.text or "", add_special_tokens=False).ids
        assert np.frombuffer(row.token_ids, "<u4").tolist() == want, row.text
        assert row.decoded == library.decode(want, skip_special_tokens=False)
    digest = {r.doc_id: r for r in bpe.digests(frame).collect()}
    assert digest[1].n_tokens == 0 and digest[1].decoded_sha256 == hashlib.sha256(b"").hexdigest()
    assert bpe.encoded(documents([]), PATH).count() == 0


def test_words_of_letters(vocabulary, library):
    """Every proposal is mended where the check fails; both ways are taken."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdehinorst") for _ in range(rng.randrange(1, 14))) for _ in range(20_000)]
    got = vocabulary.encode_words(words)
    assert got == [library.encode(w, add_special_tokens=False).ids for w in words]
    spelled = [w + bpe.END for w in words]
    right = [vocabulary.greedy(s) == g for s, g in zip(spelled, got, strict=True)]
    assert any(right) and not all(right)


def test_check_equals_merging_of_pairs(vocabulary):
    rng = np.random.default_rng(4)
    left = [i for i, t in vocabulary.texts.items() if not t.endswith(bpe.WORD_END) and i not in vocabulary.special.values()]
    a = rng.choice(left, 20_000)
    b = rng.choice([i for i in vocabulary.texts if i not in vocabulary.special.values() and vocabulary.texts[i].endswith(bpe.WORD_END)], 20_000)
    fine = vocabulary.compatible(a, b)
    for x, y, ok in zip(a.tolist(), b.tolist(), fine.tolist(), strict=True):
        word = vocabulary.texts[x] + vocabulary.texts[y].removesuffix(bpe.WORD_END) + bpe.END
        assert ok == (vocabulary.merged(word) == [x, y])
    assert vocabulary.decode(vocabulary.merged("the" + bpe.END)) == "the</w>"


def test_memory_bound_changes_nothing(vocabulary, monkeypatch):
    texts = ["the cat sat", "on the mat", "cat"]
    want = [vocabulary.encode([t])[0] for t in texts]
    monkeypatch.setattr(bpe, "CACHE_WORDS", 1)
    assert [vocabulary.encode([t])[0] for t in texts] == want
    assert [len(c) for c in bpe.chunks(iter(["x" * bpe.CHUNK_CHARS, None, "y"]))] == [1, 2]


def test_very_long_words(vocabulary, library):
    """Merging by a heap: ties go to the left, and 200,000 letters take seconds, not an hour."""
    rng = random.Random(6)
    for letters in ("a", "ab", "th", "acgt", "einrst"):
        word = "".join(rng.choice(letters) for _ in range(3000))
        assert vocabulary.merged(word + bpe.END) == library.encode(word, add_special_tokens=False).ids
    long = "".join(rng.choice("acgt") for _ in range(200_000))
    started = time.process_time()
    ids = np.frombuffer(vocabulary.encode([long])[0][0], "<u4").tolist()
    assert time.process_time() - started < 10
    assert ids == library.encode(long, add_special_tokens=False).ids
