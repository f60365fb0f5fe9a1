import hashlib
import random
from collections import Counter

import pytest
import sentencepiece
from tokenizers import Tokenizer

from weblode.llm import alignment, blocks
from weblode.llm.pretokens import byte_letters
from weblode.llm.queries import tokenizer_path

A, B = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")


def ends(pieces):
    out, n = [], 0
    for p in pieces:
        n += len(p)
        out.append(n)
    return out


def plain(rows):
    """Whole texts by both libraries, groups by walking both lists."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    byte_of = {c: i for i, c in enumerate(byte_letters())}
    bytes_a = {i: bytes(byte_of[c] for c in t) for t, i in a.get_vocab().items() if not t.startswith("<|")}
    pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
    bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
    found, counts = [], Counter()
    for k, t in rows:
        ids_a, ids_b = a.encode(" " + (t or ""), add_special_tokens=False).ids, b.encode(t or "")
        whole = (" " + (t or "")).encode()
        if not t or b"".join(bytes_a[i] for i in ids_a) != whole or b"".join(bytes_b[i] for i in ids_b) != whole:
            found.append((k, 0, 0, "", []))
            continue
        ends_a, ends_b = ends(bytes_a[i] for i in ids_a), ends(bytes_b[i] for i in ids_b)
        groups, i, j = [], 0, 0
        for e in sorted(set(ends_a) & set(ends_b)):
            x, y = ends_a.index(e, i) + 1, ends_b.index(e, j) + 1
            groups.append((ids_a[i:x], ids_b[j:y]))
            i, j = x, y
        links = [(g[-1], h[-1]) for g, h in groups]
        counts.update(links)
        written = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        found.append((k, len(ids_a), len(ids_b), hashlib.sha256(written.encode()).hexdigest(), links))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(k, n, m, len(ls), len(ls), sum(counts[x] == best[x[1]] for x in ls), sum(counts[x] for x in ls), d) for k, n, m, d, ls in found]


def texts():
    rng = random.Random(6)
    parts = ["It's", " they've", "a", " b", "  ", "\n", "\t ", " 12", "é", "é", "中文", "<|endoftext|>", "<s>", "</s> ", "<unk>", "\U0001f600", "ﬁ", "　", "\x00", " the", " den", "ung ", "\x1c", "\x85"]
    mixed = ["".join(rng.choices(parts, k=rng.choice([1, 4, 30, 200]))) for _ in range(150)]
    return [None, "", " ", "  a ", "▁x", "a▁ b", "x" * 3000, "some plain words " * 3000, *mixed, *mixed[:4]]


@pytest.mark.parametrize(("chars", "segment"), [(blocks.BLOCK_CHARS, alignment.SEGMENT_CHARS), (60, 5)])
def test_equals_whole_texts_by_the_libraries(spark, documents, monkeypatch, chars, segment):
    monkeypatch.setattr(blocks, "BLOCK_CHARS", chars)
    monkeypatch.setattr(alignment, "SEGMENT_CHARS", segment)
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 30)
    rows = [(None if i % 40 == 0 else i, t) for i, t in enumerate(texts())]
    docs = documents(rows, "id string, block int, n_a string, place string, a int, b string, count string")
    got = [tuple(r) for r in alignment.alignments(docs, A, B).collect()]
    assert sorted(got, key=str) == sorted(plain(rows), key=str)


def test_empty_table(spark, documents):
    out = alignment.alignments(documents([]), A, B)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"] and out.count() == 0


def test_groups_of_a_text():
    pair = alignment.Pair(A, B)
    pair.learn(["aligned", "▁x", "x"])
    n_a, n_b, written, links = pair.words["aligned"]
    assert min(n_a, n_b) >= len(links) == written.count("|") == written.count(";") + 1
    assert pair.words["▁x"] is None and pair.words["x"]
