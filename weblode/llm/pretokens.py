"""Pre-tokens of byte-level vocabularies, cut as the tokenizers library cuts them."""

from __future__ import annotations

import json
import re

import regex
import tiktoken
from tokenizers import Tokenizer

# Fixed value: how byte-level vocabularies of this kind cut a text.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

# Longer pre-tokens are merged by the tokenizers library, whose time grows less with their length.
FAST_CHARS = 64


def byte_letters() -> list[str]:
    """The printable letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class ByteLevel:
    """A byte-level BPE file: its pre-tokens, and the pieces of one."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        cut, model = spec["pre_tokenizer"] or {}, spec["model"]
        if cut.get("type") != "ByteLevel" or cut.get("add_prefix_space") or not cut.get("use_regex") or spec["normalizer"]:
            raise ValueError(f"{path}: not a byte-level vocabulary with the usual pattern and without normalizer")
        if model["type"] != "BPE" or model["dropout"] or model["unk_token"] or model.get("end_of_word_suffix"):
            raise ValueError(f"{path}: not a plain BPE model")
        if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: an added token that takes more than its own text")
        tokenizer = Tokenizer.from_file(path)
        self.library, self.model = tokenizer.pre_tokenizer, tokenizer.model
        self.added = {t["content"] for t in spec["added_tokens"]}
        self.added_cut = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        letters = byte_letters()
        self.bytes_of = {c: b for b, c in enumerate(letters)}
        self.letters = dict(enumerate(letters))
        self.bytes_by_id = {i: bytes([self.bytes_of[c] for c in t]) for t, i in model["vocab"].items() if t not in self.added}
        # Where ids follow the order of merges, tiktoken's merging of one piece gives the same ids, sooner.
        merged = (model["vocab"][a + b] for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]))
        ordered = all(i - rank == len(letters) for rank, i in enumerate(merged))
        ranks = {b: i for i, b in self.bytes_by_id.items()}
        self.fast = tiktoken.Encoding("pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe if ordered else None
        self.find = regex.compile(PATTERN)
        self.same: set[str] = set()
        self.other: set[str] = set()

    def spelled(self, word: str) -> str:
        return word.encode().decode("latin-1").translate(self.letters)

    def pieces(self, word: str) -> list[int]:
        """The ids of one pre-token."""
        if self.fast and len(word) <= FAST_CHARS:
            return self.fast.encode_single_piece(word.encode())
        return [t.id for t in self.model.tokenize(self.spelled(word))]

    def by_library(self, text: str) -> list[str]:
        return [text[a:b] for _, (a, b) in self.library.pre_tokenize_str(text)]

    def known_alike(self, text: str) -> bool:
        """Whether the library takes every character of the text for what the pattern takes it for here.

        The two have their own Unicode tables. Each character is tried once per worker, between letter and
        digit and between signs, which tells letters, numbers, white space and the rest apart.
        """
        if text.isascii():
            return True
        chars = set(text)
        for c in chars - self.same - self.other:
            alike = all(self.by_library(t) == self.find.findall(t) for t in (f"a{c}1", f"!{c}!"))
            (self.same if alike else self.other).add(c)
        return self.other.isdisjoint(chars)

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text, joined the text itself; strings of added tokens are plain text."""
        return self.find.findall(text) if self.known_alike(text) else self.by_library(text)

    def cut_added(self, text: str) -> list[str]:
        """The pre-tokens of a text; a string of an added token stands for itself."""
        if self.added_cut is None:
            return self.cut(text)
        out = []
        for i, part in enumerate(self.added_cut.split(text)):
            if i % 2:
                out.append(part)
            elif part:
                out += self.cut(part)
        return out
