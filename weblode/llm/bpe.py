"""Byte-pair encoding by speculation and verification, and decoding."""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weblode.llm.common import quoted, with_fields, without

# How this vocabulary's tokenizer cuts a lower-cased text into words, and its mark of a word's end.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"
ADDED = ("token_ids", "decoded")
# Encoded words a worker remembers, and characters it works on at a time: bounds of memory, not of results.
CACHE_WORDS = 400_000
CHUNK_CHARS = 1 << 21
LOCKSTEP_LETTERS = 48  # longer words are merged one by one
END = "\n"  # stands for the mark of a word's end, one character that no byte is mapped to
NO_RANK = np.int64(1 << 40)


def byte_letters() -> list[str]:
    """The printable letter by which byte-level vocabularies write each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


class Vocabulary:
    """Tokens, merge ranks and the parts each token was merged from."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocabulary = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.texts = {i: t for t, i in [*vocabulary.items(), *self.special.items()]}
        self.ids = {t.removesuffix(WORD_END) + END if t.endswith(WORD_END) else t: i for t, i in vocabulary.items()}
        # The length of the longest token that begins with two given letters.
        self.longest: dict[str, int] = {}
        for token in self.ids:
            self.longest[token[:2]] = max(len(token), self.longest.get(token[:2], 0))
        n = max(self.texts) + 1
        self.rank = np.full(n, -1, dtype=np.int64)
        self.left, self.right = np.arange(n), np.arange(n)
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(spec["model"]["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            merged, parts = vocabulary[a + b], (vocabulary[a], vocabulary[b])
            self.rank[merged], (self.left[merged], self.right[merged]) = rank, parts
            self.merges.setdefault(parts, (rank, merged))
        keys = np.array([(a << 32) | b for a, b in self.merges], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.merges.values()], dtype=np.int64)[order]
        self.merged_ids = np.zeros(len(spec["model"]["merges"]), dtype=np.int64)
        for rank, merged in self.merges.values():
            self.merged_ids[rank] = merged
        self.letters = byte_letters()
        self.words = regex.compile(WORDS)
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.known: dict[str, tuple[bytes, str, int]] = {}

    def pair_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = (a << 32) | b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_RANK)

    def greedy(self, word: str) -> list[int]:
        """The longest token at each place; ``word`` ends with END, which never stands alone."""
        ids, longest, out, at, size = self.ids, self.longest, [], 0, len(word)
        while at < size:
            stop = at + longest.get(word[at : at + 2], 1)
            if stop > size:
                stop = size
            while (token := ids.get(word[at:stop])) is None or stop == size - 1:
                stop -= 1
            out.append(token)
            at = stop
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether exact merging of two tokens' text gives just these two tokens, for many pairs at once.

        Merges are undone from the last one on. While a state of the border lasts, that is until the merge
        undone last, no merge across the border may come first; of equal ranks the one further left does.
        """
        fine = np.ones(len(left), dtype=bool)
        at, a, b = np.arange(len(left)), left.copy(), right.copy()
        until = np.full(len(left), NO_RANK)
        while len(at):
            crossed = self.pair_rank(a, b) < until
            fine[at[crossed]] = False
            rank_a, rank_b = self.rank[a], self.rank[b]
            go = ~crossed & ((rank_a >= 0) | (rank_b >= 0))
            at, a, b, rank_a, rank_b = at[go], a[go], b[go], rank_a[go], rank_b[go]
            undo_left = rank_a > rank_b
            until = np.where(undo_left, rank_a, rank_b + 1)
            a, b = np.where(undo_left, self.right[a], a), np.where(undo_left, b, self.left[b])
        return fine

    def merged(self, word: str) -> list[int]:
        """Exact merging: the lowest rank first, of equal ones the leftmost.

        Pairs wait in a heap by rank and place; tokens are linked to their neighbours. A pair that has changed since it was
        put there is passed over, so a word of n letters takes n log n steps.
        """
        out = [self.ids[c] for c in word[:-2]] + [self.ids[word[-2:]]]
        size, merges = len(out), self.merges
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        waiting = [(merges[p][0], i) for i, p in enumerate(zip(out, out[1:], strict=False)) if p in merges]
        heapq.heapify(waiting)
        while waiting:
            rank, at = heapq.heappop(waiting)
            follower = after[at]
            if out[at] < 0 or follower == size:
                continue
            now = merges.get((out[at], out[follower]))
            if now is None or now[0] != rank:
                continue
            out[at], out[follower], after[at] = now[1], -1, after[follower]
            if after[at] < size:
                before[after[at]] = at
            for left in (before[at], at):
                if left >= 0 and after[left] < size and (found := merges.get((out[left], out[after[left]]))):
                    heapq.heappush(waiting, (found[0], left))
        return [t for t in out if t >= 0]

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Proposals for all words, one vectorised check of all adjacent tokens, exact merging where it fails."""
        spelled = [(w if w.isascii() and w.isprintable() else "".join([self.letters[b] for b in w.encode()])) + END for w in words]
        proposed = [self.greedy(w) for w in spelled]
        sizes = np.array([len(p) for p in proposed], dtype=np.int64)
        flat = np.fromiter((t for p in proposed for t in p), dtype=np.int64, count=int(sizes.sum()))
        word_of = np.repeat(np.arange(len(words)), sizes)
        inner = np.flatnonzero(word_of[1:] == word_of[:-1])
        fine = self.compatible(flat[inner], flat[inner + 1])
        failed = np.unique(word_of[inner[~fine]]).tolist()
        short = [i for i in failed if len(spelled[i]) <= LOCKSTEP_LETTERS]
        for i, ids in zip(short, self.merged_together([spelled[i] for i in short]), strict=True):
            proposed[i] = ids
        for i in failed:
            if len(spelled[i]) > LOCKSTEP_LETTERS:
                proposed[i] = self.merged(spelled[i])
        return proposed

    def merged_together(self, words: list[str]) -> list[list[int]]:
        """``merged`` for many short words: each step makes the next merge of every word."""
        out: list[list[int]] = [[] for _ in words]
        by_size: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_size.setdefault(-(-len(word) // 4), []).append(i)
        for group in by_size.values():
            width = max(len(words[i]) for i in group) - 1
            tokens = np.full((len(group), width), -1, dtype=np.int64)
            for row, i in enumerate(group):
                word = words[i]
                tokens[row, : len(word) - 2] = [self.ids[c] for c in word[:-2]]
                tokens[row, len(word) - 2] = self.ids[word[-2:]]
            rows, ranks = np.array(group), self.ranks_of(tokens[:, :-1], tokens[:, 1:])
            columns = np.arange(width)
            while len(rows):
                at = ranks.argmin(axis=1)
                each = np.arange(len(rows))
                ended = ranks[each, at] == NO_RANK
                for row in np.flatnonzero(ended).tolist():
                    out[rows[row]] = [t for t in tokens[row].tolist() if t >= 0]
                rows, tokens, ranks, at = rows[~ended], tokens[~ended], ranks[~ended], at[~ended]
                each = each[: len(rows)]
                merged = self.merged_ids[ranks[each, at]]
                moved = np.minimum(columns + (columns > at[:, None]), width - 1)
                tokens = np.take_along_axis(tokens, moved, axis=1)
                tokens[:, -1] = -1
                tokens[each, at] = merged
                ranks = np.take_along_axis(ranks, moved[:, :-1].clip(max=width - 2), axis=1)
                ranks[:, -1] = NO_RANK
                ranks[each, np.minimum(at, width - 2)] = self.ranks_of(merged, tokens[each, np.minimum(at + 1, width - 1)])
                before = np.flatnonzero(at > 0)
                ranks[before, at[before] - 1] = self.ranks_of(tokens[before, at[before] - 1], merged[before])
        return out

    def ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.where((a >= 0) & (b >= 0), self.pair_rank(a, b), NO_RANK)

    def split(self, text: str) -> list[str]:
        """Words and special tokens in order."""
        if self.specials and "<|" in text:
            out = []
            for i, part in enumerate(self.specials.split(text)):
                out += [part] if i % 2 else self.split_plain(part)
            return out
        return self.split_plain(text)

    def split_plain(self, text: str) -> list[str]:
        if not text.isascii():
            # Lower-casing goes by single characters: no form of sigma depends on its neighbours.
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
        return self.words.findall(text.lower())

    def encode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """(ids as little-endian unsigned 32-bit integers, decoded text) of each text."""
        cut = [self.split(t) for t in texts]
        if len(self.known) > CACHE_WORDS:
            self.known = {}
        known = self.known
        for text, i in self.special.items():
            known[text] = (i.to_bytes(4, "little"), text)
        new = list({w for words in cut for w in words if w not in known})
        for word, ids in zip(new, self.encode_words(new), strict=True):
            known[word] = (np.array(ids, dtype="<u4").tobytes(), " ".join([self.texts[i] for i in ids]))
        out = []
        for words in cut:
            found = [known[w] for w in words]
            out.append((b"".join([f[0] for f in found]), " ".join([f[1] for f in found])))
        return out

    def decode(self, ids) -> str:
        """Special tokens included; this vocabulary has no decoder, so tokens are joined by spaces."""
        return " ".join([self.texts[i] for i in ids if i in self.texts])


def chunks(texts: Iterator[str | None]) -> Iterator[list[str]]:
    held, size = [], 0
    for text in texts:
        held.append(text or "")
        size += len(held[-1])
        if size >= CHUNK_CHARS:
            yield held
            held, size = [], 0
    if held:
        yield held


def encoded(docs: DataFrame, vocabulary_path: str, text_column: str = "text") -> DataFrame:
    """Every row with ``token_ids`` (little-endian unsigned 32-bit integers) and the ``decoded`` text.

    A null or empty text has no tokens. Special tokens that stand in a text are encoded as such, none are
    added. Repeated rows are encoded alike; input columns that bear the name of an added one are replaced. The text column
    is read whole, and a text of any length is one row; a word of n letters takes n log n steps. The vocabulary is a file of the
    workers' machines, read once per worker.
    """
    docs = without(docs, ADDED)
    names = docs.columns
    place = [n.lower() for n in names].index(text_column.lower())
    held: list[Vocabulary] = []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not held:
            held.append(Vocabulary(vocabulary_path))
        for batch in batches:
            at = 0
            texts = (x.as_py() for x in batch.column(place))
            for chunk in chunks(texts):
                rows = held[0].encode(chunk)
                own = batch.slice(at, len(chunk))
                at += len(chunk)
                added = [pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())]
                yield pa.RecordBatch.from_arrays([*own.columns, *added], names=[*names, *ADDED])

    return docs.select(*map(quoted, names)).mapInArrow(run, with_fields(docs, "token_ids binary, decoded string"))


def digests(frame: DataFrame, id_column: str = "doc_id") -> DataFrame:
    return frame.select(
        id_column,
        F.expr("octet_length(token_ids) div 4").cast("long").alias("n_tokens"),
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )
