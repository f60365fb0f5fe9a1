"""Large dictionaries and rule lists as column expressions: one walk over the text finds every key in it.

Keys become a prefix tree, written as one regular expression that is tried once at each place of a text, and a literal hash
table that says what a found key stands for. The time for a text follows from its length and what occurs in it, not
from the number of keys. Everything stays in the JVM, so it may stand inside lambdas.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from weblode.functions.core import java_pattern, let

ENTRY = "struct<rank:int,value:string>"


def spelled(text: str) -> str:
    """The text as a regular expression that matches just it."""
    return "".join(c if c.isascii() and c.isalnum() else f"\\x{{{ord(c):X}}}" for c in text)


def tree_pattern(keys: Sequence[str], ending: str = "") -> str:
    """A regular expression for the longest key that begins at a place; ``ending`` must hold where a key ends."""
    # Sorted keys with a common beginning are neighbours; a range of them is one node.
    ordered = sorted(set(keys))

    def node(low: int, high: int, depth: int) -> str:
        first, last = ordered[low], ordered[high - 1]
        shared = depth
        while shared < min(len(first), len(last)) and first[shared] == last[shared]:
            shared += 1
        branches, at = [], low + (len(first) == shared)
        while at < high:
            stop = at + 1
            while stop < high and ordered[stop][shared] == ordered[at][shared]:
                stop += 1
            branches.append(node(at, stop, shared))
            at = stop
        if len(first) == shared:
            branches.append(ending)
        inner = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return spelled(first[depth:shared]) + inner

    return node(0, len(ordered), 0)


def found_in(text: Column, meant: Mapping[str, list[tuple[int, str | None]]], whole_words: bool = False, first_only: bool = False) -> Column:
    """What the keys in ``text`` mean: the (rank, value) entries of each, in any order, possibly repeated.

    A key that begins another stands in every text where the longer one does, so it is answered with that. Whole words end
    and begin at word boundaries; keys are then plain ASCII texts. ``first_only`` keeps the lowest rank at each place.
    NULL for a NULL text.
    """
    ending = r"\b" if whole_words else ""
    buckets: list[list[dict]] = [[] for _ in range(max(1, len(meant)))]
    for key in meant:
        entries = []
        for size in range(len(key) + 1):
            # Where a shorter key ends inside this one, the next character tells whether a word ends there.
            if key[:size] in meant and (size == len(key) or not whole_words or re.match(r".{%d}\b" % size, key)):
                entries += [{"rank": r, "value": v} for r, v in meant[key[:size]]]
        if first_only:
            entries = [min(entries, key=lambda e: e["rank"])]
        buckets[zlib.crc32(key.encode()) % len(buckets)].append({"key": key, "entries": entries})
    table = F.from_json(F.lit(json.dumps(buckets)), f"array<array<struct<key:string,entries:array<{ENTRY}>>>>")
    pattern = f"(?U){ending}(?=({tree_pattern(list(meant), ending)}))"

    def entries_of(key: Column) -> Column:
        bucket = F.get(table, F.pmod(F.crc32(key.cast("binary")), F.lit(len(buckets))).cast("int"))
        return F.get(F.filter(bucket, lambda e: e["key"] == key), F.lit(0))["entries"]

    return F.flatten(F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), entries_of))


def first_found(found: Column, default: str | None) -> Column:
    """The value of the entry with the lowest rank, the default if there is none."""
    return let(F.array_min(found), lambda e: F.when(e.isNull(), F.lit(default).cast("string")).otherwise(e["value"]))


def first_key(text: Column, lookup: Mapping[str, str | None], default: str | None) -> Column:
    """What the first key that occurs in the text stands for."""
    return first_found(found_in(text, {k: [(rank, v)] for rank, (k, v) in enumerate(lookup.items())}, first_only=True), default)


def is_plain(key: str) -> bool:
    """Whether a key that is a regular expression is only text, and one whose word boundaries are known beforehand."""
    return re.fullmatch(r"[A-Za-z0-9_ -]+", key) is not None


def first_word(lowered: Column, lookup: Mapping[str, str], default: str | None) -> Column:
    """What the first key that is a whole word of the text stands for; keys are lower-case regular expressions.

    Plain keys are found in one walk. Each of the others is tried on the text.
    """
    ranked = list(enumerate(lookup.items()))
    plain: dict[str, list[tuple[int, str | None]]] = {}
    for rank, (key, value) in ranked:
        if is_plain(key):
            plain.setdefault(key, []).append((rank, value))
    others = [{"rank": r, "value": v, "pattern": java_pattern(rf"\b{k}\b")} for r, (k, v) in ranked if not is_plain(k)]
    found = [found_in(lowered, plain, whole_words=True, first_only=True)] if plain else []
    if others:
        table = F.from_json(F.lit(json.dumps(others)), "array<struct<rank:int,value:string,pattern:string>>")
        held = F.filter(table, lambda e: F.regexp_like(lowered, e["pattern"]))
        found.append(F.transform(held, lambda e: F.struct(e["rank"].alias("rank"), e["value"].alias("value"))))
    return first_found(F.concat(*found), default)


def required_texts(pattern: str) -> list[str]:
    """Texts that stand in everything the regular expression matches: its literal runs outside of choices and options."""
    if re.search(r"\(\?[^:]", pattern):
        return []  # flags, look-around and conditions change what a literal means
    runs, run = [], ""
    for kind, value in re._parser.parse(pattern):
        if kind is re._constants.LITERAL:
            run += chr(value)
            continue
        if run:
            runs.append(run)
        run = ""
    return [*runs, run] if run else runs


def any_rule(text: Column, rules: Sequence[str], tried: Callable[[Sequence[str]], Column]) -> Column:
    """Whether any rule (a regular expression) is found in the text: ``tried`` says so for a few rules, one after the other.

    A rule is tried only where its rarest required text occurs; rules without one are always tried.
    """
    factors = {rule: [f for f in required_texts(rule) if len(f) > 2] for rule in dict.fromkeys(rules)}
    uses: dict[str, int] = {}
    for own in factors.values():
        for factor in own:
            uses[factor] = uses.get(factor, 0) + 1
    meant: dict[str, list[tuple[int, str | None]]] = {}
    for rank, (rule, own) in enumerate(factors.items()):
        if own:
            meant.setdefault(min(own, key=lambda f: (uses[f], -len(f))), []).append((rank, java_pattern(rule)))
    always = [rule for rule, own in factors.items() if not own]
    held = F.exists(F.array_distinct(found_in(text, meant)), lambda e: F.regexp_like(text, e["value"])) if meant else F.lit(False)
    return tried(always) | held
