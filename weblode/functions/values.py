"""Value typing: what a declared feature datatype makes of an extracted text."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from weblode.functions.core import MOST_BRANCHES, MOST_PATTERNS, blank_to_null, first_of, java_pattern, let
from weblode.functions.dictionary import first_key, first_word, found_in

# The text given to a value that fits no category.
OTHER_CATEGORY = "Other Category"

# Date patterns in the order they are tried, and how the groups become year-month-day.
DATE_PATTERNS = (
    (r"(\d{1,2})-(\d{1,2})-(\d{4})", "$3-$2-$1"),
    (r"(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$2-$1"),
    (r"(\d{4})-(\d{1,2})-(\d{1,2})", "$1-$2-$3"),
    (r"(\d{4})\\(\d{1,2})\\(\d{1,2})", "$1-$2-$3"),
    (r"(\d{4})-(\d{1,2})", "$1-$2-01"),
    (r"(\d{1,2})-(\d{4})", "$2-$1-01"),
)

# A postcode is four digits, a space and two letters.
POSTCODE = r"\d{4} [A-Za-z]{2}"

NUMERIC = ("currency", "int", "decimal")


def numeric_token(text: Column) -> Column:
    """First whitespace-separated token that keeps something once all but digits ``.`` ``,`` is deleted."""
    tokens = F.transform(
        F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda t: F.regexp_replace(t, r"(?U)[^\d.,]+", "")
    )
    return F.get(F.filter(tokens, lambda t: t != ""), F.lit(0))


def normal_text(text: Column) -> Column:
    """Line breaks become spaces, tabs go, double spaces are deleted, double dots are halved."""
    # Replacements in order, one pass each.
    steps = (("\n", " "), ("\r", ""), ("\t", ""), ("  ", ""), ("..", "."))
    return reduce(lambda t, s: F.replace(t, F.lit(s[0]), F.lit(s[1])), steps, text)


def date_text(text: Column) -> Column:
    """First date pattern that occurs, as unpadded ``yyyy-m-d``; NULL when none does."""
    out = F.lit(None).cast("string")
    for pattern, groups in reversed(DATE_PATTERNS):
        whole = rf"(?Us)^.*?{pattern}.*$"
        out = F.when(text.rlike(java_pattern(pattern)), F.regexp_replace(text, whole, groups)).otherwise(out)
    return out


def date_value(text: Column) -> Column:
    """The same date as a DATE, NULL when there is no such day."""
    return F.try_to_date(date_text(text), "yyyy-M-d")


def country(text: Column, countries: Sequence[tuple[str, str]]) -> Column:
    """First country whose name occurs in the text, else the country of that code, else the text.

    ``countries`` are (name, alpha-2 code) pairs in order of precedence.
    """
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(c).alias("code")) for n, c in countries])
    if len(countries) > MOST_BRANCHES:
        named = first_key(text, {name: name for name, _ in countries}, None)
    else:
        named = F.get(F.filter(table, lambda c: F.contains(text, c["name"])), F.lit(0))["name"]
    coded = F.get(F.filter(table, lambda c: c["code"] == text), F.lit(0))["name"]
    return F.coalesce(named, coded, text)


def category(text: Column, expected: Mapping[str, str]) -> Column:
    """Value of the first key found as a whole word, ignoring case; keys are regular expressions."""
    if not expected:
        return F.when(text.isNotNull(), F.lit(OTHER_CATEGORY))
    if len(expected) > MOST_PATTERNS:
        lookup: dict[str, str] = {}
        for key, value in expected.items():
            lookup.setdefault(key.lower(), value)
        return F.when(text.isNotNull(), let(F.lower(text), lambda lowered: first_word(lowered, lookup, OTHER_CATEGORY)))
    lowered = F.lower(text)
    found = ((lowered.rlike(java_pattern(rf"\b{key.lower()}\b")), value) for key, value in expected.items())
    return F.when(text.isNotNull(), first_of(found, OTHER_CATEGORY))


def category_by_votes(text: Column, expected: Mapping[str, str]) -> Column:
    """Category with the most keys contained in the text; a tie goes to the one counted first."""
    ballots: dict[str, list[tuple[int, str]]] = {}
    for rank, (key, value) in enumerate(expected.items()):
        ballots.setdefault(value, []).append((rank, key.lower()))
    if not ballots:
        return F.when(text.isNotNull(), F.lit(OTHER_CATEGORY))
    if len(expected) > MOST_BRANCHES:
        return F.when(text.isNotNull(), let(F.lower(text), lambda lowered: _votes_of_many(lowered, expected)))

    def count(lowered):
        tallies = []
        for value, keys in ballots.items():
            held = F.filter(
                F.array(*[F.struct(F.lit(r).alias("rank"), F.lit(k).alias("key")) for r, k in keys]),
                lambda e: F.contains(lowered, e["key"]),
            )
            first = F.get(held, F.lit(0))["rank"]
            tallies.append(
                F.struct(
                    F.size(held).alias("votes"),
                    (-F.coalesce(first, F.lit(len(expected)))).alias("earliness"),
                    F.lit(value).alias("value"),
                )
            )
        best = F.array_max(F.array(*tallies))
        return let(best, lambda b: F.when(b["votes"] > 0, b["value"]).otherwise(F.lit(OTHER_CATEGORY)))

    return F.when(text.isNotNull(), let(F.lower(text), count))


def _votes_of_many(lowered: Column, expected: Mapping[str, str]) -> Column:
    meant: dict[str, list[tuple[int, str | None]]] = {}
    for rank, (key, value) in enumerate(expected.items()):
        meant.setdefault(key.lower(), []).append((rank, value))

    def elected(held):
        def tally(value):
            own = F.transform(F.filter(held, lambda e: e["value"] == value), lambda e: e["rank"])
            return F.struct(F.size(own).alias("votes"), (-F.array_min(own)).alias("earliness"), value.alias("value"))

        named = F.array_distinct(F.transform(held, lambda e: e["value"]))
        best = F.array_max(F.transform(named, tally))["value"]
        return F.coalesce(best, F.lit(OTHER_CATEGORY))

    return let(F.array_distinct(found_in(lowered, meant)), elected)


def postcode(text: Column) -> Column:
    return blank_to_null(F.regexp_extract(text, java_pattern(POSTCODE), 0))


def place_text(text: Column, patterns: Sequence[str] | None) -> Column:
    """What is looked up for a location: group 1 of the first pattern, or the text itself."""
    if not patterns:
        return text
    return blank_to_null(F.regexp_extract(text, java_pattern(patterns[0]), 1))


def integer(text: Column) -> Column:
    """Commas and dots are deleted before the cast, so ``1,234.50`` is 123450."""
    return F.trim(F.translate(text, ",.", "")).try_cast("bigint")


def truncated_decimal(text: Column) -> Column:
    return F.replace(text, F.lit(","), F.lit("")).try_cast("double").try_cast("bigint")


def remove_literals(text: Column, literals: Sequence[str] | None) -> Column:
    return reduce(lambda t, s: F.replace(t, F.lit(s), F.lit("")), [s for s in literals or () if s], text)


def innermost(text: Column, pattern: str) -> Column:
    """Replace the text by group 1 of ``pattern`` until that stops matching or leaves nothing.

    Group 1 is part of the text, so each step that changes anything shortens it: the text's
    length bounds the steps. Eight are written out, the rest only runs where they do not suffice.
    """
    jvm = java_pattern(pattern)

    def step(t):
        inner = F.regexp_extract(t, jvm, 1)
        return F.when(inner == "", t).otherwise(inner)

    def finish(t):
        steps = F.sequence(F.lit(1), F.length(t))
        return F.when((t == "") | (step(t) == t), t).otherwise(F.aggregate(steps, t, lambda acc, _: step(acc)))

    def unrolled(t, left):
        return let(step(t), (lambda n: unrolled(n, left - 1)) if left > 1 else finish)

    return unrolled(text, 8)


def typed(
    text: Column,
    datatype: str,
    expected: Mapping[str, str] | None = None,
    patterns: Sequence[str] | None = None,
    countries: Sequence[tuple[str, str]] = (),
) -> Column:
    """The expression a declared datatype stands for; an unknown one passes the text through."""
    if datatype in NUMERIC:
        return numeric_token(text)
    if datatype in ("char", "string"):
        return normal_text(text)
    if datatype == "date":
        return date_text(text)
    if datatype == "country":
        if not countries:
            raise ValueError("a country feature needs a table of (name, code) pairs")
        return country(text, countries)
    if datatype == "multivalue":
        return category(text, expected or {})
    if datatype == "zipcode":
        return postcode(text)
    if datatype == "location":
        return place_text(text, patterns)
    return text


def finished(value: Column, datatype: str, removals=None, patterns=None, as_array: bool = False) -> Column:
    """Removal of literals, numeric cast, repeated extraction, array wrapping: in that order."""
    out = remove_literals(value, removals)
    if datatype in ("int", "currency"):
        out = integer(out)
    elif datatype == "decimal":
        out = truncated_decimal(out)
    if patterns:
        out = innermost(out.cast("string"), patterns[0])
    return let(out, lambda v: F.when(v.isNotNull(), F.array(v))) if as_array else out
