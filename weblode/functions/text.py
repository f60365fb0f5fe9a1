"""Text expressions used by vocabulary mining and the typed model."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endings that a cut phrase may be left with, tried in this order.
DANGLING_ENDINGS = (
    " in",
    " with",
    " of",
    " a",
    " and",
    " und",
    " the",
    " to",
    " including",
    " for",
    " and  more",
)

UPPER = r"\p{IsUppercase}"
LOWER = r"\p{IsLowercase}"
CASE_CHANGE = rf"(?<=[^{UPPER}])(?={UPPER})|(?={UPPER}[^{UPPER}])"


def camel_pieces(text: Column) -> Column:
    """Cut at every change of case; an upper-case run keeps its last letter for the next word."""
    return F.filter(F.split(text, CASE_CHANGE), lambda piece: piece != "")


def delimiter_pieces(text: Column, delimiters: Sequence[str]) -> Column:
    """Split by each delimiter on its own and pool the pieces."""
    if not delimiters:
        return F.array().cast("array<string>")
    return F.concat(*[F.split(text, "\\Q" + d.replace("\\E", "\\E\\\\E\\Q") + "\\E") for d in delimiters])


def letters_only(text: Column) -> Column:
    """ASCII letters and spaces, trimmed. The named class is matched by table, a range by range is not."""
    return F.trim(F.regexp_replace(text, r"[^\p{Alpha} ]+", ""))


def repair_ending(text: Column) -> Column:
    """If the text ends with a dangling word, delete every occurrence of it; cascades down the list."""
    any_ending = reduce(lambda a, b: a | b, (F.endswith(text, F.lit(e)) for e in DANGLING_ENDINGS))
    repaired = F.aggregate(
        F.array(*[F.lit(e) for e in DANGLING_ENDINGS]),
        text,
        lambda t, e: F.when(F.endswith(t, e), F.replace(t, e, F.lit(""))).otherwise(t),
    )
    return F.when(any_ending, repaired).otherwise(text)


def is_candidate(text: Column) -> Column:
    """More than one character, and neither all upper-case nor all lower-case."""
    return (F.length(text) > 1) & ~text.rlike(f"^(?:{UPPER}+|{LOWER}+)$")


def digits_only(text: Column) -> Column:
    """The digits of the text, ``0`` when it has none; missing stays missing."""
    digits = F.regexp_replace(text.cast("string"), "[^0-9]", "")
    return F.when(digits == "", F.lit("0")).otherwise(digits)


def valid_text(value: Column) -> Column:
    """The text without bytes that are not UTF-8."""
    repaired = F.translate(F.make_valid_utf8(value), "�", "")
    return F.when(F.is_valid_utf8(value), value).otherwise(repaired)
