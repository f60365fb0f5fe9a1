"""Small helpers shared by the column expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once and use it many times inside ``body``.

    A plain reference inside a lambda is re-evaluated for every array element;
    a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def java_pattern(pattern: str) -> str:
    """A Python regular expression as the JVM spells it, with Unicode classes."""
    return "(?U)" + pattern.replace("(?P<", "(?<").replace("(?P=", "\\k<")


def any_rlike(text: Column, patterns: Iterable[str]) -> Column:
    """True if any pattern is found anywhere in ``text``."""
    return reduce(lambda a, b: a | b, (text.rlike(java_pattern(p)) for p in patterns), F.lit(False))


def any_contains(text: Column, needles: Iterable[str]) -> Column:
    """True if any non-empty needle is a substring of ``text``."""
    return reduce(lambda a, b: a | b, (F.contains(text, F.lit(n)) for n in needles if n), F.lit(False))


def first_of(choices: Iterable[tuple[Column, object]], default: str | None = None) -> Column:
    """The value of the first condition that holds: one flat expression, however many there are."""
    out = None
    for condition, value in choices:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    missing = F.lit(default).cast("string")
    return missing if out is None else out.otherwise(missing)


# Dictionaries with more keys are walked as one tree (``functions.dictionary``): of texts, and of patterns, which are dearer to try.
MOST_BRANCHES = 200
MOST_PATTERNS = 20


def blank_to_null(text: Column) -> Column:
    return let(text, lambda t: F.when(t != "", t))
