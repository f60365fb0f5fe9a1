"""Vocabularies: distinct gazetteer names, and phrases mined from an index export."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weblode.functions import text as X

# The gazetteer attribute each kind of name is read from.
KINDS = {
    "country": ("cities", "country"),
    "city": ("cities", "name"),
    "geonameid": ("cities", "geonameid"),
    "province": ("cities", "subcountry"),
    "university": ("universities", "name"),
}


def gazetteer_names(gazetteer: DataFrame, column: str) -> DataFrame:
    """Distinct values in order."""
    return gazetteer.select(F.col(column).alias("value")).distinct().orderBy("value")


def names_of_kind(kind: str, cities: DataFrame, universities: DataFrame) -> DataFrame:
    """Distinct names of a kind (country, city, geonameid, province, university) in order."""
    gazetteer, column = KINDS[kind]
    return gazetteer_names({"cities": cities, "universities": universities}[gazetteer], column)


def phrases(value: Column, delimiters: Sequence[str]) -> Column:
    """Candidate phrases of one value: camel-case pieces, split by each delimiter, letters only, repaired."""
    pieces = F.flatten(F.transform(X.camel_pieces(value), lambda p: X.delimiter_pieces(p, delimiters)))
    cleaned = F.array_distinct(F.transform(pieces, X.letters_only))
    return F.filter(F.array_distinct(F.transform(cleaned, X.repair_ending)), X.is_candidate)


def vocabulary(
    values: DataFrame, column: str, delimiters: Sequence[str], forbidden: Sequence[str] | DataFrame = ()
) -> DataFrame:
    """Distinct phrases of a column. Narrow up to one de-duplicating shuffle."""
    found = values.select(F.explode(phrases(F.col(column).cast("string"), delimiters)).alias("value"))
    if isinstance(forbidden, DataFrame):
        return found.distinct().join(forbidden.select(F.col(forbidden.columns[0]).alias("value")), "value", "left_anti")
    if forbidden:
        found = found.where(~F.col("value").isin(*forbidden))
    return found.distinct()
