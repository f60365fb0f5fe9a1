"""The default country table: the JVM's own English names of the ISO 3166 codes, as they are.

They are everyday names ("Russia", "South Korea"), not the formal ones of the standard ("Russian Federation",
"Korea, Republic of"), and may change with the JVM's locale data. Where other spellings must be found, give a
table of your own: ``read_countries`` reads one.
"""

from __future__ import annotations

import csv
import io

from pyspark.sql import SparkSession


def iso_countries(spark: SparkSession) -> list[tuple[str, str]]:
    """(name, alpha-2 code) in order of name."""
    locale = spark._jvm.java.util.Locale
    return sorted((locale("", code).getDisplayCountry(locale.ENGLISH), code) for code in locale.getISOCountries())


def read_countries(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(name, code) pairs of a CSV file without header, in the file's order of precedence.

    The table becomes part of the plan, so it has to be a list of countries, not of places.
    """
    lines = spark.read.text(path, wholetext=True).first()
    return [(row[0], row[1]) for row in csv.reader(io.StringIO(lines["value"] if lines else "")) if len(row) >= 2]
