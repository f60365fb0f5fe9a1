"""Record identity: incomplete, repeated and already indexed records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.config import MISSING
from weblode.operators.joins import looked_up


def scalar(frame: DataFrame, name: str) -> Column:
    """The column, or element 0 where values are kept as one-element arrays."""
    if isinstance(frame.schema[name].dataType, T.ArrayType):
        return F.get(F.col(name), F.lit(0))
    return F.col(name)


def complete(records: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Records whose identity features are all present."""
    out = records
    for name in identity:
        value = scalar(records, name)
        out = out.where(value.isNotNull() & (value.cast("string") != MISSING))
    return out


def arrival_order(records: DataFrame, arrival: Sequence[str]) -> Column:
    """Order of arrival; of rows that arrive together, a hash of the whole row decides."""
    whole = [F.to_json(f.name) if isinstance(f.dataType, T.MapType) else F.col(f.name) for f in records.schema]
    return F.struct(*arrival, F.xxhash64(*whole).alias("_row"))


def first_of_each(records: DataFrame, identity: Sequence[str], arrival: Sequence[str]) -> DataFrame:
    """One record per identity: the first to arrive.

    A minimum, not a window: each task reduces its own copies before anything is shuffled, so an
    identity shared by a third of all rows costs no more than any other.
    """
    rest = [c for c in records.columns if c not in identity]
    if not rest:
        return records.distinct()
    kept = records.groupBy(*identity).agg(F.min_by(F.struct(*rest), arrival_order(records, arrival)).alias("kept"))
    return kept.select(*[F.col(f"kept.{c}").alias(c) if c in rest else F.col(c) for c in records.columns])


def last_of_each(records: DataFrame, key: str, arrival: Sequence[str]) -> DataFrame:
    """One record per key: the last to arrive."""
    rest = [c for c in records.columns if c != key]
    if not rest:
        return records.distinct()
    kept = records.groupBy(key).agg(F.max_by(F.struct(*rest), arrival_order(records, arrival)).alias("kept"))
    return kept.select(*[F.col(f"kept.{c}").alias(c) if c != key else F.col(c) for c in records.columns])


def not_indexed(records: DataFrame, index: DataFrame, identity: Sequence[str]) -> DataFrame:
    """Records that no indexed document equals on all identity features."""
    names = [f"known_{c}" for c in identity]
    known = index.select(*[scalar(index, c).alias(n) for c, n in zip(identity, names)])
    # An anti-join needs no distinct right side, and adaptive execution splits a left side with a hot identity.
    same = [scalar(records, c) == F.col(n) for c, n in zip(identity, names)]
    return records.join(known, same, "left_anti")


def presence(records: DataFrame, index: DataFrame, on: Sequence[str], flag: str = "present") -> DataFrame:
    """Add whether the index holds at least one document with the record's values."""
    known = index.select(*on).distinct().withColumn(flag, F.lit(True))
    return looked_up(records, known, on, flag).withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def any_document(index: DataFrame, **values) -> bool:
    """Whether any document has these values; stops at the first."""
    hit = index
    for name, value in values.items():
        hit = hit.where(F.col(name) == F.lit(value))
    return not hit.select(F.lit(1)).isEmpty()
