"""Small helpers of the operators in this package."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACES = r"[\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(F.col(quoted(column)).cast("string"), F.lit(""))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def without(frame: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """The frame without columns that an operator is about to add; names differ from each other in more than case."""
    taken = {n.lower() for n in names} - {k.lower() for k in keep}
    return frame.select(*[quoted(c) for c in frame.columns if c.lower() not in taken])


def with_fields(frame: DataFrame, ddl: str) -> T.StructType:
    """The schema of the frame followed by the fields of ``ddl``."""
    return T.StructType([*frame.schema.fields, *T.StructType.fromDDL(ddl).fields])


def partitions_of(frame: DataFrame) -> int:
    return int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def numbered(frame: DataFrame) -> DataFrame:
    """The frame with columns c0, c1, ...: working columns of an operator cannot clash with them."""
    return frame.toDF(*[f"c{i}" for i in range(len(frame.columns))])


def number_of(frame: DataFrame, name: str) -> str:
    """The name that ``numbered`` gives a column."""
    return f"c{[c.lower() for c in frame.columns].index(name.lower())}"


def named_back(names: Sequence[str]) -> list[Column]:
    return [F.col(f"c{i}").alias(name) for i, name in enumerate(names)]
