"""Record and vocabulary files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.config import MISSING


def with_missing_text(records: DataFrame, text: str = MISSING) -> DataFrame:
    """Text columns with the given text in place of NULL."""
    out = []
    for field in records.schema:
        column = F.col(field.name)
        if isinstance(field.dataType, T.StringType):
            column = F.coalesce(column, F.lit(text))
        elif field.dataType == T.ArrayType(T.StringType()):
            column = F.coalesce(column, F.array(F.lit(text)))
        out.append(column.alias(field.name))
    return records.select(*out)


def write_json(records: DataFrame, root: str, model: str, missing: str | None = None, mode: str = "append") -> None:
    """One JSON document per record under a folder of the model's name."""
    shown = records if missing is None else with_missing_text(records, missing)
    shown.write.mode(mode).option("ignoreNullFields", False).json(f"{root}/{model}")


def write_csv(
    records: DataFrame, path: str, fields: Sequence[str], missing: str | None = None, mode: str = "append"
) -> None:
    """The chosen fields in their order, without header; nothing if none are chosen."""
    if not fields:
        return
    shown = (records if missing is None else with_missing_text(records, missing)).select(*fields)
    flat = [
        F.to_json(f.name).alias(f.name) if isinstance(f.dataType, T.ArrayType) else F.col(f.name)
        for f in shown.schema
    ]
    # The CSV writer trims values unless told not to.
    shown.select(*flat).write.mode(mode).options(
        escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)


def write_vocabulary(values: DataFrame, path: str) -> None:
    """Distinct values, one JSON object per line: a single array would have to pass through one task."""
    values.distinct().write.mode("overwrite").json(path)
