"""Saved record files back into an index, as they are or mapped to a decision model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblode.config import DecisionModel
from weblode.operators.index import upsert
from weblode.operators.model import to_model
from weblode.operators.records import last_of_each, scalar
from weblode.sources.readers import read_json_directory


def latest_records(saved: DataFrame, key_feature: str) -> DataFrame:
    """One record per key feature (element 0 of an array) under ``id``; the last file wins, and in it the last record."""
    keyed = saved.withColumn("id", scalar(saved, key_feature))
    return last_of_each(keyed, "id", ["file_path", "file_place"]).drop("file_path", "file_place")


def reingest(
    spark: SparkSession, root: str, schema, key_feature: str, index_path: str, per_file: bool = True, buckets: int = 64
) -> None:
    """Read every saved record under a folder and put it into the index by its key feature."""
    saved = read_json_directory(spark, root, schema, per_file, with_place=True)
    upsert(index_path, latest_records(saved, key_feature), "id", buckets=buckets)


def load_model_index(
    spark: SparkSession,
    root: str,
    schema,
    model: DecisionModel,
    index_path: str,
    per_file: bool = True,
    buckets: int = 64,
) -> None:
    """Map every saved record to the model and put it into the model's index by URL."""
    saved = read_json_directory(spark, root, schema, per_file, with_place=True)
    latest = latest_records(saved, "url")
    upsert(index_path, to_model(latest, model, "id"), "id", buckets=buckets)
