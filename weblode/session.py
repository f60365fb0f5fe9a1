"""Where jobs keep the tables they cut their lineage with."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

_named_roots: list[str] = []


def name_work_root(path: str) -> None:
    """The folder to use where the session sets no ``spark.checkpoint.dir``; all executors must share it."""
    _named_roots[:] = [path]


def work_root(spark: SparkSession) -> str:
    """The shared folder: what the cluster names, else what the caller named."""
    root = spark.conf.get("spark.checkpoint.dir", None) or next(iter(_named_roots), None)
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return root.rstrip("/")


def work_path(spark: SparkSession, purpose: str) -> str:
    """A fresh folder name under the shared one."""
    return f"{work_root(spark)}/{purpose}-{uuid.uuid4().hex}"


def stored(frame: DataFrame, path: str) -> DataFrame:
    """Write the frame as a table and read it back: the lineage ends here and survives lost executors."""
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
