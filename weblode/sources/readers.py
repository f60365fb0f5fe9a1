"""Stored pages, saved records, gazetteers and index exports as DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weblode.functions.text import valid_text
from weblode.sources.json_arrays import read_json_array

# The encoding pages are read in, and the shapes of gazetteer and export files.
PAGE_ENCODING = "ISO-8859-1"
CITIES = "country string, name string, subcountry string, geonameid bigint"
UNIVERSITIES = "name string"
HITS = ("hits", "hits")


def decoded(content: Column) -> Column:
    """Raw page bytes as text."""
    return F.decode(content, PAGE_ENCODING)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    """Stored pages with ``url`` and ``html``; binary content is decoded.

    Parsing is the heaviest step: choose ``spark.sql.files.maxPartitionBytes`` for a task of a few minutes.
    """
    pages = spark.read.parquet(path)
    if isinstance(pages.schema["html"].dataType, T.BinaryType):
        pages = pages.withColumn("html", decoded(F.col("html")))
    return pages


def read_json_directory(
    spark: SparkSession, root: str, schema: str | T.StructType, per_file: bool = True, mode: str = "FAILFAST", with_place: bool = False
) -> DataFrame:
    """Every JSON object under a folder at any depth, whatever its file is called, with the ``file_path`` it came from.

    One object per file by default; one per line for what ``write_json`` saved. Compressed files are read by their ending. Undecodable bytes are
    ignored; a file that is not JSON fails the job unless ``mode`` is PERMISSIVE. ``with_place`` adds ``file_place``,
    which orders the records of one file.
    """
    lines = (
        spark.read.option("recursiveFileLookup", True)
        .text(root, wholetext=per_file)
        .select(
            "value",
            F.col("_metadata.file_path").alias("file_path"),
            # Rows of a split come in order, and splits of a file by where they start.
            F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("row")).alias("file_place"),
        )
    )
    parsed = F.from_json(valid_text(F.col("value")), schema, {"mode": mode})
    return lines.select(parsed.alias("record"), "file_path", "file_place").select("record.*", "file_path", *(["file_place"] if with_place else []))


def read_gazetteer(
    spark: SparkSession, path: str, schema: str = CITIES, whole_file: bool = True
) -> DataFrame:
    """JSON arrays of places (or of universities, with that schema), one row per element.

    A file is one array, however large, or has an array or object per line if not ``whole_file``: that form needs no shuffle.
    """
    if whole_file:
        return read_json_array(spark, path, T.StructType.fromDDL(schema))
    return spark.read.schema(schema).json(path)


def read_index_export(spark: SparkSession, path: str, field: str, whole_file: bool = True) -> DataFrame:
    """The field of every hit of an index export; it is read from the hit itself.

    A file is one export, however large, or has one per line if not ``whole_file``.
    """
    hit = T.StructType().add(field, T.StringType())
    if whole_file:
        return read_json_array(spark, path, hit, HITS)
    schema = T.StructType().add(HITS[0], T.StructType().add(HITS[1], T.ArrayType(hit)))
    exported = spark.read.schema(schema).json(path)
    return exported.select(F.explode(".".join(HITS)).alias("hit")).select(F.col("hit").getField(field).alias(field))
