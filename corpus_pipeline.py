"""A corpus from raw documents to token counts, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from weblode.llm import bpe, content_sort, decontaminate, quality, simhash
from weblode.llm.queries import tokenizer_path
from weblode.session import stored, work_path


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for bad ones go."""
    network = quality.trained(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.scored(docs, network).where("predicted = 1").select(*docs.columns)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays."""
    return content_sort.exact_duplicates(docs).where("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints at four or fewer differing bits, over runs of four words, stays."""
    return simhash.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a benchmark passage go."""
    marked = decontaminate.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.where("n_hit = 0").select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The number of tokens of each document, and digests of its token numbers and decoded text."""
    return bpe.digests(bpe.encoded(docs.select("doc_id", "text"), tokenizer_path()))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

# The classifier, the similarities and the token numbers have no SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; each stage's result is a Parquet table in the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), work_path(spark, f"stage-{name}"))
    return docs
