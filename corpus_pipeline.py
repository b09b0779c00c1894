"""Training-corpus pipeline: five stages over documents, each reading what the last one kept.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame that is written as Parquet and reread as the next stage's docs. All stages but the
last return the columns of documents. Rows without an id pass the stages that compare
documents; null texts read as empty. An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from skiff.llm import bpe, decontam, neardup, quality, secrets
from skiff.llm.common import prepare
from skiff.llm.queries import documents, labels, tokenizer_content
from skiff.session import new_run_dir


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep documents that the quality classifier accepts; it learns from the labelled rows of
    the documents table (a bounded sample)."""
    return quality.keep_good(docs, quality.fit(documents(spark, sf_dir), labels(spark, sf_dir)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document, the smallest id, of each near-duplicate group."""
    return neardup.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark passage."""
    return decontam.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace secrets in the texts; every document stays."""
    prepare(spark)
    return secrets.redact(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digests of the ids and of the decoded text."""
    prepare(spark)
    return bpe.encode_decode(docs, tokenizer_content(), with_ids=True)


STAGES = [
    ("quality", quality_filter),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", redact_secrets),
    ("encode", encode),
]
#: The classifier, signatures and merges have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table, each written to the shared folder and read again."""
    prepare(spark)
    folder = new_run_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}_{name}")
        docs = spark.read.parquet(f"{folder}/{k}_{name}")
    return docs
