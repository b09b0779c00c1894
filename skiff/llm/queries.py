"""The numbered queries over whole tables: thin wrappers that derive the contract columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skiff.llm import align, ann, bpe, centroids, decontam, lm, neardup, passages, piece_bpe, quality, secrets, substrings, toxicity
from skiff.llm.common import documents, prepare

def vocabulary(name: str) -> str:
    """Place of a public vocabulary file, as its package tells it."""
    import public_tokenizers

    return public_tokenizers.path(name)


def tokenizer_content(name: str = "byte_bpe_50k.json") -> str:
    return bpe.load(vocabulary(name))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.search(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 100 == 0)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.score_frame(docs, toxicity.fit(docs, labels(spark, sf_dir)))


def op3_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(documents(spark, sf_dir))


def op4_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return passages.passages(documents(spark, sf_dir))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(documents(spark, sf_dir))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return quality.score_frame(docs, quality.fit(docs, labels(spark, sf_dir)))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated(documents(spark, sf_dir))


def op8_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(documents(spark, sf_dir))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_decode(documents(spark, sf_dir), tokenizer_content())


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings of 64 components in 40 clusters after 5 rounds."""
    return centroids.cluster(prepare(spark).read.parquet(f"{sf_dir}/embeddings.parquet"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Piece ids and decoded text of every document, its words checked against the library."""
    return piece_bpe.encode_decode(documents(spark, sf_dir), piece_bpe.load(vocabulary("piece_bpe_32k.model")), check="words")


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Byte-level BPE tokens of every document aligned with its pieces."""
    return align.align(documents(spark, sf_dir), tokenizer_content(), piece_bpe.load(vocabulary("piece_bpe_32k.model")))


QUERIES = {
    "op1_ann": op1_ann,
    "op2_toxicity": op2_toxicity,
    "op3_neardup": op3_neardup,
    "op4_passages": op4_passages,
    "op5_secrets": op5_secrets,
    "op6_quality": op6_quality,
    "op7_substrings": op7_substrings,
    "op8_lm": op8_lm,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_centroids": op11_centroids,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_alignment": op13_alignment,
}
ORACLES: dict[str, str] = {"op11_centroids": centroids.cluster_sql()}
