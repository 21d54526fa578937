"""The corpus pipeline: quality rules, near-dedup, substring dedup, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on what the one before it kept. ``run`` writes each stage's rows as Parquet in
the shared folder and reads them again, so a lost executor costs a part of one stage."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F

from changeflow.llm import bpe, common, minhash, mixing, quality, substrings

#: A document without words left is of no use to the mix.
VOCABULARY = os.environ.get("CHANGEFLOW_VOCABULARY", "")

#: SQL cannot express BPE, so the rows are tested against a brute-force version.
ORACLE_SQL = None


def vocabulary_path() -> str:
    """The vocabulary that is named by the environment, or the public one of the ``public_tokenizers`` package."""
    if VOCABULARY:
        return VOCABULARY
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    return quality.filter_quality(docs)


def minhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of 5-word shingles are similar by 0.8."""
    return minhash.drop_near_duplicates(docs, k=5, percent=80)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of 50 words that also stand elsewhere; the rest of a text stays as it is laid out, and ``n_chars``
    follows it."""
    kept = substrings.dedup_substrings(docs, window=50, layout=True).select(*docs.columns)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else kept


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mix(docs)


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their tokens, and whether these decode to the text."""
    out = bpe.encode(docs, vocabulary_path(), decoded_name="decoded")
    return out.withColumn("round_trip", F.col("decoded") == F.coalesce("text", F.lit(""))).drop("decoded")


STAGES = [
    ("quality rules", quality_rules),
    ("minhash near-dedup", minhash_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix_sources),
    ("bpe tokens", bpe_tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage for the table ``documents``."""
    folder = common.workdir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = common.saved(stage(spark, docs, sf_dir), folder, f"stage-{k}")
    return docs
