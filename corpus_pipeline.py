"""From raw documents to token ids: quality, near-duplicates, repeated passages, mix, encoding.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's docs. All but the last return the columns of documents. ``n_chars`` is kept
true where a stage changes a text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridmill.llm import bpe, mixing, quality, simhash, substrings
from gridmill.llm.queries import MULTI_RANKS, remainder, table
from gridmill.llm.steps import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are predicted to be of quality 1. Held-out labels are not learned from."""
    labels = table(spark, sf_dir, "labels").where(remainder(5) != 0).select("doc_id", F.col("quality").alias("label"))
    model = quality.fit(docs, labels)
    packed = docs.select("text", F.struct("*").alias("doc"))
    return quality.score(packed, model).where("predicted = 1").select("doc.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component, that of the smallest id."""
    return simhash.keep_one(docs)


def passage_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 20 words or more that start earlier too."""
    return _counted(substrings.remove_repeats(docs), docs)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The curriculum: documents as often as the mix takes them (0 to 2 times), in training order.

    Documents are taken whole, so texts stay as they are. A document that is taken twice is two rows.
    """
    return _counted(mixing.mix(docs, whole=True), docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, and the ids as little-endian unsigned 32-bit integers."""
    return bpe.encode(docs.select("doc_id", "source", "text"), MULTI_RANKS, keep=("ids",)).withColumn(
        "n_tokens", F.expr("CAST(length(ids) / 4 AS BIGINT)"))


def _counted(new: DataFrame, old: DataFrame) -> DataFrame:
    if "n_chars" not in old.columns:
        return new
    return new.withColumn("n_chars", F.length("text").cast(old.schema["n_chars"].dataType))


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

# Votes among latent vectors and SimHash linking cannot be said in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(spark, lambda: stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
