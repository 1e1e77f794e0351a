"""The training-data pipeline: five stages from raw documents to packed sequences.

Each stage reads what the one before it wrote. The first four keep the columns of
``documents``; the last returns packed pieces. Null ids, null and empty texts,
repeated rows, empty tables and extra columns are handled as the operators say.
Stages that run Python limit the session's batches to a few megabytes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadspark.llm import packing, pii, quality, repeats, simhash
from roadspark.runtime import small_batches, written


def _counted(docs: DataFrame) -> DataFrame:
    """``docs`` with ``n_chars`` as the edited text has it."""
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    small_batches(spark)
    network = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.keep_good(docs, network)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose five-word shingles are 0.8 alike or more.

    Candidates are pairs within four bits of SimHash, found by blocks, and, as SimHash
    misses many such pairs, those that share a band of minima. Every link is verified
    on the whole sets of shingles.
    """
    small_batches(spark)
    return simhash.one_of_each(docs, words=5, similarity=0.8)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that repeat."""
    small_batches(spark)
    return _counted(repeats.without_repeats(docs))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with personal data replaced by its kind."""
    return _counted(pii.redact(docs, pii.fit(docs)))


def packing_by_powers_of_two(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining texts' tokens."""
    import public_tokenizers

    small_batches(spark)
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("simhash_near_dedup", simhash_near_dedup),
    ("suffix_array_dedup", suffix_array_dedup),
    ("personal_data", personal_data),
    ("packing", packing_by_powers_of_two),
]

# Fitted models, fingerprints and tokens are beyond SQL; tests compare the stages with plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
