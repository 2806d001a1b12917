"""The corpus pipeline: from raw documents to token ids.

Quality rules drop documents, the Jaccard join leaves one of each group of near-copies,
secrets are cut out of texts, documents are sampled to target weights, and what is left
is encoded. All stages but the last return the columns of their input.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.llm import bpe, jaccard, mixing, quality, secrets
from lexisieve.session import work_dir

#: Share of the tokens that the mixture is to keep.
MIXTURE = mixing.Mixture(budget=0.7)
RANKS = "byte_bpe_multi_50k.tiktoken"


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go.

    Null, empty and short texts go; rows are judged one by one, repeated ones alike; texts of
    any length are judged whole; an empty table stays empty; other columns stay as they are.
    """
    return quality.drop_low_quality(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of documents that links connect, the one with the least id stays.

    Texts without words link with nothing and stay; rows of one id stay or go together; rows
    without an id stay; an empty table stays empty; other columns stay as they are.
    """
    return jaccard.keep_one_of_each(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; no document goes. ``n_chars`` follows the text.

    Null texts stay null and keep their ``n_chars``; rows without an id are not redacted; without
    labelled findings of both kinds every candidate is taken for a secret; an empty table
    stays empty; other columns stay as they are.
    """
    found = secrets.scan_secrets(docs)
    return secrets.redact(docs, found).withColumn(
        "n_chars", F.coalesce(F.length("text").cast("bigint"), F.col("n_chars"))
    )


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are sampled by probabilities raked to source, language and topic.

    Rows of one id share their fate; nulls are values of their own; texts without words are
    kept with their cell's probability; an empty table stays empty; columns stay as they are.
    """
    return mixing.sample_mixture(docs, MIXTURE)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and whether they decode to it.

    Null text is encoded as empty; each row is encoded, repeated ones too; an empty table
    gives an empty one; of the other columns id, language and source stay.
    """
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode_rows(docs, ["doc_id", "lang", "source", "text"], path, pattern)
    return encoded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        (F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")).alias("intact"),
        "ids",
    )


STAGES = [
    ("quality_rules", quality_rules),
    ("near_copies", near_copies),
    ("secret_scans", secret_scans),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

# Fitted models, raking and byte pairs have no SQL form; tests hold the stages against
# brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{work_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
