"""The queries of this package: ``name -> (spark, sf_dir) -> DataFrame``, whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.llm import (
    ann,
    bpe,
    chat,
    inner,
    jaccard,
    licenses,
    mixing,
    passages,
    quality,
    runs,
    secrets,
    sharding,
    trie,
)
from lexisieve.llm.common import table
from lexisieve.session import materialize

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op7_quality_rules(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text", "lang")
    return quality.quality_verdicts(docs, ["doc_id"]).select(
        F.col("kept_columns.doc_id").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        F.round("char_distance", 6).alias("char_distance"), F.round("word_distance", 6).alias("word_distance"),
    )


@query
def op3_chat_format(spark: SparkSession, d: str) -> DataFrame:
    """All conversations and one, -7, that is made of control strings."""
    turns = table(spark, d, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    done = chat.format_conversations(turns.unionByName(tricky))
    read = done.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn(
        "loss", chat.loss_text(F.col("segments"))
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
        "first_bad",
    )


@query
def op9_license_scan(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return licenses.license_scan(docs)[0]


@query
def op8_shard_minimax(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "text")
    return sharding.shard_documents(docs, 24).select(
        "doc_id", "size", "text_crc32",
        F.lit("bytes").alias("law"),
        "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def with_token_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id`` and digests of a text's ids and of what they decode to."""
    return bpe.encode_rows(docs, ["doc_id"], path, pattern).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op2_byte_bpe(spark: SparkSession, d: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return with_token_digests(table(spark, d, "documents"), path, public_tokenizers.PATTERN)


@query
def op1_jaccard_join(spark: SparkSession, d: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, d, "documents"))


@query
def op5_projection_forest(spark: SparkSession, d: str) -> DataFrame:
    """Queries: rows whose id is divisible by 20, against all rows."""
    vectors = table(spark, d, "embeddings")
    return ann.nearest(vectors, vectors.filter("vec_id % 20 = 0"), 20)


@query
def op10_mixture(spark: SparkSession, d: str) -> DataFrame:
    """Every document's cell, probability and fate."""
    rows = table(spark, d, "documents").select(
        "doc_id", "source", "lang",
        mixing.topic_of(F.col("text")).alias("topic"),
        mixing.token_count(F.col("text")).alias("n_tokens"),
    )
    return mixing.mixture(materialize(rows))


@query
def op6_secret_scan(spark: SparkSession, d: str) -> DataFrame:
    """Every candidate with the forest's verdict."""
    return secrets.scan_secrets(table(spark, d, "documents").select("doc_id", "source", "text"))


@query
def op4_compact_windows(spark: SparkSession, d: str) -> DataFrame:
    """Every passage of 50 words or more that other documents hold too."""
    return passages.repeated_passages(table(spark, d, "documents"))


@query
def op13_prefix_trie(spark: SparkSession, d: str) -> DataFrame:
    """Nodes of the trie of conversations that share their first turns with a twentieth."""
    gathered = trie.gather_turns(table(spark, d, "conversations"))
    return trie.prefix_nodes(trie.shared_starts(gathered))


@query
def op12_norm_sorted_top_k(spark: SparkSession, d: str) -> DataFrame:
    """Whole-number vectors; queries are rows whose id is divisible by 50, against all rows."""
    vectors = table(spark, d, "embeddings").select("vec_id", inner.whole(F.col("embedding")).alias("v"))
    found = inner.top_inner_products(vectors, vectors.filter("vec_id % 50 = 0"), 5, vector_col="v")
    score = F.col("score")
    long = (
        F.when(score >= 2.0**63, F.lit(2**63 - 1)).when(score < -(2.0**63), F.lit(-(2**63))).otherwise(score.cast("bigint"))
    )
    return found.withColumn("score", long)


@query
def op11_dyadic_runs(spark: SparkSession, d: str) -> DataFrame:
    """Periodic runs of every document, a tenth of which is made periodic."""
    docs = table(spark, d, "documents")
    return runs.run_digests(runs.word_runs(docs, rewrite=runs.made_periodic, keep_text=False))
