"""TF-IDF, surface scaling and feature union in long form.

Rows are ``(doc, branch, term, ...)``: the vocabulary is a table, never a driver
list, so it may be as large as the corpus makes it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from lexisieve.functions.measures import SURFACE_FEATURES, surface_features
from lexisieve.functions.tokens import char_ngrams, with_term_counts, word_ngrams, word_tokens
from lexisieve.operators.blocks import CHAR, WORD, BlockTerms, block_terms, counted_terms, sum_blocks, summed_lists, term_occurrences, weigh_blocks
from lexisieve.operators.skew import join_listed
from lexisieve.session import materialize

SURFACE = "surface"
# Buckets a branch has in the first pass over terms, and buckets a shuffled page holds.
BUCKET_BITS, PAGE = 24, 1 << 14


@dataclass(frozen=True)
class StageConfig:
    """Features and regularisation of one stage."""

    task: str
    word: tuple[int, int]
    char: tuple[int, int]
    char_min_df: int
    alpha: float
    surface: float
    negation: bool
    word_min_df: int = 2
    word_max_df: float = 0.95

    @property
    def min_df(self) -> dict[str, int]:
        return {WORD: self.word_min_df, CHAR: self.char_min_df}


# --- fixed values -----------------------------------------------------------

STAGE1 = StageConfig(
    task="label 0 vs review", word=(1, 2), char=(3, 5), char_min_df=3,
    alpha=2e-5, surface=0.5, negation=False,
)
STAGE2 = StageConfig(
    task="label 1 vs label 2", word=(1, 3), char=(3, 6), char_min_df=2,
    alpha=5e-5, surface=1.0, negation=True,
)


def _counted(df: DataFrame, branch: str, low: int, high: int) -> DataFrame:
    if branch == WORD:
        grams = word_ngrams(F.col("_tokens"), low, high)
        return with_term_counts(
            df.withColumn("_tokens", word_tokens(F.col("_text"))), grams, branch
        ).drop("_tokens")
    return with_term_counts(df, char_ngrams(F.col("_text"), low, high), branch)


def _tagged(branch: str) -> Column:
    return F.transform(
        F.col(branch),
        lambda t: F.struct(
            F.lit(branch).alias("branch"), t["term"].alias("term"), t["tf"].alias("tf")
        ),
    )


def document_terms(
    docs: DataFrame,
    ranges: dict[str, tuple[int, int]],
    text_col: str = "clean_text",
    doc_col: str = "row_idx",
) -> DataFrame:
    """``(doc, branch, term, tf)`` with each term of a document once.

    ``ranges`` maps a branch to its n-gram sizes. All branches come out of one
    pass over the text and are counted inside their row.
    """
    df = docs.select(doc_col, F.col(text_col).alias("_text"))
    for branch, (low, high) in ranges.items():
        df = _counted(df, branch, low, high)
    tagged = [_tagged(branch) for branch in ranges]
    return df.select(doc_col, F.inline(F.concat(*tagged)))


def without_rare(terms: DataFrame, min_df: dict[str, int], bits: int = BUCKET_BITS) -> DataFrame:
    """``(branch, term[, df])`` rows without most of the terms that occur in fewer than ``min_df`` documents.

    ``df`` is the number of documents a row stands for, one if there is no such column.

    A first pass counts hash buckets of terms instead of terms: a table of ``2**bits`` small
    numbers for each branch and task, shuffled in pages. A bucket whose total stays below
    ``min_df`` holds no term that reaches it, so its rows go before anything is shuffled by
    term. Rare terms that share a bucket with others stay, so counts of all terms that reach
    ``min_df`` are exact. What is broadcast is one bit a bucket, whatever the corpus.
    """
    branches = sorted(min_df)
    first = F.lit(None).cast("int")
    for i, branch in enumerate(branches):
        first = F.when(F.col("branch") == branch, i << bits).otherwise(first)
    bucket = first + (F.xxhash64("term").bitwiseAND(F.lit((1 << bits) - 1))).cast("int")
    least = [min_df[branch] for branch in branches]
    page_size = min(PAGE, 1 << bits)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(branches) << bits, np.uint8)
        for batch in batches:
            at, rows = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_inverse=True)
            n = np.bincount(rows, batch.column(1).to_numpy(zero_copy_only=False))
            seen[at] = np.minimum(seen[at] + n, 255)
        pages = seen.reshape(-1, page_size)
        for page in np.flatnonzero(pages.any(axis=1)):
            yield pa.record_batch([pa.array([page]), pa.array([pages[page].tobytes()])], names=["page", "seen"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pages arrive in order, one for each task that counted; one sum is held at a time."""

        def bit_page(page: int, total: np.ndarray) -> pa.RecordBatch:
            kept = total >= least[page * page_size >> bits]
            words = np.packbits(kept, bitorder="little").view(np.int64)
            return pa.record_batch(
                [pa.array([page]), pa.array([words.tolist()], pa.list_(pa.int64()))], names=["page", "bits"]
            )

        page, total = None, None
        for batch in batches:
            for number, seen in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if number != page:
                    if page is not None:
                        yield bit_page(page, total)
                    page, total = number, np.zeros(page_size, np.int64)
                total += np.frombuffer(seen, np.uint8)
        if page is not None:
            yield bit_page(page, total)

    n = F.col("df") if "df" in terms.columns else F.lit(1)
    hashed = terms.select(bucket.alias("bucket"), n.cast("double").alias("n")).filter(F.col("bucket").isNotNull())
    kept = materialize(
        hashed.mapInArrow(count, "page bigint, seen binary")
        .repartition("page")
        .sortWithinPartitions("page")
        .mapInArrow(merge, "page bigint, bits array<bigint>")
    )
    at = F.col("_bucket")
    word = F.get("bits", F.shiftright(at.bitwiseAND(page_size - 1), 6))
    return (
        terms.withColumn("_bucket", bucket)
        .withColumn("page", F.floor(at / page_size))
        .join(F.broadcast(kept), "page")
        .filter(F.getbit(word, at.bitwiseAND(63)) == 1)
        .drop("page", "bits", "_bucket")
    )


def document_frequency(terms: DataFrame | BlockTerms, min_df: dict[str, int] | None = None) -> DataFrame:
    """Documents per term. ``terms`` are the terms of blocks, lists of `counted_terms`, or rows
    ``(branch, term, ...)`` of which a document has one for each of its terms, or rows that carry
    a ``df`` of their own.

    With ``min_df`` (documents, for each branch) terms below it are left out, most of them
    before single rows are shuffled; rows are then read twice.
    """
    if isinstance(terms, BlockTerms) or "sizes" in terms.columns:
        return summed_lists(terms.lists if isinstance(terms, BlockTerms) else terms, min_df)
    rows = terms.select("branch", "term", *[c for c in terms.columns if c == "df"])
    if min_df is not None:
        rows = without_rare(rows, min_df)
    n = F.sum("df") if "df" in rows.columns else F.count("*")
    counts = rows.groupBy("branch", "term").agg(n.alias("df"))
    return counts if min_df is None else counts.filter(_reaches(min_df))


def _reaches(min_df: dict[str, int]) -> Column:
    kept = F.lit(True)
    for branch, low in min_df.items():
        kept = kept & ((F.col("branch") != branch) | (F.col("df") >= low))
    return kept


def vocabulary(
    counts: DataFrame, n_docs: Column, min_df: dict[str, int], max_df: dict[str, float]
) -> DataFrame:
    """``(branch, term, df, idf)`` of the terms within the frequency limits.

    ``counts`` is a `document_frequency`; ``min_df`` is in documents, ``max_df`` a share
    of them; a branch without an entry has no limit. IDF is smoothed:
    ``ln((1 + n) / (1 + df)) + 1``.
    """
    kept = _reaches(min_df)
    for branch, share in max_df.items():
        kept = kept & ((F.col("branch") != branch) | (F.col("df") <= n_docs * F.lit(share)))
    return counts.filter(kept).withColumn("idf", F.log((n_docs + 1) / (F.col("df") + 1)) + 1)


def weigh(
    terms: DataFrame | BlockTerms, vocab: DataFrame, counts: DataFrame | None = None, doc_col: str = "row_idx"
) -> DataFrame:
    """``x = (1 + ln tf) * idf`` for known terms; unknown ones drop out.

    Terms in blocks are weighed there and need no ``counts``. In rows, frequent terms hold a large part of all rows; those rows are not shuffled. What is frequent is
    counted in ``terms`` themselves (``counts``, their `document_frequency` as a written table;
    it is made here if there is none), not in the documents the vocabulary was fitted on, and
    rows of frequent terms that the vocabulary lacks are dropped before the shuffle.
    """
    if isinstance(terms, BlockTerms):
        joined = weigh_blocks(terms, vocab.drop("df"), sort=True).drop("x", "weight")
        return joined.withColumn("x", (F.log("tf") + 1) * F.col("idf"))
    counts = materialize(document_frequency(terms)) if counts is None else counts
    joined = join_listed(terms, vocab.drop("df"), ["branch", "term"], counts, "df")
    return joined.withColumn("x", (F.log("tf") + 1) * F.col("idf"))


def tfidf(
    terms: DataFrame | BlockTerms, vocab: DataFrame, counts: DataFrame | None = None, doc_col: str = "row_idx"
) -> DataFrame:
    """``(doc, branch, term, weight)`` with unit length per document and branch."""
    if isinstance(terms, BlockTerms):
        return weigh_blocks(terms, vocab.select("branch", "term", "idf")).select(
            terms.doc_col, "branch", "term", "weight"
        )
    whole = Window.partitionBy(doc_col, "branch")
    return (
        weigh(terms, vocab, counts, doc_col)
        .withColumn("weight", F.col("x") / F.sqrt(F.sum(F.col("x") * F.col("x")).over(whole)))
        .select(doc_col, "branch", "term", "weight")
    )


def stage_terms(
    docs: DataFrame, config: StageConfig, text_col: str = "clean_text", doc_col: str = "row_idx"
) -> BlockTerms:
    return block_terms(docs, {WORD: config.word, CHAR: config.char}, text_col, doc_col)


def stage_counted_terms(docs: DataFrame, config: StageConfig, text_col: str = "clean_text") -> DataFrame:
    return counted_terms(docs, {WORD: config.word, CHAR: config.char}, text_col)


def stage_vocabulary(counts: DataFrame, n_docs: Column, config: StageConfig) -> DataFrame:
    return vocabulary(counts, n_docs, min_df=config.min_df, max_df={WORD: config.word_max_df})


def measured_surface(docs: DataFrame, doc_col: str = "row_idx", base_col: str = "base_text") -> DataFrame:
    """``(doc, feature, ...)``, written: base text is measured once for the scale and what is scaled."""
    return materialize(docs.select(doc_col, *[v.alias(n) for n, v in surface_features(F.col(base_col)).items()]))


def _surface(docs: DataFrame, base_col: str) -> dict[str, Column]:
    """Surface features of ``docs``, which may be measured already."""
    if base_col in docs.columns or not set(SURFACE_FEATURES) <= set(docs.columns):
        return surface_features(F.col(base_col))
    return {name: F.col(name) for name in SURFACE_FEATURES}


def surface_scale(docs: DataFrame, base_col: str = "base_text") -> DataFrame:
    """One row with the largest absolute value of each surface feature; 1 for 0.

    ``docs`` hold base text, or are what `measured_surface` made of it.
    """
    features = _surface(docs, base_col)
    tops = {name: F.max(F.abs(value)) for name, value in features.items()}
    return docs.agg(*[F.when(top > 0, top).otherwise(1.0).alias(name) for name, top in tops.items()])


def scaled_surface(
    docs: DataFrame, scale: DataFrame, doc_col: str = "row_idx", base_col: str = "base_text"
) -> DataFrame:
    """Surface features over their scale, one column each; ``scale`` is one row.

    ``docs`` hold base text, or are what `measured_surface` made of it.
    """
    tops = scale.select(F.struct(*SURFACE_FEATURES)).scalar()
    features = _surface(docs, base_col)
    return docs.select(
        doc_col, *[(value / tops[name]).alias(name) for name, value in features.items()]
    )


def feature_union(
    docs: DataFrame,
    terms: DataFrame | BlockTerms,
    counts: DataFrame,
    vocab: DataFrame,
    scale: DataFrame,
    config: StageConfig,
    base_col: str = "base_text",
    doc_col: str = "row_idx",
) -> DataFrame:
    """All non-zero features of a stage as ``(doc, branch, term, weight)``.

    ``terms`` are the documents' `stage_terms` and ``counts`` their frequencies. Surface
    features carry the stage's weight and are left out if that is 0.
    """
    text = tfidf(terms, vocab, counts, doc_col)
    if config.surface <= 0:
        return text
    surface = (
        scaled_surface(docs, scale, doc_col, base_col)
        .unpivot(doc_col, SURFACE_FEATURES, "term", "value")
        .select(
            doc_col,
            F.lit(SURFACE).alias("branch"),
            "term",
            (F.col("value") * config.surface).alias("weight"),
        )
        .filter(F.col("weight") != 0)
    )
    return text.unionByName(surface)


def branch_scores(
    terms: DataFrame | BlockTerms,
    model: DataFrame,
    branches: tuple[str, ...] = (WORD, CHAR),
    counts: DataFrame | None = None,
    doc_col: str = "row_idx",
) -> DataFrame:
    """``(doc, score)``: the dot product with ``model(branch, term, idf, weight)`` of each branch
    over the branch's length, summed.

    Dot products and squared lengths come from one join and one aggregation, so no weight is
    shuffled back to its document to be normalised. In blocks they are sums of the block.
    """
    w = F.col("weight")
    if isinstance(terms, BlockTerms):
        sums = sum_blocks(terms, model, branches)
    else:
        sums = weigh(terms, model, counts, doc_col).groupBy(doc_col).agg(
            *[
                F.sum(F.when(F.col("branch") == branch, value)).alias(f"{name}_{branch}")
                for branch in branches
                for name, value in (("dot", F.col("x") * w), ("square", F.col("x") * F.col("x")))
            ]
        )
    score = F.lit(0.0)
    for branch in branches:
        part = F.try_divide(F.col(f"dot_{branch}"), F.sqrt(f"square_{branch}"))
        score = score + F.coalesce(part, F.lit(0.0))
    return sums.select(doc_col, score.alias("score"))


def linear_score(
    terms: DataFrame | BlockTerms,
    model: DataFrame,
    docs: DataFrame,
    intercept: float = 0.0,
    branches: tuple[str, ...] = (WORD, CHAR),
    counts: DataFrame | None = None,
    doc_col: str = "row_idx",
) -> DataFrame:
    """``sum(w * x) + intercept`` per document of ``docs`` over unit-length TF-IDF branches.

    Documents without a known term get the intercept alone.
    """
    scores = branch_scores(terms, model, branches, counts, doc_col)
    return (
        docs.select(doc_col)
        .join(scores, doc_col, "left")
        .select(doc_col, (F.coalesce("score", F.lit(0.0)) + F.lit(intercept)).alias("margin"))
    )
