"""Tokens, n-grams and per-document term counts, all inside one row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.functions.normalize import collapse_space
from lexisieve.functions.patterns import WORD


def word_tokens(text: Column) -> Column:
    """Lower-case words of two or more characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"[{WORD}]{{2,}}"), F.lit(0))


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    """All n-grams of ``low..high`` words, joined by a space."""
    grams, by_size = tokens, []
    for size in range(1, high + 1):
        if size > 1:
            following = F.slice(tokens, size, F.size(tokens))
            grams = F.array_compact(
                F.zip_with(grams, following, lambda left, right: F.concat(left, F.lit(" "), right))
            )
        if size >= low:
            by_size.append(grams)
    return F.concat(*by_size)


def char_words(text: Column) -> Column:
    """The words that character n-grams are taken of, with one space between."""
    return collapse_space(F.lower(text))


def char_ngrams(text: Column, low: int, high: int) -> Column:
    """Substrings of ``low..high`` (at least 3) characters of each word with one
    space on each side; a word shorter than a size has no gram of that size.

    With one space between words, these are the substrings without an inner
    space, which a look-ahead collects in one linear scan per size.
    """
    padded = F.concat(F.lit(" "), char_words(text), F.lit(" "))
    by_size = [
        F.regexp_extract_all(
            padded,
            # never start between the two halves of a character beyond the BMP
            F.lit(rf"(?s)(?![\x{{dc00}}-\x{{dfff}}])(?=(.[^ ]{{{size - 2}}}.))"),
            F.lit(1),
        )
        for size in range(low, high + 1)
    ]
    return F.concat(*by_size)


def with_term_counts(df: DataFrame, terms: Column, out: str = "term_counts") -> DataFrame:
    """Array of ``(term, tf)`` per row: sort the terms and measure the runs.

    A document is counted where it is read, so no ``(document, term)`` pair is
    shuffled to be counted.
    """
    return (
        df.withColumn("_sorted", F.sort_array(terms))
        .withColumn(
            "_starts",
            F.filter(
                F.sequence(F.lit(0), F.greatest(F.size("_sorted") - 1, F.lit(0))),
                lambda i: (F.size("_sorted") > 0)
                & ((i == 0) | (F.get("_sorted", i) != F.get("_sorted", i - 1))),
            ),
        )
        .withColumn(
            out,
            F.transform(
                F.col("_starts"),
                lambda start, k: F.struct(
                    F.get("_sorted", start).alias("term"),
                    (F.coalesce(F.get("_starts", k + 1), F.size("_sorted")) - start).alias("tf"),
                ),
            ),
        )
        .drop("_sorted", "_starts")
    )
