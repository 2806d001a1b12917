"""Numeric and boolean text measures.

Two families on purpose. The report measures read raw text and count words of
two or more characters and ASCII capitals; the surface features read base text
and count every word and Unicode capitals. They share no definition.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexisieve.functions.normalize import is_blank, text_or_empty
from lexisieve.functions.patterns import WORD, count_char, count_chars

# --- fixed values: names and order of the outputs, patterns -------------------

NUMERIC_MEASURES = [
    "char_count", "word_count", "exclamation_count", "question_count", "uppercase_ratio",
]
BOOLEAN_MEASURES = ["is_blank_text", "has_url", "has_html", "has_repeated_punctuation"]
SURFACE_FEATURES = [
    "log_char_count", "log_word_count", "sentence_punct_count", "exclamation_count",
    "question_count", "uppercase_ratio", "digit_ratio", "punct_ratio",
    "has_repeated_punctuation",
]
REPORT_URL, REPORT_HTML = r"(?iu)https?://|www\.", r"(?iu)<[^>]+>|&[a-z]+;"
REPORT_REPEATED, SURFACE_REPEATED = "[!?.,;:]{3,}", r"([!?.,;:])\1|!\?|\?!"


def report_measures(text: Column) -> dict[str, Column]:
    """Nine measures of raw text, by name."""
    raw = text_or_empty(text)
    letters = count_chars(raw, "A-Za-z")
    capitals = count_chars(raw, "A-Z")
    return {
        "char_count": F.length(raw).cast("double"),
        "word_count": F.regexp_count(raw, F.lit(f"[{WORD}][{WORD}']*[{WORD}]")).cast("double"),
        "exclamation_count": count_char(raw, "!").cast("double"),
        "question_count": count_char(raw, "?").cast("double"),
        "uppercase_ratio": F.coalesce(F.try_divide(capitals, letters), F.lit(0.0)),
        "is_blank_text": is_blank(text),
        "has_url": raw.rlike(REPORT_URL),
        "has_html": raw.rlike(REPORT_HTML),
        "has_repeated_punctuation": raw.rlike(REPORT_REPEATED),
    }


@lru_cache(maxsize=1)
def _unusual_digits() -> str:
    """Class of the digits that Unicode files under other numbers."""
    chars = (chr(point) for point in range(sys.maxunicode + 1))
    return "".join(
        rf"\x{{{ord(c):x}}}" for c in chars if c.isdigit() and unicodedata.category(c) == "No"
    )


def _count_digits(text: Column) -> Column:
    unusual = F.when(text.rlike(r"\p{No}"), count_chars(text, _unusual_digits())).otherwise(0)
    return count_chars(text, r"\p{Nd}") + unusual


def _share(part: Column, whole: Column) -> Column:
    return part / F.greatest(whole, F.lit(1))


def surface_features(base_text: Column) -> dict[str, Column]:
    """Nine features of base text, by name."""
    chars = F.length(base_text)
    measures = [
        F.log1p(chars),
        F.log1p(F.regexp_count(base_text, F.lit(f"[{WORD}]+"))),
        sum((count_char(base_text, mark) for mark in ".!?"), F.lit(0)),
        count_char(base_text, "!"),
        count_char(base_text, "?"),
        _share(count_chars(base_text, r"\p{Lu}"), count_chars(base_text, r"\p{L}")),
        _share(_count_digits(base_text), chars),
        _share(count_chars(base_text, r"\p{P}"), chars),
        base_text.rlike(SURFACE_REPEATED),
    ]
    return {name: m.cast("double") for name, m in zip(SURFACE_FEATURES, measures)}
