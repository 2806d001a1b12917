"""Text normalisation: duplicate keys and the model-text cleaning chain.

Single steps are ``Column -> Column``. The chains (`with_base_text`,
`with_clean_text`) are ``DataFrame -> DataFrame``: each step is its own
projection, so an expression that a later step reads more than once is
evaluated once (Catalyst merges only the projections where that is free).

Only Unicode NFKC has no Spark expression. It runs in Arrow batches, and a native test
in front sends nothing but nulls for the rows that cannot change.
"""

from __future__ import annotations

import html
import html.entities
import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexisieve.functions.patterns import (
    EDGE,
    ENDS_WORD,
    SPACE,
    STARTS_WORD,
    WORD,
    has_beyond_ascii,
    lookup,
    replace_computed,
)

# --- fixed values -----------------------------------------------------------

SINGLE_QUOTES = "‘’‚‛`"
DOUBLE_QUOTES = "“”„‟"
NO_BREAK_SPACES = r"\x{a0}\x{202f}\x{2007}"
DASHES = r"\x{2010}-\x{2015}\x{2212}"
ELLIPSIS = r"\x{2026}"
INVISIBLE = r"\x{200b}\x{200c}\x{200d}\x{feff}"
CONTROL = r"\x00-\x08\x0b\x0c\x0e-\x1f\x7f"

# Contraction -> expansion.
CONTRACTIONS = {
    "ain't": "is not",
    "aren't": "are not",
    "can't": "can not",
    "couldn't": "could not",
    "didn't": "did not",
    "doesn't": "does not",
    "don't": "do not",
    "hadn't": "had not",
    "hasn't": "has not",
    "haven't": "have not",
    "he'd": "he would",
    "he'll": "he will",
    "he's": "he is",
    "here's": "here is",
    "how's": "how is",
    "i'd": "i would",
    "i'll": "i will",
    "i'm": "i am",
    "i've": "i have",
    "isn't": "is not",
    "it'd": "it would",
    "it'll": "it will",
    "it's": "it is",
    "let's": "let us",
    "mightn't": "might not",
    "mustn't": "must not",
    "needn't": "need not",
    "shan't": "shall not",
    "she'd": "she would",
    "she'll": "she will",
    "she's": "she is",
    "shouldn't": "should not",
    "that's": "that is",
    "there's": "there is",
    "they'd": "they would",
    "they'll": "they will",
    "they're": "they are",
    "they've": "they have",
    "wasn't": "was not",
    "we'd": "we would",
    "we'll": "we will",
    "we're": "we are",
    "we've": "we have",
    "weren't": "were not",
    "what's": "what is",
    "when's": "when is",
    "where's": "where is",
    "who's": "who is",
    "why's": "why is",
    "won't": "will not",
    "wouldn't": "would not",
    "y'all": "you all",
    "you'd": "you would",
    "you'll": "you will",
    "you're": "you are",
    "you've": "you have",
}

STAR_WORDS = {"zero": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5"}
RATING_HIGH_FROM = 0.70
RATING_LOW_TO = 0.40
HIGH_GRADES = ["a+", "a-", "b+"]
LOW_GRADES = ["f-", "d-"]

NEGATION_TRIGGERS = [
    "not", "no", "never", "cannot", "without", "hardly", "barely", "rarely", "neither", "nor",
]
NEGATION_BOUNDARIES = ".!?;:"
EMAIL = r"[A-Z0-9._%+-]++@[A-Z0-9.-]+\.[A-Z]{2,}"
MIXED_MARKS, EXCLAMATIONS, QUESTIONS = r"(?:!\?|\?!)[!?]*", r"!{2,}", r"\?{2,}"
ELONGATION = r"([A-Za-z])\1{2,}"
NEGATION_WINDOW = 4

# --- whitespace, keys -------------------------------------------------------


def text_or_empty(col: Column) -> Column:
    return F.coalesce(col.cast("string"), F.lit(""))


def _runs(char_class: str) -> str:
    """Runs of a class, except the single spaces that would replace themselves."""
    return f"[{char_class}](?:[{char_class}]+|(?<=[^ ]))"


def collapse_space(col: Column) -> Column:
    """Unicode whitespace runs become one space; none is left at the ends."""
    return F.trim(F.regexp_replace(col, _runs(SPACE), " "))


def is_blank(col: Column) -> Column:
    return ~text_or_empty(col).rlike(f"[^{SPACE}]")


def _other_than(ranges: str) -> str:
    """A character outside ``ranges``. A long class costs as much as it has ranges for each character
    tested, so frequent characters are turned away one short range at a time."""
    return rf"(?![\x{{4e00}}-\x{{9fff}}])(?![\x{{400}}-\x{{482}}])(?![\x{{ac00}}-\x{{d7a3}}])[^{ranges}]"


# Lower-case characters in these ranges are their own case fold, once sharp s is gone.
_FOLDED = (
    r"\x00-\xb4\xb6-\x{148}\x{14a}-\x{17e}\x{400}-\x{52f}\x{2010}-\x{2027}"
    r"\x{3000}-\x{9fff}\x{ac00}-\x{d7a3}"
)


@lru_cache(maxsize=1)
def _late_folds() -> tuple[dict[str, str], dict[str, str]]:
    """Folds that lower-casing leaves undone: one-to-one and one-to-many."""
    single, several = {}, {}
    for point in range(sys.maxunicode + 1):
        char = chr(point)
        folded = char.casefold()
        if folded != char and char.lower() == char:
            (single if len(folded) == 1 else several)[char] = folded
    return single, several


def lower_fold(col: Column) -> Column:
    """Lower case with sharp s spelled out: the whole fold of most text."""
    return F.replace(F.lower(col), F.lit("ß"), F.lit("ss"))


def late_fold(lowered: Column) -> Column:
    """What full case folding changes beyond `lower_fold`."""
    single, several = _late_folds()
    moved = F.translate(lowered, "".join(single), "".join(single.values()))
    expanded = replace_computed(
        moved, "[" + "".join(several) + "]", lambda hit: lookup(several)[hit]
    )
    unusual = has_beyond_ascii(lowered) & lowered.rlike(rf"(?![\x00-\xb4]){_other_than(_FOLDED)}")
    return F.when(unusual, expanded).otherwise(lowered)


def report_key(col: Column) -> Column:
    """Key of the profiling report: lower case only, so ``ß`` and ``ss`` differ."""
    return collapse_space(F.lower(text_or_empty(col)))


def key_digest(key: Column) -> Column:
    """32 bytes that stand in for a key, so long texts are not shuffled.

    Never null, so no join asks for it to be non-null, which would be pushed down
    and compute every key a second time.
    """
    return F.coalesce(F.unhex(F.sha2(key, 256)), F.lit(bytearray()))


# --- markup and Unicode -----------------------------------------------------


@F.pandas_udf(T.StringType())
def _nfkc_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda text: unicodedata.normalize("NFKC", text), na_action="ignore")


# Text made of these characters only is already in NFKC.
_NFKC_STABLE = (
    r"\x00-\x7f\xbf-\x{131}\xa1-\xa7\xa9\xab-\xae\xb0\xb1\xb6\xb7\xbb\x{134}-\x{13e}"
    r"\x{141}-\x{148}\x{14a}-\x{17e}\x{391}-\x{3a1}\x{3a3}-\x{3ce}\x{400}-\x{482}\x{48a}-\x{52f}"
    r"\x{2010}\x{2012}-\x{2016}\x{2018}-\x{2023}\x{3001}\x{3002}\x{3041}-\x{3096}\x{30a1}-\x{30fa}"
    r"\x{4e00}-\x{9fff}\x{ac00}-\x{d7a3}"
)


_REFERENCE = r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"


@lru_cache(maxsize=1)
def _entity_names() -> tuple[dict[str, dict[str, str]], list[str]]:
    """What each name stands for, by its first character, and the names that need no semicolon."""
    by_first: dict[str, dict[str, str]] = {}
    for name, text in html.entities.html5.items():
        by_first.setdefault(name[0], {})[name] = text
    bare = [name for name in html.entities.html5 if not name.endswith(";")]
    return by_first, sorted(bare, key=lambda name: (-len(name), name))


@lru_cache(maxsize=1)
def _low_references() -> dict[str, str]:
    """What numbers below 160 stand for, where that is not the character itself."""
    points = {str(point): html.unescape(f"&#{point};") for point in range(160)}
    return {point: text for point, text in points.items() if text != chr(int(point))}


def _named_reference(hit: Column) -> Column:
    """The whole name if it is known, else its longest start that needs no semicolon."""
    by_first, bare = _entity_names()
    name = F.substring(hit, 2, 34)
    names = F.create_map(*[part for first, known in by_first.items() for part in (F.lit(first), lookup(known))])
    start = F.regexp_extract(hit, f"^&({'|'.join(bare)})", 1)
    known = names[F.substring(name, 1, 1)]
    rest = F.substring(hit, F.length(start) + 2, F.length(hit))
    return F.coalesce(
        known[name], F.when(start != "", F.concat(known[start], rest)), hit
    )


def _numbered_reference(hit: Column) -> Column:
    """The character of a decimal or hexadecimal number."""
    found = F.regexp_extract(hit, "^&#[xX]?0*([0-9a-fA-F]*)", 1)
    digits = F.when(found == "", "0").otherwise(found)
    number = F.when(hit.rlike("^&#[xX]"), F.conv(digits, 16, 10).cast("bigint")).otherwise(digits.try_cast("bigint"))
    # more than eight digits are beyond the last character in both notations
    point = F.when(F.length(digits) > 8, sys.maxunicode + 1).otherwise(number)
    nothing = point.between(0xFDD0, 0xFDEF) | (F.pmod(point, F.lit(0x10000)) >= 0xFFFE)
    character = F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")
    return (
        F.when((point > sys.maxunicode) | point.between(0xD800, 0xDFFF), "\ufffd")
        .when(nothing, "")
        .otherwise(F.coalesce(lookup(_low_references())[point.cast("string")], character))
    )


def unescape_html(col: Column) -> Column:
    """One level of HTML entities, as HTML 5 reads them: a known name, else its longest known start."""
    resolved = replace_computed(
        col,
        _REFERENCE,
        lambda hit: F.when(F.startswith(hit, F.lit("&#")), _numbered_reference(hit)).otherwise(_named_reference(hit)),
    )
    return F.when(col.contains("&"), resolved).otherwise(col)


def nfkc(col: Column) -> Column:
    unstable = has_beyond_ascii(col) & col.rlike(rf"(?![\x00-\x7f])(?![\xbf-\x{{131}}]){_other_than(_NFKC_STABLE)}")
    return F.coalesce(_nfkc_batch(F.when(unstable, col)), col)


def strip_tags(col: Column) -> Column:
    no_breaks = F.regexp_replace(col, f"(?iu)<[{SPACE}]*br[{SPACE}]*/?[{SPACE}]*>", " ")
    return F.when(col.contains("<"), F.regexp_replace(no_breaks, "<[^>]+>", " ")).otherwise(col)


def fold_typography(col: Column) -> Column:
    """Curly quotes, no-break spaces, dashes and the ellipsis in ASCII."""
    plain = F.regexp_replace(col, f"[{SINGLE_QUOTES}]", "'")
    plain = F.regexp_replace(plain, f"[{DOUBLE_QUOTES}]", '"')
    plain = F.regexp_replace(plain, f"[{NO_BREAK_SPACES}]", " ")
    plain = F.regexp_replace(plain, f"[{DASHES}]", " - ")
    plain = F.regexp_replace(plain, ELLIPSIS, " ... ")
    # one test over ranges that contain all but the backtick
    special = has_beyond_ascii(col) & col.rlike(r"[\xa0\x{2007}-\x{202f}\x{2212}]")
    return F.when(col.contains("`") | special, plain).otherwise(col)


# SPACE, INVISIBLE and CONTROL in as few ranges as they fit.
_UNSEEN = r"\x00- \x7f\x85\p{Z}\x{200b}-\x{200d}\x{feff}"


def drop_unseen(col: Column) -> Column:
    """Invisible and control characters become spaces; whitespace is collapsed."""
    return F.trim(F.regexp_replace(col, _runs(_UNSEEN), " "))


# --- masking ----------------------------------------------------------------


def mask_email(col: Column) -> Column:
    masked = F.regexp_replace(col, f"(?iu){EDGE}{EMAIL}{EDGE}", " __email__ ")
    return F.when(col.contains("@"), masked).otherwise(col)


def mask_url(col: Column) -> Column:
    masked = F.regexp_replace(
        col, rf"(?iu)(?=[hw]){STARTS_WORD}(?:https?://|www\.)[^{SPACE}]+", " __url__ "
    )
    return F.when(col.contains("://") | col.rlike(r"[wW]{3}\."), masked).otherwise(col)


def expand_listed_contractions(col: Column) -> Column:
    by_length = sorted(CONTRACTIONS, key=len, reverse=True)
    pattern = f"(?i)(?=[a-z]){STARTS_WORD}(?:{'|'.join(by_length)}){ENDS_WORD}"
    expanded = replace_computed(
        col, pattern, lambda hit: F.coalesce(lookup(CONTRACTIONS)[F.lower(hit)], hit)
    )
    return F.when(col.contains("'"), expanded).otherwise(col)


def expand_other_negations(col: Column) -> Column:
    expanded = F.regexp_replace(
        col, f"(?iu)(?=[a-z]){STARTS_WORD}([A-Za-z]+)n't{ENDS_WORD}", "$1 not"
    )
    return F.when(col.contains("'"), expanded).otherwise(col)


@lru_cache(maxsize=1)
def _other_digits() -> tuple[str, str]:
    """Decimal digits of other scripts and their ASCII digits."""
    chars = [chr(p) for p in range(0x80, sys.maxunicode + 1) if unicodedata.category(chr(p)) == "Nd"]
    return "".join(chars), "".join(str(unicodedata.decimal(char)) for char in chars)


def _rating_token(score: Column, total: float) -> Column:
    ratio = F.translate(score, *_other_digits()).cast("double") / F.lit(total)
    return (
        F.when(ratio >= RATING_HIGH_FROM, F.lit(" __rating_high__ "))
        .when(ratio <= RATING_LOW_TO, F.lit(" __rating_low__ "))
        .otherwise(F.lit(" __rating_mid__ "))
    )


_GAP = f"[{SPACE}]*"
_TEN = r"(10|[0-9](?:\.\p{Nd}+)?)"
_OUT_OF_TEN = f"(?iu)(?=[0-9]){STARTS_WORD}{_TEN}{_GAP}out[{SPACE}]+of[{SPACE}]+10{ENDS_WORD}"
_SLASH_TEN = f"(?iu)(?=[0-9]){STARTS_WORD}{_TEN}{_GAP}/{_GAP}10{ENDS_WORD}(?!{_GAP}/)"
_STARS = f"{_GAP}-?{_GAP}(?:star|stars){ENDS_WORD}"
_DIGIT_STARS = rf"(?iu)(?=[0-5]){STARTS_WORD}([0-5](?:\.\p{{Nd}}+)?){_STARS}"
_WORD_STARS = f"(?iu)(?=[zotf][a-z]{{2}}){STARTS_WORD}({'|'.join(STAR_WORDS)}){_STARS}"


def _mark_ratings(col: Column, gate: Column, pattern: str, total: float, score=None) -> Column:
    marked = replace_computed(
        col, pattern, lambda hit: _rating_token(score(hit) if score else hit, total), 1
    )
    return F.when(gate, marked).otherwise(col)


def mark_out_of_ten(col: Column) -> Column:
    return _mark_ratings(col, col.contains("10"), _OUT_OF_TEN, 10.0)


def mark_slash_ten(col: Column) -> Column:
    return _mark_ratings(col, col.contains("10"), _SLASH_TEN, 10.0)


def _names_stars(col: Column) -> Column:
    return col.rlike("(?iu)star")


def mark_digit_stars(col: Column) -> Column:
    return _mark_ratings(col, _names_stars(col), _DIGIT_STARS, 5.0)


def mark_word_stars(col: Column) -> Column:
    return _mark_ratings(
        col, _names_stars(col), _WORD_STARS, 5.0, lambda word: lookup(STAR_WORDS)[F.lower(word)]
    )


def mark_grades(col: Column) -> Column:
    grades = "|".join(grade.replace("+", r"\+") for grade in HIGH_GRADES + LOW_GRADES)
    return replace_computed(
        col,
        f"(?i)(?=[abdf][+-]){STARTS_WORD}(?:{grades}){ENDS_WORD}",
        lambda hit: F.when(F.lower(hit).isin(HIGH_GRADES), F.lit(" __grade_high__ ")).otherwise(
            F.lit(" __grade_low__ ")
        ),
    )


def mark_punctuation_runs(col: Column) -> Column:
    marked = F.regexp_replace(col, MIXED_MARKS, " __mixed_punct__ ")
    marked = F.regexp_replace(marked, EXCLAMATIONS, " __repeat_exclamation__ ")
    marked = F.regexp_replace(marked, QUESTIONS, " __repeat_question__ ")
    return F.when(col.rlike("[!?]{2}"), marked).otherwise(col)


def shorten_elongation(col: Column) -> Column:
    return F.regexp_replace(col, ELONGATION, "$1$1")


# --- negation ---------------------------------------------------------------

_TRIGGER = f"(?i:{'|'.join(NEGATION_TRIGGERS)})(?![^ ])"
# Over text whose tokens are separated by one space: a trigger, then up to four
# words that are no trigger, with any symbols but a boundary in between.
_SCOPE = (
    f"(?=[nNcCwWhHbBrR])(?<![^ ]){_TRIGGER}"
    f"(?:(?: [^{WORD} {NEGATION_BOUNDARIES}])*+ (?!{_TRIGGER})[{WORD}]++){{0,{NEGATION_WINDOW}}}"
)


def space_tokens(col: Column) -> Column:
    """Words and single symbols, one space between them."""
    return collapse_space(F.regexp_replace(col, f"([^{WORD}{SPACE}])", " $1 "))


def mark_negation(spaced: Column) -> Column:
    """``_NEG`` on the words a negation reaches, for text from `space_tokens`.

    A scope is one regex match, so no token is exploded and nothing is shuffled.
    """
    return replace_computed(
        spaced, _SCOPE, lambda scope: F.regexp_replace(scope, f"( [{WORD}]+)", "$1_NEG")
    )


# --- chains -----------------------------------------------------------------

KEY_STEPS = [text_or_empty, collapse_space, lower_fold, late_fold]
BASE_STEPS = [text_or_empty, unescape_html, strip_tags, nfkc, fold_typography, drop_unseen]
RATING_STEPS = [mark_out_of_ten, mark_slash_ten, mark_digit_stars, mark_word_stars]
MASK_STEPS = [
    mask_email,
    mask_url,
    expand_listed_contractions,
    expand_other_negations,
    *RATING_STEPS,
    mark_grades,
    mark_punctuation_runs,
    shorten_elongation,
    collapse_space,
]
NEGATION_STEPS = [space_tokens, mark_negation]


def with_steps(df: DataFrame, source: str, target: str, steps: list) -> DataFrame:
    """``target`` = ``steps`` applied in order to ``source``."""
    df = df.withColumn(target, F.col(source))
    for step in steps:
        df = df.withColumn(target, step(F.col(target)))
    return df


def with_duplicate_key(
    df: DataFrame, text_col: str = "TEXT", out: str = "duplicate_key"
) -> DataFrame:
    """Key of the clean-up step: whitespace collapsed, case fully folded."""
    return with_steps(df, text_col, out, KEY_STEPS)


def with_base_text(df: DataFrame, text_col: str = "TEXT", out: str = "base_text") -> DataFrame:
    """Text without markup, in NFKC and plain typography."""
    return with_steps(df, text_col, out, BASE_STEPS)


def with_clean_text(
    df: DataFrame,
    base_col: str = "base_text",
    out: str = "clean_text",
    negation: bool = False,
) -> DataFrame:
    """Model text from base text, with or without negation scopes."""
    return with_steps(df, base_col, out, MASK_STEPS + (NEGATION_STEPS if negation else []))
