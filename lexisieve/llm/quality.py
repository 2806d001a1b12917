"""Quality rules: base counts, and divergence from the histograms of a document's language.

A language's reference is what all of its documents that pass the base rules hold
together: a histogram of character classes and one of common words. A document is rejected when its own
histograms are too far away (Jensen-Shannon distance, base 2, so 0 to 1). Documents
below the minimum lengths, and languages with too little text, are not judged.

Native: one pass over the texts computes every count, references are one aggregation
of those narrow rows, and the verdict is arithmetic on arrays.

Defined results: null or empty text has no words and fails the base rule; a null
language is a language of its own; an unknown language has no common words, so only
character classes are compared; repeated rows and ids are judged row by row; an empty
table gives an empty result. Other input columns are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.llm.common import bind, split_words
from lexisieve.session import materialize

WINDOW = 8

# --- fixed values: common words of a language --------------------------------

COMMON_WORDS = {
    "en": ["the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "with", "was", "be"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "qui", "dans", "par"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist", "des", "ein", "eine", "auf"],
    "es": ["de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por", "un", "para"],
}


@dataclass(frozen=True)
class QualityRules:
    """Limits of the verdict; lengths are guards below which nothing is judged."""

    min_words: int = 20
    max_repeat_percent: int = 30
    min_chars: int = 200
    max_char_distance: float = 0.25
    min_judged_words: int = 100
    max_word_distance: float = 0.3
    min_reference_chars: int = 10_000
    common_words: dict[str, list[str]] = field(default_factory=lambda: COMMON_WORDS)


def count_repeated_words(words: Column) -> Column:
    """Words inside 8-word windows that occur twice or more, the first one included.

    Windows are compared by a 64-bit hash of their words' hashes. Only texts that do
    repeat a window sort them to find where.
    """

    def starts(windows: Column) -> Column:
        placed = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("at"))))
        return bind(
            placed,
            lambda s: F.array_sort(
                F.array_compact(
                    F.transform(
                        s,
                        lambda x, i: F.when(
                            (x["h"] == F.get(s, i - 1)["h"]) | (x["h"] == F.get(s, i + 1)["h"]),
                            x["at"],
                        ),
                    )
                )
            ),
        )

    def covered(at: Column) -> Column:
        steps = F.transform(
            at, lambda x, i: F.least(F.coalesce(F.get(at, i + 1) - x, F.lit(WINDOW)), F.lit(WINDOW))
        )
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def counted(windows: Column) -> Column:
        return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("bigint")).otherwise(
            bind(starts(windows), covered)
        )

    def paired(hashes: Column, distance: int) -> Column:
        return F.transform(hashes, lambda h, i: F.xxhash64(h, F.get(hashes, i + distance)))

    def windows(words: Column) -> Column:
        # hashes of 2, 4 and 8 words; windows cut short by the text's end equal no other
        hashes = F.transform(words, lambda w: F.xxhash64(w))
        for distance in (1, 2, 4):
            hashes = bind(hashes, lambda h: paired(h, distance))
        return hashes

    return F.when(F.size(words) > WINDOW, bind(windows(words), counted)).otherwise(
        F.lit(0).cast("bigint")
    )


def _char_classes(df: DataFrame) -> DataFrame:
    """``_chars``: code points per class, each class counted on what earlier ones left."""
    classes = ["[a-z]+", r"[\x20\x09-\x0D]+", "[A-Z]+", "[0-9]+", r"\p{L}+", "[#*$%&|<>]+"]
    df = df.withColumn("_rest0", F.col("_text"))
    for i, pattern in enumerate(classes):
        df = df.withColumn(f"_rest{i + 1}", F.regexp_replace(f"_rest{i}", pattern, ""))
    lengths = [F.length(f"_rest{i}").cast("bigint") for i in range(len(classes) + 1)]
    counts = [a - b for a, b in zip(lengths, lengths[1:])] + [lengths[-1]]
    return df.withColumn("_chars", F.array(*counts)).drop(*[f"_rest{i}" for i in range(len(classes) + 1)])


def _common_counts(words: Column, lang: Column, lists: dict[str, list[str]]) -> Column:
    """Occurrences of each common word of the row's language, in the list's order; then of all others."""

    def of(common: list[str]) -> Column:
        forms = [form for w in common for form in (w, w.capitalize(), w.upper())]
        found = F.transform(F.filter(words, lambda w: w.isin(forms)), F.lower)
        return bind(
            found,
            lambda f: F.array(
                *[(F.size(f) - F.size(F.array_remove(f, w))).cast("bigint") for w in common],
                (F.size(words) - F.size(f)).cast("bigint"),
            ),
        )

    counts = F.lit(None).cast("array<bigint>")
    for name, common in lists.items():
        counts = F.when(lang == name, of(common)).otherwise(counts)
    return counts


def quality_counts(
    docs: DataFrame,
    keep: list[str],
    rules: QualityRules = QualityRules(),
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """One row per row of ``docs``: its ``keep`` columns as struct ``kept_columns``, and the counts."""
    df = docs.select(
        F.struct(*keep).alias("kept_columns"),
        F.coalesce(F.col(text_col), F.lit("")).alias("_text"),
        F.col(lang_col).alias("_lang"),
    )
    df = _char_classes(df).withColumn("_words", split_words(F.col("_text")))
    lines = F.filter(F.split("_text", "\n"), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    df = df.select(
        "kept_columns",
        "_lang",
        F.size("_words").cast("bigint").alias("n_words"),
        (F.length("_text") - F.element_at("_chars", 2)).cast("bigint").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", "#*$%&|<>", ""))).cast("bigint").alias("n_symbols"),
        bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines"),
        count_repeated_words(F.col("_words")).alias("n_repeat_words"),
        "_chars",
        _common_counts(F.col("_words"), F.col("_lang"), rules.common_words).alias("_common"),
    )
    failed = (F.col("n_words") < rules.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * rules.max_repeat_percent
    )
    return df.withColumn("base_failed", failed)


def language_references(counts: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Per language the summed histograms of all its documents that pass the base rules."""
    n_chars, n_common = 7, max((len(x) + 1 for x in rules.common_words.values()), default=0)
    sums = [F.sum(F.get("_chars", F.lit(i))).alias(f"c{i}") for i in range(n_chars)]
    sums += [F.sum(F.get("_common", F.lit(i))).alias(f"w{i}") for i in range(n_common)]
    return (
        counts.filter(~F.col("base_failed"))
        .groupBy("_lang")
        .agg(*sums)
        .select(
            F.col("_lang").alias("_ref_lang"),
            F.array(*[f"c{i}" for i in range(n_chars)]).alias("_ref_chars"),
            F.array_compact(F.array(*[f"w{i}" for i in range(n_common)])).alias("_ref_common"),
        )
    )


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0.0), lambda total, x: total + x)


def js_distance(left: Column, right: Column) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2) of two count arrays."""

    def part(p: Column, q: Column) -> Column:
        return F.when(p > 0, p * F.log2(p * 2 / (p + q))).otherwise(F.lit(0.0))

    def divergence(totals: Column) -> Column:
        pairs = F.zip_with(
            left,
            right,
            lambda a, b: part(a / totals["l"], b / totals["r"]) + part(b / totals["r"], a / totals["l"]),
        )
        return F.sqrt(F.greatest(_total(pairs) / 2, F.lit(0.0)))

    totals = F.struct(_total(left).alias("l"), _total(right).alias("r"))
    return bind(totals, lambda t: F.when((t["l"] > 0) & (t["r"] > 0), divergence(t)))


def judge(counts: DataFrame, references: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Add ``char_distance``, ``word_distance`` and ``kept``; a missing distance judges nothing."""
    long_enough = (_total(F.col("_chars")) >= rules.min_chars) & (
        _total(F.col("_ref_chars")) >= rules.min_reference_chars
    )
    enough_words = F.col("n_words") >= rules.min_judged_words
    joined = counts.join(references, F.col("_lang").eqNullSafe(F.col("_ref_lang")), "left")
    judged = joined.withColumn(
        "char_distance", F.when(long_enough, js_distance(F.col("_chars"), F.col("_ref_chars")))
    ).withColumn(
        "word_distance",
        F.when(long_enough & enough_words, js_distance(F.col("_common"), F.col("_ref_common"))),
    )
    far = (F.coalesce("char_distance", F.lit(0.0)) > rules.max_char_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > rules.max_word_distance
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~far).drop(
        "_lang", "_ref_lang", "_chars", "_common", "_ref_chars", "_ref_common"
    )


def quality_verdicts(
    docs: DataFrame,
    keep: list[str],
    rules: QualityRules = QualityRules(),
    text_col: str = "text",
    lang_col: str = "lang",
) -> DataFrame:
    """Every row's ``keep`` columns (struct ``kept_columns``), counts, distances and verdict.

    Counts are written once, since the references need all of them first.
    """
    counts = materialize(quality_counts(docs, keep, rules, text_col, lang_col))
    references = materialize(language_references(counts, rules))
    return judge(counts, references, rules)


def drop_low_quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """``docs`` without the rows the rules reject, columns unchanged."""
    return quality_verdicts(docs, docs.columns, rules).filter("kept").select("kept_columns.*")
