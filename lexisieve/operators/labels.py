"""Labels: coercion, names, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------

LABEL_MEANINGS = {
    0: "not a movie/TV review",
    1: "positive movie/TV review",
    2: "negative movie/TV review",
}
LABELS = list(LABEL_MEANINGS)


# What counts as a number; Java alone would also take "1d" and hexadecimal.
_NUMBER = r"(?i)^[+-]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:e[+-]?[0-9]+)?|inf|infinity|nan)$"


def to_number(col: Column) -> Column:
    """Number or null, whatever the column holds; blanks around it do not count."""
    text = F.trim(col.cast("string"))
    return F.when(text.rlike(_NUMBER), text.try_cast("double"))


def finite(number: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(number) & (F.abs(number) != float("inf")), number)


def is_integral(number: Column) -> Column:
    """Within float tolerance of an integer; an infinity counts as one."""
    whole = F.rint(number)
    return (number == whole) | (F.abs(number - whole) <= 1e-8 + 1e-5 * F.abs(whole))


def label_name(number: Column) -> Column:
    name = F.when(number.isNull() | F.isnan(number), F.lit("missing/unparseable"))
    for label, meaning in LABEL_MEANINGS.items():
        name = name.when(number == label, F.lit(meaning))
    return name.otherwise(F.lit("unexpected label"))


def shown_number(number: Column) -> Column:
    """A number as the report shows it: whole ones as integers, infinities as ``inf``."""
    whole = F.coalesce(number.try_cast("bigint").cast("string"), number.cast("string"))
    return (
        F.when(number == float("inf"), "inf")
        .when(number == float("-inf"), "-inf")
        .when(number == F.rint(number), whole)
        .otherwise(number.cast("string"))
    )


def percent(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * F.lit(100.0), whole), F.lit(0.0))


def label_table(df: DataFrame) -> DataFrame:
    """One row per expected label, in the session of ``df``."""
    rows = list(LABEL_MEANINGS.items())
    return df.sparkSession.createDataFrame(rows, "LABEL int, meaning string")


def label_counts(df: DataFrame, label_col: str = "LABEL") -> DataFrame:
    """Count per expected label, zero included, and percent of those counts."""
    counted = df.agg(
        *[F.count_if(F.col(label_col) == label).alias(str(label)) for label in LABELS],
        F.count_if(F.col(label_col).isin(LABELS)).alias("total"),
    )
    return counted.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(label).alias("LABEL"),
                        F.lit(meaning).alias("meaning"),
                        F.col(str(label)).alias("count"),
                        percent(F.col(str(label)), F.col("total")).alias("percent"),
                    )
                    for label, meaning in LABEL_MEANINGS.items()
                ]
            )
        )
    )


def label_distribution(train: DataFrame, label_col: str = "LABEL") -> DataFrame:
    """Counts of expected, unexpected and missing labels, in percent of all rows.

    One aggregation by value; expected labels appear even at zero, missing ones
    only when there are any.
    """
    number = to_number(F.col(label_col))
    by_value = train.groupBy(F.when(~F.isnan(number), number).alias("value")).count()
    total = F.coalesce(by_value.agg(F.sum("count")).scalar(), F.lit(0))
    expected = label_table(train).select(F.col("LABEL").cast("double").alias("value"))
    shown = by_value.join(expected, "value", "full_outer").select(
        F.when(F.col("value").isNull(), F.lit("missing_or_unparseable"))
        .otherwise(shown_number(F.col("value")))
        .alias("LABEL"),
        F.when(F.col("value").isNull(), F.lit("missing or unparseable label"))
        .otherwise(label_name(F.col("value")))
        .alias("meaning"),
        F.coalesce("count", F.lit(0)).alias("count"),
    )
    return shown.withColumn("proportion_pct", percent(F.col("count"), total))


def unexpected_labels(train: DataFrame, label_col: str = "LABEL") -> DataFrame:
    """``(value, rows)`` of every number that is no expected label."""
    number = to_number(F.col(label_col))
    return (
        train.select(number.alias("value"))
        .filter(~F.isnan("value") & ~F.col("value").isin(LABELS))
        .groupBy("value")
        .agg(F.count("*").alias("rows"))
    )


def label_integrity(train: DataFrame, label_col: str = "LABEL") -> DataFrame:
    """One row: valid, missing and unexpected label rows, and how many unexpected values.

    Which values these are is a table of its own, `unexpected_labels`.
    """
    number = to_number(F.col(label_col))
    missing = number.isNull() | F.isnan(number)
    valid = ~missing & number.isin(LABELS)
    odd = unexpected_labels(train, label_col).agg(F.count("*")).scalar()
    return train.agg(
        F.count_if(valid).alias("valid_label_rows"),
        F.count_if(missing).alias("missing_or_unparseable_rows"),
        F.count_if(~missing & ~valid).alias("unexpected_label_rows"),
        odd.alias("unexpected_label_count"),
        (F.count_if(~valid) == 0).alias("all_training_labels_valid"),
    )


def shown_labels(unexpected: DataFrame) -> str:
    """The values of `unexpected_labels` as one text, for a report that shows them.

    As integers if all are, else as floats; the smallest first.
    """
    values = sorted(row.value for row in unexpected.select("value").toLocalIterator())
    if all(v == v // 1 for v in values if abs(v) != float("inf")) and all(abs(v) != float("inf") for v in values):
        return ", ".join(str(int(v)) for v in values)
    return ", ".join(str(v) for v in values)
