"""Duplicate texts: statistics, conflicts, overlap, keep-first, expansion.

Everything works on narrow tables ``(key, order, label)`` whose key is a 32-byte
digest and which are written once. Texts are read again only to emit surviving rows:
the rows to drop, far fewer than those that stay, are listed by their unique order
column, so a hot text never gathers its rows in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexisieve.functions.normalize import key_digest, with_duplicate_key
from lexisieve.operators.labels import LABELS
from lexisieve.operators.skew import join_by_weight
from lexisieve.session import materialize

KEY = "key"


def keyed(df: DataFrame, text_col: str = "TEXT") -> DataFrame:
    """``df`` with the key digest of its text in place of the text."""
    return (
        with_duplicate_key(df, text_col, "_key")
        .withColumn(KEY, key_digest(F.col("_key")))
        .drop("_key", text_col)
    )


def key_groups(
    keys: DataFrame, order_col: str = "row_idx", label_col: str | None = None
) -> DataFrame:
    """One row per key: ``n`` rows, the first row, and label facts if there are labels.

    All aggregates have fixed-width state, so they hash-aggregate before the shuffle.
    """
    facts = [F.count("*").alias("n"), F.min(order_col).alias("first_idx")]
    if label_col:
        label = F.col(label_col)
        facts += [
            F.min_by(label, order_col).alias("first_label"),
            F.min(label).alias("low_label"),
            F.max(label).alias("high_label"),
            *[F.count_if(label == value).alias(f"n_{value}") for value in LABELS],
        ]
    return keys.groupBy(KEY).agg(*facts)


def _total(value: Column, condition: Column) -> Column:
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0))


def duplicate_stats(groups: DataFrame) -> DataFrame:
    """Groups of two or more rows, the rows in them, and the rows beyond the first."""
    repeated = F.col("n") > 1
    return groups.agg(
        F.count_if(repeated).alias("duplicate_group_count"),
        _total(F.col("n"), repeated).alias("rows_in_duplicate_groups"),
        _total(F.col("n") - 1, repeated).alias("extra_duplicate_rows"),
    )


def label_conflicts(
    train: DataFrame,
    text_col: str = "TEXT",
    label_col: str = "LABEL",
    order_col: str = "row_idx",
) -> DataFrame:
    """Keys whose rows disagree on the label: key start, labels, rows, first row."""
    with_key = with_duplicate_key(train, text_col, "_key").select(
        key_digest(F.col("_key")).alias(KEY),
        F.substring("_key", 1, 80).alias("key_start"),
        F.col(label_col).alias("label"),
        F.col(order_col).alias("idx"),
    )
    # every row of a key has the same start, so it is grouped on, not aggregated
    per_label = with_key.groupBy(KEY, "key_start", "label").agg(
        F.count("*").alias("n"), F.min("idx").alias("idx")
    )
    return (
        per_label.groupBy(KEY, "key_start")
        .agg(
            F.array_sort(F.collect_list("label")).alias("labels"),
            F.sum("n").alias("rows"),
            F.min("idx").alias("first_idx"),
        )
        .filter(F.size("labels") > 1)
        .drop(KEY)
    )


def conflict_examples(conflicts: DataFrame, limit: int = 5) -> DataFrame:
    """The first conflicts in source order, for an error message."""
    return conflicts.orderBy("first_idx").limit(limit)


def narrow_keys(df: DataFrame, text_col: str = "TEXT", order_col: str = "row_idx") -> DataFrame:
    """``(order, key)`` of every row, written once."""
    return materialize(keyed(df.select(order_col, text_col), text_col))


def later_rows(
    keys: DataFrame, order_col: str = "row_idx", test_keys: DataFrame | None = None
) -> DataFrame:
    """Order values of rows that are not the first of their key, or whose key is in ``test_keys``."""
    groups = key_groups(keys, order_col).withColumn("_shared", F.lit(False))
    if test_keys is not None:
        known = test_keys.select(KEY).distinct().withColumn("_known", F.lit(True))
        groups = groups.join(known, KEY, "left").withColumn("_shared", F.col("_known").isNotNull()).drop("_known")
    groups = groups.withColumn("_listed", F.col("_shared") | (F.col("n") > 1))
    rows = join_by_weight(keys, materialize(groups), [KEY], "n", F.col(order_col), keep="_listed")
    return materialize(
        rows.filter(F.col("_shared") | (F.col(order_col) != F.col("first_idx"))).select(order_col)
    )


def keep_first(
    df: DataFrame, text_col: str = "TEXT", order_col: str = "row_idx", keys: DataFrame | None = None
) -> DataFrame:
    """First row in source order of every distinct text key; ``keys`` from `narrow_keys` saves a pass."""
    keys = narrow_keys(df, text_col, order_col) if keys is None else keys
    return df.join(later_rows(keys, order_col), order_col, "left_anti")


def without_overlap(
    train: DataFrame, test: DataFrame, text_col: str = "TEXT", order_col: str = "row_idx"
) -> DataFrame:
    """Train rows whose key does not occur in test."""
    train_keys = narrow_keys(train, text_col, order_col)
    known = keyed(test.select(text_col), text_col).distinct().withColumn("_shared", F.lit(True))
    groups = materialize(
        key_groups(train_keys, order_col)
        .join(known, KEY, "left")
        .select(KEY, "n", F.coalesce("_shared", F.lit(False)).alias("_shared"))
    )
    dropped = join_by_weight(train_keys, groups, [KEY], "n", F.col(order_col), keep="_shared")
    return train.join(materialize(dropped.select(order_col)), order_col, "left_anti")


def clean_train(
    train: DataFrame,
    test: DataFrame,
    text_col: str = "TEXT",
    order_col: str = "row_idx",
    train_keys: DataFrame | None = None,
    test_keys: DataFrame | None = None,
) -> DataFrame:
    """Train without test overlap, first row of every key.

    A key is either wholly in the overlap or not at all, so both are decided on one row
    per key.
    """
    train_keys = narrow_keys(train, text_col, order_col) if train_keys is None else train_keys
    test_keys = keyed(test.select(text_col), text_col) if test_keys is None else test_keys
    return train.join(later_rows(train_keys, order_col, test_keys), order_col, "left_anti")


def overlap_stats(train_groups: DataFrame, test_groups: DataFrame) -> DataFrame:
    """Distinct shared keys and the train and test rows that carry them."""
    shared = train_groups.select(KEY, F.col("n").alias("train_n")).join(
        test_groups.select(KEY, F.col("n").alias("test_n")), KEY
    )
    return shared.agg(
        F.count("*").alias("overlap_groups"),
        F.coalesce(F.sum("train_n"), F.lit(0)).alias("train_rows"),
        F.coalesce(F.sum("test_n"), F.lit(0)).alias("test_rows"),
    )


def cleaning_summary(
    train: DataFrame,
    test: DataFrame,
    text_col: str = "TEXT",
    label_col: str = "LABEL",
    order_col: str = "row_idx",
    train_keys: DataFrame | None = None,
    test_keys: DataFrame | None = None,
) -> DataFrame:
    """All clean-up counts in one row.

    Each table is scanned once and aggregated by key; both sides are then
    partitioned by key, so their full outer join needs no further shuffle. Tables of
    keys that are there already (`keyed`) are not made again.
    """
    if train_keys is None:
        train_keys = keyed(train.select(order_col, label_col, text_col), text_col)
    if test_keys is None:
        test_keys = keyed(test.select(order_col, text_col), text_col)
    train_groups = key_groups(train_keys, order_col, label_col)
    test_groups = key_groups(test_keys, order_col)
    both = train_groups.join(
        test_groups.select(KEY, F.col("n").alias("test_n")), KEY, "full_outer"
    )
    n, test_n = F.col("n"), F.col("test_n")
    in_train, in_test = n.isNotNull(), test_n.isNotNull()
    kept = in_train & ~in_test
    everything = F.lit(True)
    return both.agg(
        _total(n, everything).alias("original_train_rows"),
        _total(test_n, everything).alias("original_test_rows"),
        *[
            _total(F.col(f"n_{label}"), everything).alias(f"original_train_label_{label}")
            for label in LABELS
        ],
        F.count_if(n > 1).alias("train_duplicate_groups"),
        _total(n - 1, n > 1).alias("train_extra_duplicate_rows"),
        F.count_if(test_n > 1).alias("test_duplicate_groups"),
        _total(test_n - 1, test_n > 1).alias("test_extra_duplicate_rows"),
        F.count_if(in_train & in_test).alias("train_test_overlap_groups"),
        _total(n, in_train & in_test).alias("train_overlap_rows_removed"),
        _total(n, kept).alias("train_rows_after_overlap_removal"),
        _total(n - 1, kept).alias("train_duplicate_rows_removed"),
        F.count_if(kept).alias("clean_train_rows"),
        *[
            F.count_if(kept & (F.col("first_label") == label)).alias(f"clean_train_label_{label}")
            for label in LABELS
        ],
        F.count_if(in_test).alias("unique_test_rows_for_inference"),
        _total(test_n - 1, in_test).alias("test_duplicate_rows_collapsed"),
        F.count_if(F.col("low_label") != F.col("high_label")).alias(
            "conflicting_duplicate_label_groups"
        ),
    )


def expand_by_key(
    rows: DataFrame,
    unique_values: DataFrame,
    value_col: str,
    text_col: str = "TEXT",
    order_col: str = "row_idx",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Give every row the value of its key's first row.

    ``unique_values`` is ``(order_col, value_col)`` for the rows `keep_first` returns.
    A key whose first row has no value yields null. Popular keys are split.
    """
    keys = materialize(keyed(rows, text_col)) if keys is None else keys
    valued = materialize(
        key_groups(keys, order_col)
        .withColumnRenamed("first_idx", order_col)
        .join(unique_values, order_col, "left")
        .select(KEY, "n", value_col)
    )
    return join_by_weight(keys, valued, [KEY], "n", F.col(order_col), "left").drop(KEY, "n")
