from pyspark.sql import functions as F

from lexisieve.operators import dedup as D
from lexisieve.plans import report as R

TRAIN = [("1", 1, "A b", 1), ("2", 2, "a  B", 1), ("3", 3, "", 0), ("4", 4, None, 0), ("5", 5, "x", 2), ("6", 6, "y", 0)]
TEST = [("7", 7, "X"), ("8", 8, " "), ("9", 9, "z"), ("10", 10, "Z")]


def tables(spark):
    train = spark.createDataFrame(TRAIN, "ID string, row_idx long, TEXT string, LABEL int")
    test = spark.createDataFrame(TEST, "ID string, row_idx long, TEXT string")
    return train, test


def ids(df):
    return sorted(int(r.ID) for r in df.select("ID").collect())


def test_cleaning_summary(spark):
    row = D.cleaning_summary(*tables(spark)).first().asDict()
    expected = {
        "original_train_rows": 6, "original_test_rows": 4,
        "original_train_label_0": 3, "original_train_label_1": 2, "original_train_label_2": 1,
        "train_duplicate_groups": 2, "train_extra_duplicate_rows": 2,
        "test_duplicate_groups": 1, "test_extra_duplicate_rows": 1,
        "train_test_overlap_groups": 2, "train_overlap_rows_removed": 3,
        "train_rows_after_overlap_removal": 3, "train_duplicate_rows_removed": 1,
        "clean_train_rows": 2, "unique_test_rows_for_inference": 3,
        "clean_train_label_0": 1, "clean_train_label_1": 1, "clean_train_label_2": 0,
        "test_duplicate_rows_collapsed": 1, "conflicting_duplicate_label_groups": 0,
    }
    assert row == expected
    assert row["original_train_rows"] - row["train_overlap_rows_removed"] == row["train_rows_after_overlap_removal"]


def test_clean_views(spark):
    train, test = tables(spark)
    assert ids(D.clean_train(train, test)) == [1, 6]
    assert ids(D.without_overlap(train, test)) == [1, 2, 6]
    assert ids(D.keep_first(test)) == [7, 8, 9]
    again = D.keep_first(D.keep_first(train))
    assert ids(again) == ids(D.keep_first(train)) == [1, 3, 5, 6]


def test_report_ignores_blank_text(spark):
    train, test = tables(spark)
    rows = {(r.location, r.check): r for r in R.duplicate_summary(train, test).collect()}
    dup = "duplicate normalized text"
    assert (rows["train", dup].group_count, rows["train", dup].train_row_count) == (1, 2)
    assert (rows["test", dup].group_count, rows["test", dup].test_row_count) == (1, 2)
    shared = rows["train/test", "shared normalized text"]
    assert (shared.group_count, shared.train_row_count, shared.test_row_count) == (1, 1, 1)
    assert rows["train", dup].test_row_count is None
    assert not rows["train", dup + " with conflicting labels"].exists


def test_one_text_in_most_rows(spark):
    rows = spark.range(5000).select(
        F.col("id").cast("string").alias("ID"), F.col("id").alias("row_idx"),
        F.when(F.col("id") % 3 > 0, "Same  Text").otherwise(F.concat(F.lit("t"), "id")).alias("TEXT"),
    )
    first = D.keep_first(rows)
    assert first.count() == 1667 + 1
    values = first.select("row_idx", (F.col("row_idx") * 2).alias("v"))
    expanded = D.expand_by_key(rows, values, "v").collect()
    assert len(expanded) == 5000
    assert all(r.v == (2 if r.row_idx % 3 else r.row_idx * 2) for r in expanded)


def test_conflicts_are_listed_in_source_order(spark):
    rows = [("1", 1, "B", 0), ("2", 2, "a", 1), ("3", 3, "A", 2), ("4", 4, "b ", 1), ("5", 5, "c", 1)]
    train = spark.createDataFrame(rows, "ID string, row_idx long, TEXT string, LABEL int")
    found = D.conflict_examples(D.label_conflicts(train)).collect()
    assert [(r.key_start, list(r.labels), r.rows) for r in found] == [("b", [0, 1], 2), ("a", [1, 2], 2)]


def test_report_tables(spark):
    train, test = tables(spark)
    train, test = train.select("row_idx", "ID", "TEXT", "LABEL"), test.select("row_idx", "ID", "TEXT")
    sample = test.select("row_idx", "ID", F.lit(0).alias("LABEL"))
    made = R.build_tables(train, test, sample)
    assert len(made) == 11
    assert all(r.matches_expected_order for r in made["columns"].collect())
    missing = {(r.split, r.column): (r.missing_count, r.blank_count) for r in made["missing"].collect()}
    assert missing["train", "TEXT"] == (1, 2) and missing["test", "TEXT"] == (0, 1)
    stats = {(r.split, r.feature): r for r in made["num_by_split"].collect()}
    assert stats["test", "char_count"].median == 1.0
    assert {r["check"]: r.value for r in made["ids"].collect()}["train_test_id_overlap_count"] == "0"
