import bisect
import random

import pytest
from pyspark.sql import functions as F

from lexisieve.operators import sketches as Q
from lexisieve.plans import report as R


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    rng = random.Random(2)
    texts = ["Fine!!!", "fine!!!", " ", None, "see http://x.y <b>ok</b>", "2 + 2 = 4?", "ÄRGER, ärger"]
    train = [(f"r{i}", rng.choice(texts), rng.choice(["0", "1", "2", "x", None, "7"]), i) for i in range(60)]
    train += [("r1", "again", "1", 60), (None, "again", "2", 61)]
    test = [(f"t{i}", rng.choice(texts), i) for i in range(25)] + [("r5", "again", 25)]
    sample = [(t[0], 0, t[2]) for t in test[::-1]]
    folder = tmp_path_factory.mktemp("report")
    for name, rows, schema in (
        ("train", train, "ID string, TEXT string, LABEL string, row_idx long"),
        ("test", test, "ID string, TEXT string, row_idx long"),
        ("sample_submission", sample, "ID string, LABEL int, row_idx long"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}")
    return {name: spark.read.parquet(f"{folder}/{name}") for name in ("train", "test", "sample_submission")}


def rows_of(df):
    columns = sorted(df.columns)
    return sorted([tuple(r[c] for c in columns) for r in df.collect()], key=str)


def test_tables_from_one_pass_equal_those_of_the_single_functions(inputs):
    train, test, sample = inputs.values()
    got = R.build_tables(*inputs.values())
    features = R.text_features(train, "train", keep=("LABEL",))
    both = features.drop("LABEL").unionByName(R.text_features(test, "test"))
    by_label = R.labelled(features)
    want = {
        "overview": R.overview(inputs),
        "missing": R.missing_report(inputs),
        "ids": R.id_report(train, test, sample),
        "num_by_split": R.summarize_numeric(both, ["split"]),
        "num_by_label": R.summarize_numeric(by_label, ["LABEL", "label_meaning"]),
        "binary_by_label": R.summarize_binary(by_label),
        "duplicate_summary": R.duplicate_summary(train, test),
        "label_counts": R.label_distribution(train),
        "label_integrity": R.label_integrity(train),
        "unexpected_labels": R.unexpected_labels(train),
    }
    assert set(got) == set(want) | {"columns"}
    for name, table in want.items():
        assert got[name].columns == table.columns
        assert rows_of(got[name]) == rows_of(table), name


def test_each_input_is_read_once(inputs, tmp_path):
    plan = R.input_facts  # the one step that reads the inputs
    reads = []
    real, R.input_facts = R.input_facts, lambda *args: reads.append(args) or plan(*args)
    try:
        tables = R.build_tables(*inputs.values())
    finally:
        R.input_facts = real
    assert len(reads) == 1
    places = {df.inputFiles()[0].rsplit("/", 1)[0] for df in inputs.values()}
    for name, table in tables.items():
        assert not places & {f.rsplit("/", 1)[0] for f in table.inputFiles()}, name
    R.write_tables(tables, str(tmp_path))
    assert (tmp_path / "duplicate_summary").exists()


@pytest.mark.parametrize("kind", ["skewed", "equal", "few", "spread"])
def test_quantile_sketches_keep_their_rank_error(spark, kind):
    rng = random.Random(kind)
    values = {
        "skewed": [float(int(rng.paretovariate(1.1))) for _ in range(60_000)],
        "equal": [4.0] * 50_000 + [5.0] * 10,
        "few": [1.0, 2.0, 9.0],
        "spread": [rng.random() for _ in range(60_000)],
    }[kind]
    rows = [(i % 7, v) for i, v in enumerate(values)] + [(0, None), (1, float("nan")), (2, float("inf"))]
    df = spark.createDataFrame(rows, "part int, value double").withColumn("g", F.lit("all"))
    parts = Q.quantile_sketches(df, ["g", "part"], "value")
    shares = {"q1": 0.01, "median": 0.5, "p90": 0.9, "p999": 0.999}
    told = Q.sketched_quantiles(Q.merge_quantiles(parts, ["g"]), shares).first()
    ordered = sorted(values)
    assert told["count"] == len(values)
    for name, share in shares.items():
        low, high = (f(ordered, told[name]) / len(ordered) for f in (bisect.bisect_left, bisect.bisect_right))
        slack = Q.rank_error() + 1 / len(ordered)
        assert low - slack <= share <= high + slack


def test_sketches_of_nothing(spark):
    df = spark.createDataFrame([("a", None)], "g string, value double")
    assert tuple(Q.sketched_quantiles(Q.quantile_sketches(df, ["g"], "value"), {"median": 0.5}).first()) == ("a", 0, None)
    assert tuple(Q.sketched_distinct(Q.distinct_sketches(df, ["g"], "value")).first()) == ("a", 0)


@pytest.mark.parametrize("n", [1, 50, 3000, 200_000])
def test_distinct_sketches_keep_their_error(spark, n):
    df = spark.range(3 * n).select((F.col("id") % n).alias("value"), (F.col("id") % 5).alias("part"))
    merged = Q.merge_distinct(Q.distinct_sketches(df, ["part"], "value"), [])
    assert abs(Q.sketched_distinct(merged).first()[0] - n) <= Q.distinct_error() * n + 0.5
