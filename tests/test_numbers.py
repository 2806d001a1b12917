import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lexisieve.operators import evaluate as E
from lexisieve.operators import features as X
from lexisieve.operators.quantiles import numeric_summary
from lexisieve.operators.skew import join_by_weight, with_dense_index
from lexisieve.operators.split import holdout_quotas, with_holdout


def test_numeric_summary_golden(spark):
    df = spark.range(10).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("v"))
    row = numeric_summary(df, ["g"], "v").first()
    assert (row["count"], row.mean, row.min, row.median, row.max) == (10, 4.5, 0, 4.5, 9)
    assert row.p90 == pytest.approx(8.1)


def test_numeric_summary_against_numpy(spark):
    rng = random.Random(3)
    groups = {
        "skewed": [rng.expovariate(0.001) ** 2 for _ in range(3001)],
        "hot": [0.0] * 2000 + [rng.random() for _ in range(777)],
        "one": [5.0],
        "two": [1.0, 2.0],
        None: [rng.gauss(0, 1) for _ in range(500)],
    }
    rows = [(g, v) for g, vs in groups.items() for v in vs]
    rows += [("one", None), ("one", math.nan), ("one", math.inf), ("empty", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r.g: r for r in numeric_summary(df, ["g"], "v").collect()}
    assert set(got) == set(groups) | {"empty"}
    for g, vs in groups.items():
        assert got[g]["count"] == len(vs)
        assert got[g].median == pytest.approx(np.quantile(vs, 0.5))
        assert got[g].p90 == pytest.approx(np.quantile(vs, 0.9))
        assert got[g].mean == pytest.approx(np.mean(vs))
    assert got["empty"]["count"] == 0 and got["empty"].median is None


def test_holdout_quotas(spark):
    counts = spark.createDataFrame([(0, 31133), (1, 19080), (2, 18744)], "LABEL int, n long")
    quotas = {r.LABEL: r.quota for r in holdout_quotas(counts, "LABEL").collect()}
    assert quotas == {0: 6227, 1: 3816, 2: 3749}


def test_holdout_is_exact_and_stable(spark):
    df = spark.range(3000).select(
        F.col("id").cast("string").alias("ID"), F.col("id").alias("row_idx"),
        F.when(F.col("id") % 10 < 6, 0).when(F.col("id") % 10 < 9, 1).otherwise(2).alias("LABEL"),
    )
    split = with_holdout(df)
    sizes = {r.LABEL: r.n for r in split.filter("is_valid").groupBy("LABEL").agg(F.count("*").alias("n")).collect()}
    assert sizes == {0: 360, 1: 180, 2: 60} and split.count() == 3000
    again = with_holdout(df.repartition(5))
    assert split.exceptAll(again).count() == 0


def test_metrics_of_published_matrix(spark):
    matrix = [[6126, 65, 36], [105, 3435, 276], [40, 333, 3376]]
    cells = [(a, p, matrix[a][p]) for a in range(3) for p in range(3)]
    df = spark.createDataFrame(cells, "LABEL int, pred int, n int").select(
        "LABEL", "pred", F.explode(F.sequence(F.lit(1), F.col("n")))
    )
    assert [list(r)[1:] for r in E.confusion_matrix(df).orderBy("actual").collect()] == matrix
    overall = E.overall_metrics(df).first()
    assert round(overall.macro_f1, 4) == 0.9288 and round(overall.accuracy, 4) == 0.9380
    per_class = E.per_class_metrics(df).orderBy("LABEL").collect()
    assert [[round(r.precision, 4), round(r.recall, 4), round(r.f1, 4), r.support] for r in per_class] == [
        [0.9769, 0.9838, 0.9803, 6227], [0.8962, 0.9002, 0.8982, 3816], [0.9154, 0.9005, 0.9079, 3749]
    ]


def test_metrics_without_rows_of_a_label(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "LABEL int, pred int")
    assert [r.f1 for r in E.per_class_metrics(df).orderBy("LABEL").collect()] == [1.0, 0.0, 0.0]


def test_idf_and_limits(spark):
    rows = [(1, "aa bb"), (2, "aa cc"), (3, "aa"), (4, "aa")]
    docs = spark.createDataFrame(rows, "row_idx long, clean_text string")
    terms = X.document_terms(docs, {"word": (1, 1)})
    n = docs.agg(F.count("*")).scalar()
    idf = {r.term: r.idf for r in X.vocabulary(X.document_frequency(terms), n, {"word": 1}, {}).collect()}
    assert idf["aa"] == pytest.approx(1.0) and idf["bb"] == pytest.approx(1.916291, abs=1e-6)
    assert X.vocabulary(X.document_frequency(terms), n, {"word": 2}, {"word": 0.95}).count() == 0


def test_unknown_terms_and_zero_scale(spark):
    train = spark.createDataFrame([(1, "aa bb aa", "aa bb aa"), (2, "aa bb", "aa bb"), (3, "zz", "zz")],
                                  "row_idx long, clean_text string, base_text string")
    test = spark.createDataFrame([(9, "bb qq"), (8, "qq")], "row_idx long, clean_text string")
    n = train.agg(F.count("*")).scalar()
    counts = X.document_frequency(X.document_terms(train, {"word": (1, 1)}))
    vocab = X.vocabulary(counts, n, {"word": 2}, {})
    terms = X.document_terms(test, {"word": (1, 1)})
    rows = X.tfidf(terms, vocab).collect()
    assert [(r.row_idx, r.term, r.weight) for r in rows] == [(9, "bb", 1.0)]
    scored = X.linear_score(terms, vocab.withColumn("weight", F.lit(2.0)), test, 0.5)
    assert {r.row_idx: r.margin for r in scored.collect()} == {9: 2.5, 8: 0.5}
    assert X.surface_scale(train).first().question_count == 1.0


def test_join_by_weight_equals_join(spark):
    facts = spark.range(20000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 4000))).alias("k"), "id"
    )
    dim = facts.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("top"))
    got = join_by_weight(facts, dim, ["k"], "n", F.col("id"))
    want = facts.join(dim, "k")
    assert got.count() == 20000
    assert got.select(want.columns).exceptAll(want).count() == 0
    partial = dim.filter("k <> 'hot'")
    left = join_by_weight(facts, partial, ["k"], "n", F.col("id"), "left")
    assert left.count() == 20000 and left.filter("top is null and k <> 'hot'").count() == 0


def test_hot_keys_without_a_partner_are_dropped_or_spread(spark):
    """Three quarters of all rows on one key: no partition holds more than twice the mean."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(40000).select(
            F.when(F.col("id") % 4 > 0, "hot").otherwise(F.concat(F.lit("k"), "id")).alias("k"), "id"
        )
        for keep in ("k <> 'hot'", "k = 'hot'"):
            dim = facts.groupBy("k").agg(F.count("*").alias("n")).withColumn("keep", F.expr(keep))
            joined = join_by_weight(facts, dim, ["k"], "n", F.col("id"), keep="keep")
            sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
            assert joined.columns == ["k", "id", "n"] and sum(sizes) == (10000 if "<>" in keep else 30000)
            assert max(sizes) <= 2 * sum(sizes) / 8
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_quantiles_with_an_outlier(spark):
    df = spark.range(200_000).select(
        F.lit("g").alias("g"), F.when(F.col("id") == 0, 1e300).otherwise(F.col("id") * 0.5).alias("v")
    )
    row = numeric_summary(df, ["g"], "v").first()
    assert (row["count"], row["min"], row["median"], row["max"]) == (200_000, 0.5, 50000.25, 1e300)
    assert row.p90 == pytest.approx(0.5 + 0.9 * 199_999 * 0.5)


def test_dense_index(spark):
    df = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("term"))
    rows = with_dense_index(df, ["term"], "idx", buckets=16)
    assert sorted(r.idx for r in rows.collect()) == list(range(5000))
    again = with_dense_index(df.repartition(3), ["term"], "idx", buckets=16)
    assert rows.exceptAll(again).count() == 0
