import numpy as np
import pytest
from pyspark.sql import functions as F
from texts import prose

from lexisieve.llm import mixing

SCHEMA = "doc_id bigint, source string, lang string, topic string, n_tokens bigint"


def rows(spark, n=3000):
    rng = np.random.default_rng(1)
    data = [
        (
            i, "hot" if rng.random() < 0.4 else [None, "a", "b"][rng.integers(3)],
            ["en", "fr"][int(rng.random() < 0.2)], ["x", "y", "-"][rng.integers(3)], int(rng.integers(0, 400)),
        )
        for i in range(n)
    ]
    return spark.createDataFrame(data, SCHEMA)


def test_weights_meet_the_margins(spark):
    df = rows(spark)
    plan = mixing.Mixture(tolerance=1e-9, rounds=60)
    done = mixing.mixture(df, plan).toPandas()
    assert len(done) == 3000 and done.probability.between(0, 1).all()
    everything = done.n_tokens.sum()
    for margin in plan.margins:
        g = done.assign(key=done[margin].fillna("(null)"), fit=done.n_tokens * done.probability).groupby("key")
        have, fit = g.n_tokens.sum(), g.fit.sum()
        target = have**plan.flatten / (have**plan.flatten).sum() * everything * plan.budget
        assert fit.to_numpy() == pytest.approx(target.to_numpy(), rel=1e-3)
        kept = done[done.kept].assign(key=done[margin].fillna("(null)")).groupby("key").n_tokens.sum()
        assert kept.to_numpy() == pytest.approx(target.to_numpy(), rel=0.15)


def test_raking_equals_numpy(spark):
    rng = np.random.default_rng(2)
    start = rng.integers(50, 500, (3, 4)).astype(float)
    cells = spark.createDataFrame(
        [(f"={i}", f"={j}", int(start[i, j])) for i in range(3) for j in range(4)], "a string, b string, tokens bigint"
    )
    goal_a, goal_b = start.sum(1) * [0.3, 0.2, 0.25], start.sum(0) * 0.25
    goal_b *= goal_a.sum() / goal_b.sum()
    targets = spark.createDataFrame(
        [("a", f"={i}", float(x)) for i, x in enumerate(goal_a)] + [("b", f"={i}", float(x)) for i, x in enumerate(goal_b)],
        "margin string, value string, target double",
    )
    plan = mixing.Mixture(margins=("a", "b"), tolerance=1e-10, rounds=25)
    got = {(r.a, r.b): r.weight for r in mixing.rake(cells, targets, plan).collect()}
    want = start.copy()
    for _ in range(200):
        want *= (goal_a / want.sum(1))[:, None]
        want *= goal_b / want.sum(0)
    assert [got[f"={i}", f"={j}"] for i in range(3) for j in range(4)] == pytest.approx(want.ravel().tolist(), rel=1e-6)


def test_sampling_keeps_columns_and_odd_rows(make_docs):
    docs = make_docs([None, "", *(prose(30 + i, i) for i in range(60))]).union(
        make_docs(["| " * 200, "mail a@b.c"], lang=None, source=None, first=900)
    )
    docs = docs.union(docs.filter("doc_id = 5")).withColumn("topic", F.lit("own"))
    kept = mixing.sample_mixture(docs, mixing.Mixture(budget=0.8))
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    fives = kept.filter("doc_id = 5").count()
    assert fives in (0, 2)
    again = mixing.sample_mixture(docs.repartition(3), mixing.Mixture(budget=0.8))
    assert {r.doc_id for r in again.collect()} == {r.doc_id for r in kept.collect()}


def test_empty_and_wordless_tables(make_docs, spark):
    assert mixing.sample_mixture(make_docs([])).count() == 0
    assert mixing.sample_mixture(make_docs(["", None])).count() == 0


def test_the_default_plan_meets_every_reachable_value(spark):
    report = mixing.mixture_report(rows(spark)).collect()
    assert {r.margin for r in report} == set(mixing.Mixture().margins)
    assert all(r.met for r in report if r.reachable)


def test_values_out_of_reach_are_told(spark):
    df = rows(spark)
    cells = mixing.token_cells(df, mixing.Mixture())
    targets = mixing.flattened_targets(cells, mixing.Mixture()).collect()
    goal = [(r.margin, r.value, r.target * (50.0 if r.value == "=b" else 1.0)) for r in targets] + [("lang", "=xx", 5.0)]
    wanted = spark.createDataFrame(goal, "margin string, value string, target double")
    report = {(r.margin, r.value): r for r in mixing.mixture_report(df, targets=wanted).collect()}
    assert not report["source", "=b"].reachable and not report["source", "=b"].met
    assert report["source", "=b"].fitted <= report["source", "=b"].available * (1 + 1e-9)
    assert not report["lang", "=xx"].reachable and report["lang", "=xx"].fitted == 0
    assert report["source", "=a"].reachable


def test_repeated_ids_share_their_fate_at_the_default_plan(spark):
    df = rows(spark, 500)
    done = mixing.mixture(df.union(df.filter("doc_id % 3 = 0"))).groupBy("doc_id").agg(F.collect_set("kept").alias("k"))
    assert done.filter(F.size("k") > 1).count() == 0
