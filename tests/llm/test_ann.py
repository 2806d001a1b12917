import numpy as np
import pytest

from lexisieve.llm import ann

SCHEMA = "vec_id bigint, embedding array<float>, label int, score double, leaf int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0.0, 0) for i, v in rows], SCHEMA)


def exact(rows, queries, k):
    vectors = {i: np.array(v, np.float32).astype(float) for i, v in rows}
    return {
        q: sorted(((-float(vectors[i] @ vectors[q]), i) for i in vectors if i != q))[:k] for q in queries
    }


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((-r.score, r.vec_id))
        assert len(out[r.query_id]) == r["rank"]
    return out


def test_recall(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(20, 24))
    data = centres[rng.integers(0, 20, 6000)] + rng.normal(size=(6000, 24))
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = frame(spark, rows)
    got = found(ann.nearest(df, df.filter("vec_id % 20 = 0"), 20, min_candidates=500, share=0.4))
    want = exact(rows, range(0, 6000, 20), 20)
    hits = sum(len({i for _, i in got[q]} & {i for _, i in want[q]}) for q in want)
    assert hits >= 0.9 * 20 * len(want)


def test_ties_bad_vectors_and_few_candidates(spark):
    rows = [(i, [1.0, 0.0]) for i in range(40)] + [(40, [0.0, 2.0]), (41, [0.5, 0.5])]
    bad = [
        (50, None), (51, []), (52, [0.0, 0.0]), (53, [1.0, None]), (54, [float("nan"), 1.0]),
        (55, [float("inf"), 1.0]), (56, [1.0, 2.0, 3.0]), (None, [1.0, 0.0]),
    ]
    df = frame(spark, [*rows, *bad, (7, [1.0, 0.0])])
    got = found(ann.nearest(df, df, 5))
    want = exact(rows, [i for i, _ in rows], 5)
    assert got.keys() == want.keys()
    for q in want:
        assert [i for _, i in got[q]] == [i for _, i in want[q]]
        assert [s for s, _ in got[q]] == pytest.approx([s for s, _ in want[q]])
    few = frame(spark, [(1, [1.0]), (2, [2.0]), (3, [-1.0])])
    assert found(ann.nearest(few, few, 20))[1] == [(-2.0, 2), (1.0, 3)]


def test_large_leaves_are_cut_into_blocks(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "FIT_ROWS", 100)
    rng = np.random.default_rng(2)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.normal(size=(800, 8)))]
    df = frame(spark, rows)
    got = found(ann.nearest(df, df.filter("vec_id < 20"), 10, trees=4, share=1.0))
    want = exact(rows, range(20), 10)
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}


def test_empty_table(spark):
    assert ann.nearest(frame(spark, []), frame(spark, []), 5).count() == 0


def test_recall_of_the_registered_settings_on_unstructured_vectors(spark):
    """Independent unit vectors, like the given ones: the hardest case, and more than are looked at whole."""
    rng = np.random.default_rng(8)
    data = rng.normal(size=(10_000, 64))
    data = (data / np.linalg.norm(data, axis=1)[:, None]).astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(data)]
    df = frame(spark, rows)
    got = found(ann.nearest(df, df.filter("vec_id % 50 = 0"), 20))
    scores = data[::50].astype(float) @ data.astype(float).T
    scores[np.arange(200), np.arange(0, 10_000, 50)] = -2
    want = np.argsort(-scores, axis=1)[:, :20]
    hits = sum(len({i for _, i in got[50 * q]} & set(want[q].tolist())) for q in range(200))
    assert all(len(x) == 20 for x in got.values()) and hits >= 0.9 * 20 * 200


def test_equal_hot_queries_and_small_teams(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 30)
    monkeypatch.setattr(ann, "ASKED", 10)
    rng = np.random.default_rng(9)
    rows = [(i, [1.0, 2.0, 3.0]) for i in range(300)]
    rows += [(300 + i, np.round(v, 2).tolist()) for i, v in enumerate(rng.normal(size=(300, 3)))]
    df = frame(spark, rows)
    got = found(ann.nearest(df, df, 7))
    want = exact(rows, range(600), 7)
    assert {q: [i for _, i in x] for q, x in got.items()} == {q: [i for _, i in x] for q, x in want.items()}
