import numpy as np
import pytest

from lexisieve.llm import inner

SCHEMA = "vec_id bigint, embedding array<double>, v int, id int, norm string, team int, cell int, band int, least int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, 0, "clash", 1, 2, 3, 4) for i, v in rows], SCHEMA)


def exact(rows, queries, k):
    vectors = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            vectors[i] = min(vectors.get(i, list(v)), list(v))
    width = max(map(len, vectors.values()), default=0)
    full = {i: np.array([*v, *[0.0] * (width - len(v))]) for i, v in vectors.items()}
    out = {}
    for q in queries:
        if q in full:
            best = sorted((-float(v @ full[q]), i) for i, v in full.items() if i != q)[:k]
            out |= {(q, r + 1): (i, -s) for r, (s, i) in enumerate(best)}
    return out


def found(df):
    rows = df.collect()
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


def whole_numbers(rng, n, width, scale):
    return [(int(i), np.floor(v * scale).tolist()) for i, v in enumerate(rng.normal(size=(n, width)))]


@pytest.mark.parametrize("case", ["alike", "low rank", "lengths differ"])
def test_equals_all_pairs(spark, monkeypatch, case):
    monkeypatch.setattr(inner, "BLOCK", 150)
    monkeypatch.setattr(inner, "ASKED", 7)
    monkeypatch.setattr(inner, "HEAD", 40)
    monkeypatch.setattr(inner, "STEP", 32)
    rng = np.random.default_rng(3)
    rows = whole_numbers(rng, 2000, 16, 50)
    if case == "low rank":
        basis = rng.normal(size=(2, 16))
        rows = [(i, np.floor(rng.normal(size=2) @ basis * 40).tolist()) for i in range(2000)]
    if case == "lengths differ":
        rows = [(i, np.floor(np.array(v) * rng.pareto(1.5)).tolist()) for i, v in rows]
    df = frame(spark, rows)
    got = found(inner.top_inner_products(df, df.filter("vec_id % 50 = 0"), 5))
    assert got == exact(rows, range(0, 2000, 50), 5)


def test_one_vector_holds_most_rows(spark, monkeypatch):
    monkeypatch.setattr(inner, "BLOCK", 100)
    monkeypatch.setattr(inner, "HEAD", 20)
    rng = np.random.default_rng(4)
    rows = [(i, [3.0, -1.0, 2.0]) for i in range(1500)] + [(2000 + i, v) for i, v in whole_numbers(rng, 500, 3, 4)]
    df = frame(spark, rows)
    queries = [i for i, _ in rows if i % 25 == 0]
    assert found(inner.top_inner_products(df, df.filter("vec_id % 25 = 0"), 5)) == exact(rows, queries, 5)


def test_bad_short_zero_and_repeated_vectors(spark):
    rows = [
        (0, [1.0, 2.0]), (0, [1.0, 2.0]), (1, [1.0]), (2, []), (3, [0.0, 0.0]), (4, None), (5, [1.0, None]),
        (6, [float("nan"), 1.0]), (7, [float("inf"), 0.0]), (None, [9.0, 9.0]), (8, [-1.0, -2.0]), (9, [2.0, 0.0]),
        (9, [1.0, 5.0]),
    ]
    df = frame(spark, rows)
    assert found(inner.top_inner_products(df, df, 5)) == exact(rows, range(10), 5)
    assert found(inner.top_inner_products(df, df, 1)) == exact(rows, range(10), 1)
    few = frame(spark, [(1, [2.0]), (2, [3.0])])
    assert found(inner.top_inner_products(few, few, 5)) == {(1, 1): (2, 6.0), (2, 1): (1, 6.0)}
    assert found(inner.top_inner_products(few, few.filter("vec_id > 5"), 5)) == {}


def test_whole_numbers(spark):
    rows = [(0, [0.999, -0.001, 0.0, 1e30, None])]
    assert frame(spark, rows).select(inner.whole("embedding")).first()[0] == [255.0, -1.0, 0.0, 2.56e32, None]


def test_empty_table(spark):
    assert inner.top_inner_products(frame(spark, []), frame(spark, []), 5).count() == 0


def test_pruning_drops_most_pairs_of_structured_vectors():
    """Residual bounds work: hardly any pair is multiplied out where few directions hold all."""
    rng = np.random.default_rng(6)
    rows = rng.normal(size=(4000, 4)) @ rng.normal(size=(4, 64)) * 100 * rng.pareto(2, size=(4000, 1))
    rows = np.floor(rows)
    basis = inner.rotation(rows.T @ rows)
    turned = rows @ basis
    rest = np.linalg.norm(turned[:, 16:], axis=1)
    exact = rows[:50] @ rows.T
    bound = turned[:50, :16] @ turned[:, :16].T + np.outer(rest[:50], rest)
    assert (bound >= exact - 1e-6 * np.abs(exact).max()).all()
    fifth = np.sort(exact, axis=1)[:, -5]
    assert (bound >= fifth[:, None]).mean() < 0.01
