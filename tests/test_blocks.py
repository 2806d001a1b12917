import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from lexisieve.operators import blocks as B
from lexisieve.operators import features as X
from lexisieve.operators.skew import with_dense_index

RANGES = {"word": (1, 3), "char": (3, 5)}


def grams(text):
    """The terms of a text by branch, in plain Python."""
    words = [w for w in (text or "").lower().split(" ") if w]
    tokens = [w for w in words if len(w) > 1]
    return {
        "word": Counter(" ".join(tokens[i : i + n]) for n in (1, 2, 3) for i in range(len(tokens) - n + 1)),
        "char": Counter(f" {w} "[i : i + n] for w in words for n in (3, 4, 5) for i in range(len(w) + 3 - n)),
    }


@pytest.fixture(scope="module", params=[B.BLOCK_CHARS, 900])
def made(spark, request):
    """Documents with null, empty and repeated texts, two rows of one ID and rows without one, in one or more blocks."""
    rng = random.Random(2)
    pool = ["aa", "Bb", "c", "déjà", "\N{GRINNING FACE}x", "ab1", "zzz", "q"]
    rows = [(i, " ".join(rng.choice(pool) for _ in range(rng.randint(0, 30)))) for i in range(150)]
    rows += [(7, "aa bb new"), (None, "aa aa"), (None, "bb"), (200, None), (201, ""), (202, rows[3][1])]
    rows = [(i, t.replace("\N{GRINNING FACE}", "\N{SUPERSCRIPT TWO}") if t else t) for i, t in rows]
    docs = spark.createDataFrame(rows, "row_idx long, clean_text string").repartition(3)
    held, B.BLOCK_CHARS, chunk, B.CHUNK = B.BLOCK_CHARS, request.param, B.CHUNK, 100
    try:
        yield rows, docs, X.block_terms(docs, RANGES)
    finally:
        B.BLOCK_CHARS, B.CHUNK = held, chunk


def counted(rows):
    return Counter((branch, term) for _, text in rows for branch, terms in grams(text).items() for term in terms)


def test_documents_of_terms_against_brute_force(made):
    rows, docs, terms = made
    want = counted(rows)
    assert {(r.branch, r.term): r.df for r in X.document_frequency(terms).collect()} == want
    least = {"word": 2, "char": 3}
    kept = {k: n for k, n in want.items() if n >= least[k[0]]}
    assert {(r.branch, r.term): r.df for r in X.document_frequency(terms, least).collect()} == kept
    read = X.document_frequency(B.counted_terms(docs, RANGES), least)
    assert {(r.branch, r.term): r.df for r in read.collect()} == kept


def test_occurrences_against_brute_force(made):
    rows, docs, _ = made
    want = sum((Counter({(b, t): n for b, found in grams(text).items() for t, n in found.items()}) for _, text in rows), Counter())
    assert {(r.branch, r.term): r.n for r in X.term_occurrences(docs, RANGES).collect()} == want


def test_surface_features_are_measured_once(spark, tmp_path):
    docs = spark.createDataFrame([(1, "A b! 2"), (2, None), (3, "Wow!! ok")], "row_idx long, base_text string")
    docs = docs.withColumn("base_text", F.coalesce("base_text", F.lit("")))
    measured = X.measured_surface(docs)
    scaled = X.scaled_surface(measured, X.surface_scale(measured))
    assert scaled.exceptAll(X.scaled_surface(docs, X.surface_scale(docs))).isEmpty() and scaled.count() == 3
    assert "regexp" not in scaled._jdf.queryExecution().optimizedPlan().toString()


def test_a_large_alphabet(spark):
    text = " ".join("".join(chr(0x4E00 + (7 * i + k) % 4000) for k in range(6)) for i in range(800))
    docs = spark.createDataFrame([(1, text), (2, text[: len(text) // 2])], "row_idx long, clean_text string")
    want = Counter()
    for t in (text, text[: len(text) // 2]):
        want.update({f" {w} "[i : i + n] for w in t.split() for n in range(3, 7) for i in range(len(w) + 3 - n)})
    terms = X.block_terms(docs, {"char": (3, 6)})
    assert {r.term: r.df for r in X.document_frequency(terms).collect()} == want


def test_a_term_is_one_row_of_a_block(made):
    """Not of a document: what is shuffled by term does not grow with repeated words."""
    rows, _, terms = made
    assert terms.terms.groupBy("block", "branch", "term").count().filter("count > 1").isEmpty()
    assert terms.terms.agg(F.sum("df")).first()[0] == sum(counted(rows).values())


def test_weights_and_scores_against_brute_force(spark, made):
    rows, docs, terms = made
    n, want = len(rows), []
    idf = {k: math.log((1 + n) / (1 + df)) + 1 for k, df in counted(rows).items() if df >= 2}
    x = [
        (i, branch, term, (1 + math.log(tf)) * idf[branch, term])
        for i, text in rows for branch, found in grams(text).items() for term, tf in found.items() if (branch, term) in idf
    ]
    squares = Counter()
    for i, branch, _, value in x:
        squares[i, branch] += value * value
    want = Counter((i, branch, term, round(value / math.sqrt(squares[i, branch]), 9)) for i, branch, term, value in x)
    vocab = X.vocabulary(X.document_frequency(terms), F.lit(n), {"word": 2, "char": 2}, {})
    got = X.tfidf(terms, vocab).collect()
    assert Counter((r.row_idx, r.branch, r.term, round(r.weight, 9)) for r in got) == want

    model = vocab.withColumn("weight", F.length("term").cast("double"))
    margins = Counter()
    for (i, _, term, weight), times in want.items():
        margins[i] += weight * len(term) * times
    scored = X.linear_score(terms, model, docs, 0.5).filter("row_idx is not null").collect()
    assert len(scored) == n - 2
    assert {r.row_idx: r.margin for r in scored} == pytest.approx({r[0]: margins[r[0]] + 0.5 for r in rows if r[0] is not None})


def test_rows_for_a_fit_come_in_order(spark):
    """Sums of squares then do not change with the order in which a block found its terms."""
    docs = spark.createDataFrame([(1, "zz bb aa mm"), (2, "mm zz aa")], "row_idx long, clean_text string")
    terms = X.block_terms(docs, {"word": (1, 2)})
    vocab = X.vocabulary(X.document_frequency(terms), F.lit(2), {}, {})
    rows = [(r.row_idx, r.term) for r in X.weigh(terms, vocab).collect()]
    assert rows == sorted(rows) and len(rows) == 12


def test_rows_for_a_fit_are_made_in_their_block(spark):
    """One row for each ID, features in order; no row for each feature is gathered again."""
    docs = spark.createDataFrame(
        [(1, "zz bb aa mm aa"), (2, "mm zz aa"), (2, "aa bb"), (None, "aa bb"), (3, None), (4, "only")],
        "row_idx long, clean_text string",
    )
    terms = X.block_terms(docs, RANGES)
    vocab = X.vocabulary(X.document_frequency(terms), F.lit(6), {"word": 2, "char": 2}, {})
    vocab = with_dense_index(vocab, ["branch", "term"], "idx")
    want = {}
    for r in X.tfidf(terms, vocab).join(vocab, ["branch", "term"]).filter("row_idx is not null").collect():
        want.setdefault(r.row_idx, []).append((r.idx, r.weight))
    rows = {r.row_idx: list(zip(r.idx, r.value)) for r in B.block_entries(terms, vocab).collect() if r.row_idx is not None}
    assert rows.keys() == want.keys() == {1, 2}
    for i, entries in rows.items():
        assert [j for j, _ in entries] == sorted(j for j, _ in want[i])
        assert [x for _, x in entries] == pytest.approx([x for _, x in sorted(want[i])])


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "row_idx long, clean_text string")
    terms = X.block_terms(docs, RANGES)
    vocab = X.vocabulary(X.document_frequency(terms, {"word": 2, "char": 3}), F.lit(0), {}, {})
    assert X.tfidf(terms, vocab).count() == 0
    nothing = spark.createDataFrame([(1, " "), (2, None)], docs.schema)
    assert X.block_terms(nothing, RANGES).terms.count() == 0


def test_char_ngrams_are_made_of_distinct_words(spark, sf_dir):
    """Explicit n-grams of every occurrence are never rows of the plan's shuffle."""
    from catalog.queries import QUERIES

    plan = QUERIES["char_ngrams"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    # the plan is printed from its top: n-grams are made above the grouping by word
    assert 0 <= plan.index("regexp_extract_all") < plan.index("Aggregate [word")


def test_terms_travel_in_lists(made, monkeypatch):
    """A row is a block's terms of a bucket, whatever their number; groups of buckets do not change what is counted."""
    rows, docs, terms = made
    keys = terms.lists.groupBy("block", "branch", "bucket").agg(F.count("*").alias("k"), F.sum("n").alias("n")).collect()
    assert all(r.k == 1 for r in keys) and sum(r.n for r in keys) == terms.terms.count()
    for group in (B.GROUP, 40):
        monkeypatch.setattr(B, "GROUP", group)
        found = X.document_frequency(terms, {"word": 2, "char": 2})
        assert {(r.branch, r.term): r.df for r in found.collect()} == {k: n for k, n in counted(rows).items() if n >= 2}
        weights = X.tfidf(terms, X.vocabulary(found, F.lit(len(rows)), {}, {}))
        assert weights.select("branch", "term").distinct().count() == found.count()
        assert "SortMergeJoin" not in weights._jdf.queryExecution().executedPlan().toString()


def test_given_texts_are_shuffled_once(spark, made):
    """Documents whose size is known are stored by block; neither counting nor weighing deals them again."""
    rows, docs, terms = made
    stored = X.block_terms(docs, RANGES, chars=docs.agg(F.sum(F.length("clean_text"))).first()[0])
    assert "Exchange" not in stored.docs.groupBy("block").applyInArrow(lambda t: t, stored.docs.schema)._jdf.queryExecution().executedPlan().toString()
    vocab = X.vocabulary(X.document_frequency(terms), F.lit(len(rows)), {"word": 2, "char": 2}, {})
    key = lambda df: Counter((r.row_idx, r.branch, r.term, round(r.weight, 9)) for r in df.collect())
    assert key(X.tfidf(stored, vocab)) == key(X.tfidf(terms, vocab))


def test_buckets_depend_on_bytes_alone():
    import pyarrow as pa

    terms = ["", "a", "b", "ab", "ba", "déjà vu", "x" * 100_000] + [f"t{i}" for i in range(70_000)]
    found = B._bucket(pa.array(terms, pa.large_string()))
    assert found[:7].tolist() == [int(B._bucket(pa.array([t], pa.large_string()))[0]) for t in terms[:7]]
    assert (found[9:] == B._bucket(pa.array(terms, pa.large_string()).slice(9))).all()
    assert max(Counter(found[7:].tolist()).values()) < 40
