import numpy as np
from texts import edited, prose

from lexisieve.llm import jaccard
from lexisieve.llm.components import connected_components


def brute_force(rows):
    sets = {}
    for doc, text in rows:
        w = (text or "").encode().lower().split()
        sets[doc] = frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for i, a in enumerate(ids):
        for b in ids[:i]:
            inter = len(sets[a] & sets[b])
            if inter and 100 * inter >= 80 * len(sets[a] | sets[b]) and find(a) != find(b):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {d: (len(sets[d]), find(d)) for d in ids}


def classes(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_classes_equal_brute_force(make_docs):
    base = prose(120, 1)
    texts = [None, "", " \t\n", "one two", "ONE  two", "one two three four five", base, base.upper(), base]
    texts += [edited(base, k, 10 + k) for k in range(1, 12)]
    texts += [prose(30, 100 + i) for i in range(15)] + [prose(4000, 7), edited(prose(4000, 7), 60, 8)]
    # a passage that many texts share, and texts around the threshold
    shared = prose(60, 9)
    texts += [f"{prose(10 + i, 200 + i)} {shared}" for i in range(20)]
    docs = make_docs(texts)
    docs = docs.union(docs.filter("doc_id = 6"))
    assert classes(jaccard.jaccard_classes(docs)) == brute_force(list(enumerate(texts)))
    kept = jaccard.keep_one_of_each(docs)
    want = {d for d, (_, c) in brute_force(list(enumerate(texts))).items() if d == c}
    assert {r.doc_id for r in kept.collect()} == want and kept.columns == docs.columns


def test_large_groups_go_through_blocks(make_docs, monkeypatch):
    monkeypatch.setattr(jaccard, "SMALL_LIST", 4)
    monkeypatch.setattr(jaccard, "BLOCK", 8)
    base = prose(100, 3)
    texts = [edited(base, 1 + i % 6, 500 + i) for i in range(60)]
    found = classes(jaccard.jaccard_classes(make_docs(texts)))
    assert found == brute_force(list(enumerate(texts)))
    assert 1 < len({c for _, c in found.values()}) < 60


def test_empty_table(make_docs):
    assert jaccard.jaccard_classes(make_docs([])).count() == 0
    assert jaccard.keep_one_of_each(make_docs([])).count() == 0


def test_every_order_keeps_linked_pairs(spark, make_docs):
    base = prose(200, 4)
    docs = make_docs([base, *(edited(base, 3, i) for i in range(5)), *(prose(50, i) for i in range(9))])
    sampled = jaccard.sample_tokens(docs, "doc_id", "text")
    rows = {r.doc_id: r for r in jaccard.prefixes(sampled.cache()).collect()}
    for a in range(6):
        for b in range(a):
            for order in ("first", "second", "third"):
                assert set(rows[a][order]) & set(rows[b][order])


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(5, i) for i in range(6, 60)]
    edges = spark.createDataFrame([*chain, *star, (3, 3), (200, 5), (200, 5)], "a bigint, b bigint")
    roots = {r.id: r.root for r in connected_components(edges).collect()}
    assert {roots[i] for i in range(100, 161)} == {100}
    assert {roots[i] for i in [200, *range(5, 60)]} == {5} and roots[3] == 3


def test_shingles_split_as_the_pattern_does():
    assert len(jaccard.shingle_set("a\x0bb\x0cc d e f")) == 1
    assert np.array_equal(jaccard.shingle_set("A b"), jaccard.shingle_set("a  B"))
    assert not np.array_equal(jaccard.shingle_set("Ä b"), jaccard.shingle_set("ä b"))


def test_one_text_in_most_rows_and_a_class_around_it(make_docs):
    base = prose(60, 40)
    texts = [base] * 450 + [edited(base, 1, 41 + i) for i in range(60)] + [prose(40, 200 + i) for i in range(90)]
    found = classes(jaccard.jaccard_classes(make_docs(texts)))
    assert found == brute_force(list(enumerate(texts)))


def test_components_of_a_star_and_a_chain(spark):
    star = [(0, i) for i in range(1, 3000)]
    chain = [(i, i + 1) for i in range(5000, 5040)]
    edges = spark.createDataFrame([*star, *chain, (7, 7), (9000, 9001), (9001, 9000)], "a bigint, b bigint")
    roots = {r.id: r.root for r in connected_components(edges).collect()}
    assert all(roots[i] == 0 for i in range(3000)) and all(roots[i] == 5000 for i in range(5000, 5041))
    assert roots[9001] == 9000 and len(roots) == 3000 + 41 + 2
