import collections
import math
import re

from texts import prose

from lexisieve.llm import quality


def brute_force(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    at = collections.defaultdict(list)
    for i in range(len(w) - 7):
        at[tuple(w[i : i + 8])].append(i)
    inside = {i + k for places in at.values() if len(places) > 1 for i in places for k in range(8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (
        len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside),
        len(w) < 20 or 100 * len(inside) > 30 * len(w),
    )


def verdicts(df):
    return {r.kept_columns.doc_id: r for r in quality.quality_verdicts(df, ["doc_id", "n"]).collect()}


def test_counts_and_verdicts(make_docs):
    clean = [prose(150 + i, i) for i in range(40)]
    junk = [" ".join(f"{w}{'#$%&'[i % 4] * 3}" for i, w in enumerate(prose(150, 90).split())), prose(150, 91).upper() + "!!"]
    odd = [
        None, "", " \n\t", "a b c", "same line\nsame line\n\nother\nsame line", "x y z w v u t s " * 40,
        prose(30, 92) + "\n" + prose(30, 92), "é\x0bü | < > # " * 9, prose(25_000, 93),
        " ".join(["word"] * 300), "a b c d e f g h a b c d e f g h i",
    ]
    texts = clean + junk + odd
    docs = make_docs(texts)
    got = verdicts(docs.union(docs.filter("doc_id = 3")))
    for i, text in enumerate(texts):
        r = got[i]
        assert (
            r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed
        ) == brute_force(text)
    assert all(got[i].kept for i in range(40)) and not got[40].kept and not got[41].kept
    assert not got[42].kept
    kept = quality.drop_low_quality(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {i for i in got if got[i].kept}


def test_languages_are_judged_apart(make_docs):
    german = " ".join(["der Wald und die Straße"] + [prose(9, i) for i in range(3)])
    docs = make_docs([prose(200, i) for i in range(30)])
    other = make_docs([german], lang=None, first=100).union(make_docs([german], lang="xx", first=200))
    got = verdicts(docs.union(other))
    # too little text of its own language to be judged by
    assert got[100].char_distance is None and got[200].char_distance is None and got[100].kept


def test_distance(spark):
    row = spark.sql("SELECT array(1L, 0L, 3L) a, array(0L, 2L, 2L) b, array(0L, 0L, 0L) z").select(
        quality.js_distance(*map(quality.F.col, "ab")).alias("ab"),
        quality.js_distance(quality.F.col("a"), quality.F.col("a")).alias("aa"),
        quality.js_distance(quality.F.col("a"), quality.F.col("z")).alias("az"),
    ).first()
    p, q = (0.25, 0, 0.75), (0, 0.5, 0.5)
    want = sum(
        x * math.log2(2 * x / (x + y)) / 2 for a, b in ((p, q), (q, p)) for x, y in zip(a, b) if x
    )
    assert math.isclose(row.ab, math.sqrt(want)) and row.aa == 0 and row.az is None


def test_empty_table(make_docs):
    assert quality.drop_low_quality(make_docs([])).count() == 0
