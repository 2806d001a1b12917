import hashlib
import random
import zlib

import numpy as np
import pytest

from lexisieve.llm import runs

SCHEMA = "doc_id bigint, text string, id int, runs int, collapsed int, start int, n_words int"


def brute(words, least=runs.LEAST_LENGTH):
    """All runs, by looking at each period."""
    n, out = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j + q - i >= least:
                out.setdefault((i, j + q), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in out.items())


def caught(ids, steps):
    catcher, at = runs.RunCatcher(), 0
    for step in steps:
        catcher.append(np.array(ids[at : at + step], np.int64))
        at += step
    catcher.append(np.array(ids[at:], np.int64))
    s, e, p = catcher.runs()
    return sorted(zip(s.tolist(), (e - s).tolist(), p.tolist()))


def random_words(rng, n):
    """Words with repeats inside repeats."""
    out = []
    while len(out) < n:
        kind = rng.random()
        if kind < 0.3:
            out += [rng.randrange(3) for _ in range(rng.randrange(1, 6))]
        elif kind < 0.6:
            out += [rng.randrange(2) for _ in range(rng.randrange(1, 7))] * rng.randrange(2, 6)
        elif kind < 0.8 and out:
            out += out[-rng.randrange(1, min(len(out), 40) + 1) :] * rng.randrange(1, 3)
        else:
            out += [rng.randrange(1000)]
    return out[:n]


@pytest.mark.parametrize("seed", range(40))
def test_runs_equal_brute_force_however_words_arrive(seed):
    rng = random.Random(seed)
    ids = random_words(rng, rng.choice([1, 5, 30, 200, 700]))
    want = brute(ids)
    assert caught(ids, []) == want
    assert caught(ids, [1] * min(len(ids), 300)) == want
    assert caught(ids, [rng.randrange(0, 60) for _ in range(8)]) == want


@pytest.mark.parametrize("make", ["one word", "two words", "fibonacci", "thue morse", "long period"])
def test_structured_words(make):
    if make == "one word":
        ids = [7] * 3000
    elif make == "two words":
        ids = [1, 2] * 1000 + [3] + [1, 2] * 1000
    elif make == "fibonacci":
        a, b = [0], [0, 1]
        while len(b) < 1500:
            a, b = b, b + a
        ids = b
    elif make == "thue morse":  # equal sums modulo 2**64 for any base without word hashes
        ids = [bin(i).count("1") % 2 for i in range(4096)]
    else:
        ids = list(range(5000)) * 2 + list(range(100))
    want = [(0, 3000, 1)] if make == "one word" else [(0, 10100, 5000)] if make == "long period" else brute(ids)
    assert caught(ids, []) == want


def test_separators_break_runs():
    assert caught([5] * 20 + [-1] + [5] * 20 + [-1] + [-1, -1, -1] * 8 + [5] * 4, []) == [(0, 20, 1), (21, 20, 1)]


def test_colliding_sums_are_compared_word_by_word(monkeypatch):
    """With hashes that say equal for all, only true runs are reported."""
    rng = random.Random(3)
    ids = random_words(rng, 60)
    monkeypatch.setattr(runs, "_mixed", lambda ids: np.ones(len(ids), np.uint64))
    got = caught(ids, [])
    assert set(got) <= set(brute(ids))


def expected(rows):
    out = []
    for doc_id, text in rows:
        words = (text or "").encode().split()
        n, h = len(words), None if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h is not None and h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = brute(words)
        top = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else (None, None, None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
        kept = [w for i, w in enumerate(words) if not any(s + q <= i < s + m for s, m, q in found)]
        out.append(
            (
                doc_id, len(found), *top, None if not found else 1000 * top[1] // top[2],
                hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
            )
        )
    return sorted(out, key=str)


def test_digests_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(runs, "GROUP_BYTES", 3000)
    rng = random.Random(1)
    texts = [" ".join(f"w{w}" for w in random_words(rng, rng.choice([0, 1, 11, 12, 80, 300]))) for _ in range(150)]
    texts += [None, "", " \t\n", "a\x1cb " * 30, "é   x\v" * 40, "same text " * 9, "same text " * 9]
    rows = [*enumerate(texts), (3, texts[3]), (None, texts[90]), (None, None)]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4, 5) for i, t in rows], SCHEMA)
    got = runs.run_digests(runs.word_runs(df, rewrite=runs.made_periodic, keep_text=False)).collect()
    assert sorted((tuple(r) for r in got), key=str) == expected(rows)
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in enumerate(texts)) > 5


def test_collapsed_text_and_long_documents(spark):
    long = "begin " + "very long period of words " * 6000 + "end"
    df = spark.createDataFrame([(1, "so " * 13 + "good", 1, 2, 3, 4, 5), (2, long, 1, 2, 3, 4, 5)], SCHEMA)
    got = {r.id: r for r in runs.word_runs(df).collect()}
    assert bytes(got[1].collapsed) == b"so good" and got[1].n_words == 14
    assert bytes(got[2].collapsed) == b"begin very long period of words end"
    assert [tuple(r) for r in got[2].runs] == [(1, 30000, 5)]


def test_empty_table(spark):
    assert runs.run_digests(runs.word_runs(spark.createDataFrame([], SCHEMA))).count() == 0
