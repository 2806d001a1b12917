import re

from texts import prose

from lexisieve.llm import licenses

GRANT = dict(licenses.TEMPLATES[::-1])["mit"], licenses.TEMPLATES[3][1]


def words_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def brute_blocks(texts, threshold=0.8):
    out, met = set(), set()
    for t in licenses.templates(threshold):
        size = licenses.block_size(t)
        for doc, text in enumerate(texts):
            w = words_of(text)
            for start in range(len(w)):
                shared = len(set(w[start : start + size]) & set(t.words))
                if shared >= t.need:
                    met.add((doc, t.number, shared))
                if shared >= t.need and w[start] in t.words:
                    out.add((doc, t.number, start, round(shared / len(t.words), 9)))
    # blocks that start elsewhere meet no other template, nor any better
    best = {(doc, n): max(s for d, m, s in met if (d, m) == (doc, n)) for doc, n, _ in met}
    count = {t.number: len(t.words) for t in licenses.templates(threshold)}
    assert {(d, n, round(s / count[n], 9)) for (d, n), s in best.items()} <= {(d, n, c) for d, n, _, c in out}
    return out


def brute_places(text):
    w = words_of(text)
    return [
        (label, i)
        for phrase, label in licenses.PHRASES.items()
        for i in range(len(w))
        if w[i : i + len(phrase.split())] == phrase.split()
    ]


def test_scan_equals_brute_force(make_docs):
    grant = licenses.TEMPLATES[3][1]
    lead = grant.split()
    texts = [
        None, "", "license", "MIT License, MIT-license; the Apache\nLicense", "GNU General Public License",
        f"{prose(200, 1)} {grant.upper()} {prose(90, 2)}", " ".join(lead[: len(lead) * 9 // 10]),
        " ".join(lead[: len(lead) // 2]), f"{prose(31, 3)} {licenses.TEMPLATES[6][1]}", "Ärger mit license",
        "released under the BSD license", "Released under the MIT License.", prose(5000, 4),
        f"{prose(700, 5)} {licenses.TEMPLATES[10][1]} {prose(300, 6)}", " ".join(t for _, t in licenses.TEMPLATES),
    ]
    docs = make_docs(texts)
    documents, blocks = licenses.license_scan(docs.union(docs.filter("doc_id = 3")))
    want = brute_blocks(texts)
    assert {(r.doc_id, r.template, r.start, round(r.containment, 9)) for r in blocks.collect()} == want
    label_of = {i: label for i, (label, _) in enumerate(licenses.TEMPLATES)}
    for r in documents.collect():
        places = brute_places(texts[r.doc_id])
        base = {label for label, _ in places}
        mine = [(n, c) for d, n, _, c in want if d == r.doc_id]
        assert r.n_words == len(words_of(texts[r.doc_id])) and r.n_base == len(places)
        starts = [i for _, i in places]
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert r.base_labels == ",".join(sorted(base))
        assert r.labels == ",".join(sorted(base | {label_of[n] for n, _ in mine}))
        assert round(r.score, 9) == max([c for _, c in mine], default=0)


def test_empty_table(make_docs):
    documents, blocks = licenses.license_scan(make_docs([]))
    assert documents.count() == 0 and blocks.count() == 0


def test_a_notice_spread_off_any_grid_is_found(make_docs):
    """Words put between those of a notice, and some left out: no block on a fixed grid holds enough."""
    notice = licenses.TEMPLATES[3][1].split()
    spread = " ".join(f"{w} x{i}" for i, w in enumerate(notice) if i % 14 != 5)
    texts = [f"{prose(n, n)} {spread} {prose(50, n + 1)}" for n in (3, 17, 29, 33, 47)]
    documents, blocks = licenses.license_scan(make_docs(texts))
    assert {(r.doc_id, r.template, r.start, round(r.containment, 9)) for r in blocks.collect()} == brute_blocks(texts)
    assert all("mit" in r.labels for r in documents.collect())
