import random

from pyspark.sql import functions as F
from texts import prose

from lexisieve.llm import secrets


def corpus(n, seed):
    """Texts, and the spans of what is secret in them."""
    rng = random.Random(seed)
    texts, spans = [], []
    hexes = lambda k: "".join(rng.choice("0123456789abcdef") for _ in range(k))
    for i in range(n):
        secret = [f"AKIA{''.join(rng.choice('ABCDEFGHIJ234567') for _ in range(16))}", hexes(40), hexes(18), None, None][i % 5]
        lead = ["", 'token = "', "password=", "", ""][i % 5]
        text = f"é {prose(20, seed + i)} {lead}"
        if secret:
            spans.append({(len(text), len(text) + len(secret))})
            text += secret + ('"' if lead.endswith('"') else "")
        else:
            spans.append(set())
            text += ["", str(rng.randrange(10**15, 10**16)), "internationalisationrecommendations"][i % 3]
        texts.append(f"{text} {prose(10, seed + n + i)}")
    return texts, spans


def test_secrets_are_found_and_false_positives_removed(make_docs):
    texts, spans = corpus(200, 1)
    texts += [None, "", "password", "password=", prose(20_000, 5)]
    docs = make_docs(texts)
    found = secrets.scan_secrets(docs)
    got = {}
    for r in found.filter("secret").collect():
        got.setdefault(r.doc_id, set()).add((r.start, r.end))
    assert got == {i: s for i, s in enumerate(spans) if s}
    assert found.filter("not secret").count() > 20
    clean = secrets.redact(docs, found)
    assert clean.columns == docs.columns and clean.count() == len(texts)
    after = {r.doc_id: r.text for r in clean.collect()}
    for i, text in enumerate(texts):
        want = text
        for a, b in sorted(got.get(i, ()), reverse=True):
            want = want[:a] + "[SECRET]" + want[b:]
        assert after[i] == want


def test_held_out_accuracy(make_docs):
    train, _ = corpus(300, 11)
    test, _ = corpus(200, 5000)
    words = secrets.dictionary(make_docs(train), 500)
    labelled = [
        secrets.label_findings(secrets.scan(make_docs(t), words=words)).withColumn("x", secrets._features())
        for t in (train, test)
    ]
    model = secrets.fit(labelled[0])
    held = labelled[1].filter("label IS NOT NULL").withColumn("v", secrets.array_to_vector("x"))
    right = model.transform(held).agg(F.avg((F.col("prediction") == F.col("label")).cast("int"))).first()[0]
    assert right >= 0.95


def test_one_label_or_no_rows(make_docs):
    only = secrets.scan_secrets(make_docs(["token = abcdef0123456789", "nothing here"])).collect()
    assert [(r.doc_id, r.score, r.secret) for r in only] == [(0, 1.0, True)]
    assert secrets.scan_secrets(make_docs([])).count() == 0
    docs = make_docs([])
    assert secrets.redact(docs, secrets.scan_secrets(docs)).count() == 0


def test_candidates():
    found = secrets.find_candidates('x api_key: "s3cr3t-value" 4111111111111111 password = hunter2! plain')
    assert [(f[2], f[4]) for f in found] == [("api_key", True), ("", False), ("password", True)] or [
        f[4] for f in found
    ] == [True, False, True]


def test_assigned_values_are_candidates_whole():
    jwt = "eyJhbGciOiJIUzI1NiJ9.eyJzdWIiOiIxMjM0NTY3ODkwIn0.dozjgNryP4J3jVmNHl0w5N_XgL0n3I9P"
    values = ["Xk!9dk2lsm4QpZ81", jwt, "https://u:p4ss@host.example/path12345678?q=1", "a$b#c%1234567890x"]
    for value in values:
        text = f"id 1234567890123 password = {value} then abcdefghij0123456789"
        found = secrets.find_candidates(text)
        assert [(text[a:b], assigned) for a, b, _, _, assigned in found] == [
            ("1234567890123", False), (value, True), ("abcdefghij0123456789", False)
        ]
        assert found[1][2] == "password"


def test_uuids_digests_and_timestamps_are_negatives_unless_assigned(make_docs):
    values = ["123e4567-e89b-12d3-a456-426614174000", "d41d8cd98f00b204e9800998ecf8427e", "2024-05-06T070809Z"]
    docs = make_docs([f"see {v} here" for v in values] + [f"token = {v}" for v in values])
    labels = {r.doc_id: r.label for r in secrets.label_findings(secrets.scan(docs)).collect()}
    assert labels == {0: 0.0, 1: 0.0, 2: 0.0, 3: 1.0, 4: 1.0, 5: 1.0}


def findings_of(spark, n, seed):
    """Mixed values that no rule decides: secrets after one kind of word, commit ids after another."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        value = "".join(rng.choice("abcdefghij0123456789") for _ in range(rng.choice([18, 20, 22])))
        secret = rng.random() < 0.5
        before = rng.choice(["bearer", "auth"]) if secret else rng.choice(["commit", "build"])
        rows.append((i, "src/config.py" if secret else "CHANGELOG", f"{before} {value} {rng.choice(['ok', 'end'])}", float(secret)))
    return spark.createDataFrame(rows, "doc_id bigint, source string, text string, truth double")


def test_the_forest_decides_what_rules_leave_open(spark):
    docs = findings_of(spark, 600, 3)
    found = secrets.scan(docs)
    assert secrets.label_findings(found).filter("label IS NOT NULL").count() == 0
    labelled = found.join(docs.select("doc_id", F.col("truth").alias("label")).filter("doc_id < 400"), "doc_id")
    scored = secrets.scan_secrets(docs, labelled=labelled)
    truth = {r.doc_id: r.truth == 1 for r in docs.collect()}
    right = [truth[r.doc_id] == r.secret for r in scored.collect()]
    assert len(right) == 600 and sum(right) >= 0.95 * 600
    judged = secrets.held_out(scored.drop("label").join(labelled.select("doc_id", "label"), "doc_id")).first()
    assert judged.findings == 400 and judged.precision >= 0.9 and judged.recall >= 0.9


def test_no_forest_scores_what_it_was_fitted_on(spark):
    """Labels drawn at random cannot be learned: held out, they are guessed no better than by chance."""
    docs = findings_of(spark, 500, 4)
    found = secrets.scan(docs).drop("before", "path").withColumns({"before": F.lit("x"), "path": F.lit("y")})
    noise = found.withColumn("label", F.pmod(F.xxhash64("value", F.lit("noise")), F.lit(2)).cast("double"))
    scored = secrets.score(noise.withColumn("x", secrets._features()), noise.withColumn("x", secrets._features()))
    hits = scored.agg(F.avg((F.col("secret") == (F.col("label") == 1)).cast("int"))).first()[0]
    assert hits < 0.65


def test_redact_with_clashing_names(make_docs):
    docs = make_docs(["token = abcdef0123456789 end", "plain", None])
    docs = docs.withColumns({name: F.lit("clash") for name in ("_id", "_spans", "start", "end", "secret")})
    done = secrets.redact(docs, secrets.scan_secrets(docs))
    assert done.columns == docs.columns
    assert {r.doc_id: r.text for r in done.collect()} == {0: "token = [SECRET] end", 1: "plain", 2: None}


def test_a_worker_holds_few_texts_and_frees_them(monkeypatch):
    """A batch is scanned in parts, and nothing of it is kept by a worker that waits for other work."""
    import pyarrow as pa

    class Docs:
        def select(self, *columns):
            return self

        def mapInArrow(self, run, schema):
            return run

    freed = []
    monkeypatch.setattr(secrets, "free_memory", lambda: freed.append(pa.total_allocated_bytes()))
    monkeypatch.setattr(secrets, "F", type("Functions", (), {"col": staticmethod(lambda name: type("C", (), {"cast": lambda s, t: s})())}))
    run, before = secrets.scan(Docs()), pa.total_allocated_bytes()
    n = 3 * secrets.CHUNK + 1
    texts = [f"token = abc{i}def123456 {'x ' * 500}" for i in range(n)]
    whole = pa.record_batch([pa.array(range(n)), pa.array(["p"] * n), pa.array(texts)], names=["d", "s", "t"])
    given, size = iter([whole]), whole.nbytes
    del whole
    rows = [len(part) for part in run(given)]
    assert sum(rows) == n and len(rows) == 4
    assert len(freed) == 1 and freed[0] - before < size / 4
