import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lexisieve.llm import bpe, jaccard, mixing, quality, secrets
from lexisieve.session import materialize
from test_jaccard import brute_force
from test_quality import brute_force as quality_counts
from texts import prose


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {"documents": docs.cache()}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir).cache()
        docs.count()
        out[name] = docs
    return out


def ids(df):
    return {r.doc_id for r in df.select("doc_id").collect()}


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    for name in names[:-1]:
        assert stages[name].columns == stages["documents"].columns
        assert dict(stages[name].dtypes) == dict(stages["documents"].dtypes)


def test_quality_stage_applies_the_verdicts(stages):
    kept = ids(stages["quality_rules"])
    for r in stages["documents"].collect():
        if quality_counts(r.text)[-1]:
            assert r.doc_id not in kept
    verdicts = quality.quality_verdicts(stages["documents"], ["doc_id"]).filter("kept")
    assert kept == {r.kept_columns.doc_id for r in verdicts.collect()}


def test_one_document_of_each_group_stays(stages):
    rows = [(r.doc_id, r.text) for r in stages["quality_rules"].collect()]
    assert ids(stages["near_copies"]) == {d for d, (_, c) in brute_force(rows).items() if c == d}


def test_secrets_are_gone_and_documents_stay(stages):
    assert ids(stages["secret_scans"]) == ids(stages["near_copies"])
    found = secrets.scan_secrets(stages["near_copies"]).filter("secret").collect()
    after = {r.doc_id: r for r in stages["secret_scans"].collect()}
    assert all(f.value not in after[f.doc_id].text for f in found)
    assert all(r.n_chars == len(r.text) for r in after.values())


def test_mixture_follows_probabilities(stages):
    docs = stages["secret_scans"].select(
        "doc_id", "source", "lang", mixing.topic_of(F.col("text")).alias("topic"),
        mixing.token_count(F.col("text")).alias("n_tokens"),
    )
    want = mixing.mixture(docs, corpus_pipeline.MIXTURE).filter("kept")
    assert ids(stages["mixture"]) == ids(want) and want.count() > 0


def test_ids_decode_to_the_texts(stages):
    rows = stages["token_ids"].collect()
    texts = {r.doc_id: r.text for r in stages["mixture"].collect()}
    pairs = bpe.load(public_tokenizers.path(corpus_pipeline.RANKS), public_tokenizers.PATTERN)
    assert len(rows) == len(texts)
    for r in rows:
        assert r.intact and r.n_tokens == len(r.ids)
        assert b"".join(pairs.bytes_of[i] for i in r.ids).decode() == texts[r.doc_id]


def test_run_equals_the_stages(spark, sf_dir, stages):
    assert ids(corpus_pipeline.run(spark, sf_dir)) == ids(stages["token_ids"])
    assert jaccard.PERCENT == 80 and jaccard.WORDS == 5


def test_stages_on_odd_rows(spark, make_docs):
    """Null and empty texts, repeated rows, nulls in all columns, a very long text, clashing names."""
    key = "AKIA" + "ABCDEFGH23456722"
    texts = [None, "", f"{prose(120, 1)} {key}", prose(120, 2), prose(120, 2), prose(24_000, 3), prose(90, 4)]
    docs = make_docs(texts)
    docs = docs.union(docs.filter("doc_id = 6"))
    nowhere = make_docs([prose(80, 9)], lang=None, source=None, first=50)
    docs = docs.union(nowhere).union(nowhere.withColumn("doc_id", F.lit(None).cast("bigint")))
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = materialize(stage(spark, docs, ""))
        if name != "token_ids":
            assert after.columns == docs.columns, name
        kept[name] = sorted(r.doc_id if r.doc_id is not None else -1 for r in after.select("doc_id").collect())
        docs = after if name != "mixture" else docs  # the encoder gets the texts that were not sampled too
    assert kept["quality_rules"] == [-1, 2, 3, 4, 5, 6, 6, 50]
    assert kept["near_copies"] == [-1, 2, 3, 5, 6, 6, 50] == kept["secret_scans"]
    assert set(kept["mixture"]) <= set(kept["secret_scans"])
    assert kept["token_ids"] == kept["secret_scans"]
    rows = after.collect()
    assert all(r.intact for r in rows)
    assert max(r.n_tokens for r in rows) > 24_000


def test_stages_on_an_empty_table(spark, make_docs):
    docs = make_docs([])
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, ""))
        assert docs.count() == 0, name
