import random

import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lexisieve.functions.measures import SURFACE_FEATURES
from lexisieve.functions.normalize import with_base_text, with_clean_text
from lexisieve.operators import features as X
from lexisieve.plans import classifier as C
from lexisieve.plans import stages as S
from lexisieve.session import materialize

WORDS = {0: "invoice server budget parcel", 1: "wonderful film great acting", 2: "boring film awful never good"}


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [
        (i, i % 3, " ".join(rng.choice(WORDS[i % 3].split()) for _ in range(9)) + rng.choice(["!!", " &amp; <b>more</b>", ""]))
        for i in range(60)
    ]
    return spark.createDataFrame([*data, (60, 1, None)], "row_idx long, LABEL int, TEXT string").cache()


@pytest.fixture(scope="module")
def model(spark, rows, tmp_path_factory):
    stages = [
        S.TextCleaner(inputCol="TEXT", outputCol="base_text", form="base"),
        S.TextCleaner(inputCol="TEXT", outputCol="clean_text", form="clean"),
        S.TextCleaner(inputCol="TEXT", outputCol="negation_text", form="negation"),
        S.SurfaceScaler(inputCol="base_text", outputCol="surface"),
        S.TermWeights(inputCol="clean_text", outputCol="terms"),
        S.TwoStageHinge(inputCol="TEXT", labelCol="LABEL", predictionCol="pred", maxPasses=20),
    ]
    path = str(tmp_path_factory.mktemp("ml"))
    pipeline = Pipeline(stages=stages)
    pipeline.write().overwrite().save(f"{path}/pipeline")
    fitted = Pipeline.load(f"{path}/pipeline").fit(rows)
    fitted.write().overwrite().save(f"{path}/model")
    return fitted, PipelineModel.load(f"{path}/model")


def told(df, *columns):
    return {r.row_idx: tuple(r[c] for c in columns) for r in df.select("row_idx", *columns).collect()}


def test_a_loaded_pipeline_gives_what_the_functions_give(rows, model):
    fitted, loaded = model
    got = loaded.transform(rows)
    assert got.columns[:3] == rows.columns and got.count() == rows.count()
    base = with_base_text(rows, "TEXT")
    assert told(got, "base_text") == told(base, "base_text")
    assert told(got, "clean_text") == told(with_clean_text(base), "clean_text")
    assert told(got, "negation_text") == told(with_clean_text(base, negation=True), "clean_text")
    surface = X.scaled_surface(base, X.surface_scale(base))
    vectors = told(got.withColumn("surface", vector_to_array("surface")), "surface")
    for i, values in told(surface, *SURFACE_FEATURES).items():
        assert vectors[i][0] == pytest.approx(list(values))
    clean = with_clean_text(base)
    terms = materialize(X.document_terms(clean, {"word": (1, 2), "char": (3, 5)}))
    counts = materialize(X.document_frequency(terms))
    vocab = X.vocabulary(counts, rows.agg(F.count("*")).scalar(), {"word": 2, "char": 3}, {"word": 0.95})
    want = {(r.row_idx, r.branch, r.term): r.weight for r in X.tfidf(terms, vocab, counts).collect()}
    mine = {(i, t.branch, t.term): t.weight for i, (found,) in told(got, "terms").items() for t in found}
    assert mine == pytest.approx(want)
    assert told(got, "terms")[60] == ([],)


def test_predictions_survive_saving(rows, model):
    fitted, loaded = model
    assert told(fitted.transform(rows), "pred") == told(loaded.transform(rows), "pred")
    direct = C.predict(C.prepare(rows), fitted.stages[-1].fitted)
    assert told(loaded.transform(rows), "pred") == {r.row_idx: (float(r.pred),) for r in direct.collect()}
    right = loaded.transform(rows).filter("pred = LABEL").count()
    assert right >= 50


def test_unknown_form_is_an_error(rows):
    with pytest.raises(ValueError, match="form"):
        S.TextCleaner(form="upper").transform(rows)
