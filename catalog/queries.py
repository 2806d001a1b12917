"""Every checked query: ``name -> (spark, sf_dir) -> DataFrame``.

Queries read the given tables whole. Doubles are rounded and counts are bigint so
that an independent SQL engine can be compared by value.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalog import views as V
from lexisieve.functions import normalize as N
from lexisieve.functions import tokens as T
from lexisieve.functions.measures import surface_features as surface_columns
from lexisieve.operators import contracts as K
from lexisieve.operators import dedup as D
from lexisieve.operators import evaluate as E
from lexisieve.operators import features as X
from lexisieve.operators import labels as L
from lexisieve.operators import sketches as Q
from lexisieve.operators import split as S
from lexisieve.plans import classifier as C
from lexisieve.plans import report as R
from lexisieve.plans import workflow as W
from lexisieve.session import materialize, store_bucketed, work_dir
from lexisieve.sources.csv import read_csv

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _round(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles rounded, integers as bigint, the rest as it is."""

    def shaped(name: str, kind: str) -> Column:
        if kind in ("double", "float"):
            return F.round(F.col(name).cast("double"), places).alias(name)
        return F.col(name).cast("bigint").alias(name) if kind in ("int", "tinyint") else F.col(name)

    return df.select(*[shaped(n, t) for n, t in df.dtypes])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# --- sources, contracts -----------------------------------------------------


@query
def scan_corpus(spark: SparkSession, d: str) -> DataFrame:
    return V.texts(spark, d)


@query
def csv_round_trip(spark, d):
    """Documents written as CSV, with cells that mean a missing value, and read back."""
    i = F.col("row_idx")
    rows = V.decor(spark, d).select(
        "ID", F.when(i % 13 == 3, "n/a").otherwise(F.col("TEXT")).alias("TEXT"), i.alias("place")
    )
    path = f"{work_dir(spark)}/csv-{uuid.uuid4().hex}"
    rows.write.option("header", True).option("escape", '"').option(
        "ignoreLeadingWhiteSpace", False
    ).option("ignoreTrailingWhiteSpace", False).csv(path)
    return read_csv(spark, path).select("ID", "TEXT", F.col("place").cast("bigint").alias("row_idx"))


@query
def submission_csv(spark, d):
    """A submission as one CSV file, read back with its order."""
    i = F.col("row_idx")
    path = f"{work_dir(spark)}/submission-{uuid.uuid4().hex}"
    W.write_submission(V.test_ids(spark, d).select("row_idx", "ID", (i % 3).cast("int").alias("LABEL")), path, one_file=True)
    return read_csv(spark, path).select("ID", "LABEL", "row_idx")


@query
def column_report(spark, d):
    """Columns of the given tables against what a corpus of labelled texts would have."""
    tables = {name: V.table(spark, d, name) for name in ("documents", "labels", "benchmark")}
    expected = {"documents": ["doc_id", "text", "label"], "labels": tables["labels"].columns, "benchmark": ["text", "item_id"]}
    return K.column_report(tables, expected)


def _some_labels(spark, d) -> DataFrame:
    """Documents with label texts of every kind a reader may meet."""
    i = F.col("row_idx")
    raw = (
        F.when(i % 11 == 0, "x").when(i % 11 == 1, "1.5").when(i % 11 == 2, "7")
        .when(i % 11 == 3, F.lit(None)).when(i % 11 == 4, "2.0").when(i % 11 == 5, " 1")
        .when(i % 11 == 6, "nan").when(i % 11 == 7, "inf").otherwise((i % 3).cast("string"))
    )
    return V.documents(spark, d).select("ID", "row_idx", raw.alias("LABEL"))


@query
def validate_ids(spark, d):
    tables = {"documents": "doc_id", "conversations": "conv_id", "lineitem": "l_orderkey", "pages": "url"}
    return _union(
        [
            K.id_problems(V.table(spark, d, name).select(F.col(col).cast("string").alias("ID"))).select(
                F.lit(name).alias("source"), "missing", "blank", "duplicates"
            )
            for name, col in tables.items()
        ]
    )


@query
def validate_labels(spark, d):
    return K.label_problems(_some_labels(spark, d))


@query
def numeric_coerce(spark, d):
    number = L.finite(L.to_number(F.col("LABEL")))
    return _some_labels(spark, d).select("row_idx", number.alias("number"))


@query
def label_names(spark, d):
    return _some_labels(spark, d).select(
        "row_idx", L.label_name(L.to_number(F.col("LABEL"))).alias("label_meaning")
    )


@query
def id_alignment(spark, d):
    everything, labelled = V.documents(spark, d), V.train_ids(spark, d)
    aligned = K.id_alignment(V.sample(spark, d), V.test_ids(spark, d))
    return aligned.withColumn("pair", F.lit("sample/test")).unionByName(
        K.id_alignment(everything, labelled).withColumn("pair", F.lit("documents/train"))
    )


@query
def label_conflicts(spark, d):
    return D.label_conflicts(V.conflict(spark, d)).withColumn(
        "labels", F.array_join(F.col("labels").cast("array<string>"), ",")
    )


@query
def conflict_examples(spark, d):
    """The first conflicts in source order, as an error message shows them."""
    return D.conflict_examples(D.label_conflicts(V.conflict(spark, d))).withColumn(
        "labels", F.array_join(F.col("labels").cast("array<string>"), ",")
    )


@query
def validate_submission(spark, d):
    test = V.test_ids(spark, d)
    i = F.col("row_idx")
    good = test.select("row_idx", "ID", (i % 3).cast("string").alias("LABEL"))
    bad = test.filter(i % 5 > 0).select(
        "row_idx", "ID", F.when(i % 97 != 5, (i % 4).cast("string")).alias("LABEL")
    )
    return _union(
        [
            K.submission_checks(table, test).withColumn("which", F.lit(name))
            for name, table in (("good", good), ("bad", bad))
        ]
    )


# --- duplicates, overlap, labels ----------------------------------------------


@query
def duplicate_key(spark, d):
    return N.with_duplicate_key(V.decor(spark, d)).select("row_idx", "duplicate_key")


@query
def eda_key(spark, d):
    return V.decor(spark, d).select("row_idx", N.report_key(F.col("TEXT")).alias("eda_key"))


@query
def duplicate_stats(spark, d):
    return _union(
        [
            D.duplicate_stats(D.key_groups(D.keyed(df.select("row_idx", "TEXT")))).withColumn(
                "split", F.lit(name)
            )
            for name, df in (("train", V.train(spark, d)), ("test", V.test(spark, d)))
        ]
    )


@query
def train_minus_overlap(spark, d):
    return _round(D.without_overlap(V.train(spark, d), V.test(spark, d)))


@query
def train_test_overlap(spark, d):
    def groups(df):
        return D.key_groups(D.keyed(df.select("row_idx", "TEXT")))

    return D.overlap_stats(groups(V.train(spark, d)), groups(V.test(spark, d)))


@query
def dedup_keep_first(spark, d):
    return D.keep_first(V.texts(spark, d))


@query
def clean_train(spark, d):
    return _round(D.clean_train(V.train(spark, d), V.test(spark, d)))


@query
def unique_test(spark, d):
    return D.keep_first(V.test(spark, d))


@query
def cleaning_summary(spark, d):
    return D.cleaning_summary(V.train(spark, d), V.test(spark, d))


@query
def expand_predictions(spark, d):
    test = V.test(spark, d)
    unique = D.keep_first(test).select("row_idx", (F.col("row_idx") % 3).alias("LABEL"))
    return D.expand_by_key(test, unique, "LABEL").select("ID", "row_idx", "LABEL")


@query
def label_counts(spark, d):
    clean = D.clean_train(V.train(spark, d), V.test(spark, d))
    return _round(L.label_counts(clean))


@query
def label_distribution(spark, d):
    return _round(L.label_distribution(_some_labels(spark, d)))


@query
def label_integrity(spark, d):
    return L.label_integrity(_some_labels(spark, d))


@query
def unexpected_labels(spark, d):
    return L.unexpected_labels(_some_labels(spark, d))


@query
def stratified_split(spark, d):
    return _round(S.with_holdout(V.train_ids(spark, d).select("ID", "row_idx", "LABEL")))


@query
def id_overlap(spark, d):
    left = V.documents(spark, d).select("ID")
    right = V.table(spark, d, "pages").select(F.col("page_id").cast("string").alias("ID"))
    return left.intersect(right)


# --- report -------------------------------------------------------------------


def _tables(spark, d) -> dict[str, DataFrame]:
    return {
        "train": V.train(spark, d).select("row_idx", "ID", "TEXT", "LABEL"),
        "test": V.decor(spark, d).select("row_idx", "ID", "TEXT"),
        "sample_submission": V.sample(spark, d).select("row_idx", "ID", "LABEL"),
    }


@query
def overview(spark, d):
    return _round(R.overview(_tables(spark, d)))


@query
def missing_report(spark, d):
    return _round(R.missing_report(_tables(spark, d)))


@query
def id_report(spark, d):
    i = F.col("row_idx")
    some = V.sample(spark, d).filter(i % 7 > 0).withColumn(
        "ID", F.when(i % 10 == 3, F.concat(F.lit("x"), "ID")).otherwise(F.col("ID"))
    )
    return R.id_report(V.train_ids(spark, d), V.test_ids(spark, d), some)


@query
def text_features(spark, d):
    return _round(R.text_features(V.decor(spark, d), "test"))


@query
def num_by_split(spark, d):
    features = R.text_features(V.train(spark, d), "train").unionByName(
        R.text_features(V.test(spark, d), "test")
    )
    return _round(R.summarize_numeric(features, ["split"]))


@query
def num_by_label(spark, d):
    features = R.labelled(R.text_features(V.train(spark, d), "train", keep=("LABEL",)))
    return _round(R.summarize_numeric(features, ["LABEL", "label_meaning"]))


@query
def binary_by_label(spark, d):
    decor = V.decor(spark, d).join(V.labels(spark, d), "row_idx", "left")
    features = R.labelled(R.text_features(decor, "train", keep=("LABEL",)))
    return _round(R.summarize_binary(features))


@query
def duplicate_summary(spark, d):
    train = V.decor(spark, d).join(V.labels(spark, d), "row_idx", "left")
    summary = R.duplicate_summary(train.select("TEXT", "LABEL"), V.test(spark, d).select("TEXT"))
    cells = {c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("train_row_count", "test_row_count")}
    return summary.withColumns(cells)  # a count that does not apply is an empty cell


def _feature_values(spark, d) -> DataFrame:
    """Numeric measures of every document in long form, with a part to merge over."""
    features = R.text_features(V.texts(spark, d), "all", keep=("row_idx",))
    part = F.pmod("row_idx", F.lit(8)).cast("int")
    return features.withColumn("part", part).unpivot(["part"], R.NUMERIC_MEASURES, "feature", "value")


@query
def sketched_quantiles(spark, d):
    """Values, and whether ranks of merged sketches' quantiles are within the stated error."""
    long = materialize(_feature_values(spark, d))
    merged = Q.merge_quantiles(Q.quantile_sketches(long, ["feature", "part"], "value"), ["feature"])
    told = Q.sketched_quantiles(merged, {"median": 0.5, "p90": 0.9})
    # a value may have many rows: its ranks reach from those below it to those up to it
    ranks = long.join(F.broadcast(told), "feature").groupBy("feature").agg(
        F.first("count").alias("count"),
        *[
            F.avg(F.expr(f"CAST(value {sign} {name} AS INT)")).alias(f"{name}_{side}")
            for name in ("median", "p90")
            for sign, side in (("<", "low"), ("<=", "high"))
        ],
    )

    def within(name: str, share: float) -> Column:
        error = Q.rank_error()
        return (F.col(f"{name}_low") <= share + error) & (F.col(f"{name}_high") >= share - error)

    return ranks.select(
        "feature", "count", within("median", 0.5).alias("median_within"), within("p90", 0.9).alias("p90_within")
    )


@query
def sketched_distinct(spark, d):
    """Distinct values of some columns, exact, and whether merged sketches tell them within the error."""
    columns = {"lineitem": "l_partkey", "orders": "o_custkey", "documents": "text", "pages": "url"}
    values = _union(
        [
            V.table(spark, d, name).select(
                F.lit(f"{name}.{col}").alias("column"), F.col(col).cast("string").alias("value")
            )
            for name, col in columns.items()
        ]
    ).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(8)))
    merged = Q.merge_distinct(Q.distinct_sketches(values, ["column", "part"], "value"), ["column"])
    exact = values.groupBy("column").agg(F.count_distinct("value").alias("distinct_values"))
    told = Q.sketched_distinct(merged).withColumnRenamed("distinct_values", "told")
    close = F.abs(F.col("told") - F.col("distinct_values")) <= F.ceil(F.col("distinct_values") * Q.distinct_error())
    return exact.join(told, "column").select("column", "distinct_values", close.alias("within"))


# --- text steps ---------------------------------------------------------------


def _step(spark, d, steps, out):
    return N.with_steps(V.decor(spark, d), "TEXT", out, [N.text_or_empty, *steps]).select("row_idx", out)


@query
def html_text(spark, d):
    pages = V.pages(spark, d)
    steps = [N.text_or_empty, N.unescape_html, N.strip_tags]
    return N.with_steps(pages, "html", "html_text", steps).select("page_id", "html_text")


@query
def page_base_text(spark, d):
    pages = V.pages(spark, d)
    return N.with_base_text(pages, "html").select("page_id", "base_text")


@query
def char_fold(spark, d):
    return _step(spark, d, [N.fold_typography], "char_fold")


@query
def base_text(spark, d):
    return N.with_base_text(V.decor(spark, d)).select("row_idx", "base_text")


@query
def mask_email_url(spark, d):
    return _step(spark, d, [N.mask_email, N.mask_url], "mask_email_url")


@query
def contractions(spark, d):
    return _step(spark, d, [N.expand_listed_contractions, N.expand_other_negations], "contractions")


@query
def ratings(spark, d):
    return _step(spark, d, N.RATING_STEPS, "ratings")


@query
def grades(spark, d):
    return _step(spark, d, [N.mark_grades], "grades")


@query
def punct_tokens(spark, d):
    return _step(spark, d, [N.mark_punctuation_runs], "punct_tokens")


@query
def elongation(spark, d):
    return _step(spark, d, [N.shorten_elongation], "elongation")


@query
def negation_scope(spark, d):
    return _step(spark, d, N.NEGATION_STEPS, "negation_scope")


@query
def clean_text(spark, d):
    base = N.with_base_text(V.decor(spark, d))
    return N.with_clean_text(base).select("row_idx", "clean_text")


@query
def clean_text_negation(spark, d):
    base = N.with_base_text(V.decor(spark, d))
    return N.with_clean_text(base, negation=True).select("row_idx", "clean_text")


# --- features -----------------------------------------------------------------


@query
def surface_features(spark, d):
    base = N.with_base_text(V.decor(spark, d))
    return _round(
        base.select("row_idx", *[v.alias(n) for n, v in surface_columns(F.col("base_text")).items()])
    )


@query
def surface_scaled(spark, d):
    measured = X.measured_surface(N.with_base_text(V.decor(spark, d)))
    return _round(X.scaled_surface(measured, X.surface_scale(measured)))


@query
def word_tokens(spark, d):
    return V.decor(spark, d).select(
        "row_idx", F.array_join(T.word_tokens(N.text_or_empty(F.col("TEXT"))), " ").alias("tokens")
    )


@query
def word_ngrams(spark, d):
    return X.term_occurrences(V.texts(spark, d), {"word": (1, 3)}, "TEXT").select(F.col("term").alias("gram"), "n")


@query
def char_ngrams(spark, d):
    """The n-grams of each distinct word, as often as the word occurs."""
    words = V.texts(spark, d).select(F.explode(F.split(T.char_words(F.col("TEXT")), " ")).alias("word"))
    words = words.groupBy("word").agg(F.count("*").alias("words"))
    grams = words.select("words", F.explode(T.char_ngrams(F.col("word"), 3, 6)).alias("gram"))
    return grams.groupBy("gram").agg(F.sum("words").alias("n"))


def _terms(df: DataFrame, **ranges) -> X.BlockTerms:
    """N-grams of blocks, written once: they are counted, and weighed with what the counts give."""
    return X.block_terms(df, ranges, "TEXT")


def _given_terms(df: DataFrame, **ranges) -> X.BlockTerms:
    """The same of texts where they lie: they are measured, then dealt to blocks once."""
    return X.block_terms(df, ranges, "TEXT", chars=df.agg(F.sum(F.length("TEXT"))).first()[0] or 0)


def _n(df: DataFrame) -> Column:
    return df.agg(F.count("*")).scalar()


def _counts(terms: DataFrame | X.BlockTerms, min_df: dict[str, int] | None = None) -> DataFrame:
    return materialize(X.document_frequency(terms, min_df))


def _term_counts(docs: DataFrame, min_df: dict[str, int], **ranges) -> DataFrame:
    """In how many documents terms occur that reach ``min_df``; blocks of texts are counted once."""
    return _counts(X.counted_terms(docs, ranges, "TEXT"), min_df)


def _vocab(df: DataFrame, counts: DataFrame, char_min_df: int = 3) -> DataFrame:
    """A fitted vocabulary: written once, then joined."""
    return materialize(
        X.vocabulary(counts, _n(df), {"word": 2, "char": char_min_df}, {"word": 0.95})
    )


def _corpus(spark, d) -> DataFrame:
    return V.texts(spark, d).select("row_idx", "TEXT")


def _given_corpus(spark, d) -> DataFrame:
    return V.given_texts(spark, d).select("row_idx", "TEXT")


@query
def doc_freq_word(spark, d):
    docs = _corpus(spark, d)
    return _vocab(docs, _term_counts(docs, {"word": 2}, word=(1, 2))).select("term", "df")


@query
def doc_freq_char(spark, d):
    docs = _corpus(spark, d)
    return _vocab(docs, _term_counts(docs, {"char": 3}, char=(3, 5))).select("term", "df")


@query
def doc_freq_char_stage2(spark, d):
    docs = _corpus(spark, d)
    return _vocab(docs, _term_counts(docs, {"char": 2}, char=(3, 6)), 2).select("term", "df")


@query
def idf_word(spark, d):
    docs = _corpus(spark, d)
    return _round(_vocab(docs, _term_counts(docs, {"word": 2}, word=(1, 2))).select("term", "idf"))


@query
def tfidf_word(spark, d):
    docs = _given_corpus(spark, d)
    terms = _given_terms(docs, word=(1, 2))
    counts = _counts(terms, {"word": 2})
    return _round(X.tfidf(terms, _vocab(docs, counts), counts).drop("branch"), 4)


def _digest(weights: DataFrame) -> DataFrame:
    """Per document: how many terms, and sums that depend on every weight and term."""
    return weights.groupBy("row_idx").agg(
        F.count("*").alias("terms"),
        F.sum("weight").alias("weight_sum"),
        F.max("weight").alias("weight_max"),
        F.sum(F.col("weight") * F.length("term")).alias("length_sum"),
    )


@query
def tfidf_word_stage2(spark, d):
    docs = _given_corpus(spark, d)
    terms = _given_terms(docs, word=(1, 3))
    counts = _counts(terms, {"word": 2})
    return _round(_digest(X.tfidf(terms, _vocab(docs, counts), counts)), 4)


@query
def tfidf_char(spark, d):
    docs = _given_corpus(spark, d)
    terms = _given_terms(docs, char=(3, 5))
    counts = _counts(terms, {"char": 3})
    return _round(_digest(X.tfidf(terms, _vocab(docs, counts), counts)), 4)


@query
def tfidf_transform(spark, d):
    train, test = V.train(spark, d), V.test(spark, d)
    vocab = _vocab(train, _term_counts(train, {"word": 2}, word=(1, 2)))
    return _round(X.tfidf(_terms(test, word=(1, 2)), vocab).drop("branch"), 4)


def _stage_features(docs: DataFrame, config: X.StageConfig, text_col: str) -> DataFrame:
    """Per document and branch: what depends on every feature of a stage."""
    terms = X.stage_terms(docs, config, text_col)
    counts = _counts(terms)
    vocab = materialize(X.stage_vocabulary(counts, _n(docs), config))
    measured = X.measured_surface(docs)
    features = X.feature_union(measured, terms, counts, vocab, X.surface_scale(measured), config)
    digest = features.groupBy("row_idx", "branch").agg(
        F.count("*").alias("terms"), F.sum("weight").alias("weight_sum"),
        F.max("weight").alias("weight_max"),
    )
    return _round(digest, 4)


@query
def feature_union(spark, d):
    return _stage_features(C.prepare(V.decor(spark, d)), X.STAGE1, "clean_text")


@query
def feature_union_stage2(spark, d):
    return _stage_features(C.prepare(V.decor(spark, d)), X.STAGE2, "negation_text")


@query
def linear_score(spark, d):
    docs = _given_corpus(spark, d)
    terms = _given_terms(docs, word=(1, 2))
    counts = _counts(terms, {"word": 2})
    model = _vocab(docs, counts).withColumn("weight", (F.length("term") % 5 - 2).cast("double"))
    return _round(X.linear_score(terms, model, docs, 0.25, ("word",), counts), 4)


# --- evaluation ---------------------------------------------------------------


def _judged(spark, d) -> DataFrame:
    """Labels with a rule's predictions: mostly right, some one label off."""
    label, i = F.col("LABEL"), F.col("row_idx")
    return V.train_ids(spark, d).select(
        "LABEL", F.when(i % 7 == 0, (label + 1) % 3).when(i % 11 == 0, 0).otherwise(label).alias("pred")
    )


@query
def confusion_matrix(spark, d):
    return _round(E.confusion_matrix(_judged(spark, d)))


@query
def per_class_metrics(spark, d):
    return _round(E.per_class_metrics(_judged(spark, d)))


@query
def overall_metrics(spark, d):
    return _round(E.overall_metrics(_judged(spark, d)))


# --- classifier -------------------------------------------------------------------


def _formula_stage(docs: DataFrame, config: X.StageConfig) -> C.StageModel:
    """A stage whose vocabulary and scales come from ``docs`` and whose weights from a formula."""
    text_col = "negation_text" if config.negation else "clean_text"
    counts = _counts(X.stage_counted_terms(docs, config, text_col), config.min_df)
    vocab = materialize(X.stage_vocabulary(counts, _n(docs), config))
    terms = store_bucketed(
        vocab.withColumn("weight", ((F.length("term") * 7) % 5 - 2) / 10.0), C.TERM_KEY
    )
    scale = X.surface_scale(docs).first().asDict()
    surface = {name: (top, 0.05 * (i - 4) * config.surface) for i, (name, top) in enumerate(scale.items())}
    return C.StageModel(config, terms, surface, 0.1)


def _formula_model(docs: DataFrame) -> C.TwoStageModel:
    reviews = docs.filter(F.col("LABEL").isin(1, 2))
    return C.TwoStageModel(_formula_stage(docs, X.STAGE1), _formula_stage(reviews, X.STAGE2))


@query
def two_stage_predict_formula(spark, d):
    """Predictions of a saved and loaded model whose weights are a formula of the term's length: no fit."""
    path = f"{work_dir(spark)}/model-{uuid.uuid4().hex}"
    C.save(_formula_model(C.prepare(V.train(spark, d))), path)
    return _round(C.predict(C.prepare(V.test(spark, d)), C.load(spark, path)))


@query
def holdout_eval_formula(spark, d):
    """Metrics of the held-out fifth under formula weights."""
    clean = D.clean_train(V.train(spark, d), V.test(spark, d))
    docs = materialize(S.with_holdout(C.prepare(clean)))
    valid = docs.filter("is_valid")
    predicted = C.predict(valid, _formula_model(docs.filter(~F.col("is_valid"))))
    judged = valid.select("row_idx", "LABEL").join(predicted, "row_idx").select("LABEL", "pred")
    return _round(E.overall_metrics(judged))


@query
def submission_formula(spark, d):
    """Every test row's label under formula weights, each distinct text scored once."""
    train, test = V.train(spark, d), V.test(spark, d)
    model = _formula_model(C.prepare(D.clean_train(train, test)))
    return _round(W.predict_submission(test, model))


@query
def stage1_fit(spark, d):
    model = C.fit_stage(C.prepare(V.train(spark, d)), F.col("LABEL") != 0, X.STAGE1)
    return model.terms.groupBy("branch").agg(
        F.count("*").alias("terms"), F.count_if(F.col("weight") != 0).alias("weighted_terms")
    )


@query
def two_stage_fit(spark, d):
    model = C.fit(C.prepare(V.train(spark, d)))
    return _union(
        [
            s.terms.groupBy("branch")
            .agg(F.count("*").alias("terms"), F.sum("df").alias("df_sum"))
            .withColumn("task", F.lit(s.config.task))
            for s in (model.stage1, model.stage2)
        ]
    )


@query
def two_stage_predict_fitted(spark, d):
    """Labels of all test rows by a model fitted on the train rows."""
    model = C.fit(C.prepare(V.train(spark, d)))
    return C.predict(C.prepare(V.test(spark, d)), model)


@query
def submission_fitted(spark, d):
    """From raw tables to a checked submission: contracts, clean-up, fit, one label for each test row."""
    train, test = V.train(spark, d), V.test(spark, d)
    clean, _, _ = W.clean_views(train, test)
    done = W.predict_submission(test, C.fit(C.prepare(clean)))
    K.require_submission(done.withColumn("LABEL", F.col("LABEL").cast("int")), V.test_ids(spark, d))
    return done


@query
def holdout_eval_fitted(spark, d):
    """Metrics of the held-out fifth, by a model fitted on the other rows."""
    clean = D.clean_train(V.train(spark, d), V.test(spark, d))
    return E.overall_metrics(W.holdout_predictions(clean))


@query
def holdout_against_majority(spark, d):
    """Whether the model's macro F1 beats the most frequent label's on the rows it was fitted on, and
    is no worse on the held-out fifth (few rows there may hold nothing to learn)."""
    clean = D.clean_train(V.train(spark, d), V.test(spark, d))
    docs = materialize(S.with_holdout(C.prepare(clean)))
    model = C.fit(docs.filter(~F.col("is_valid")))
    scores = materialize(
        docs.select("row_idx", "LABEL", "is_valid").join(C.predict(docs, model), "row_idx")
    )

    def against(rows: DataFrame) -> tuple[Column, Column]:
        most = rows.groupBy("LABEL").count().agg(F.max_by("LABEL", F.struct("count", -F.col("LABEL"))))
        naive = E.overall_metrics(rows.select("LABEL", most.scalar().alias("pred")))
        return E.overall_metrics(rows).select("macro_f1").scalar(), naive.select("macro_f1").scalar()

    seen, seen_naive = against(scores.filter(~F.col("is_valid")))
    held, held_naive = against(scores.filter("is_valid"))
    return scores.agg(F.count_if("is_valid").alias("held_out_rows")).select(
        "held_out_rows", (seen > seen_naive).alias("beats_majority_on_fitted_rows"),
        (held >= held_naive).alias("no_worse_on_held_out_rows"),
    )
