"""The text steps, features and classifier as Spark ML stages that a `Pipeline` fits, saves and loads.

Each stage is a thin face of the functions it names: the same columns come out. Models hold
their vocabulary and weights as tables, saved as parquet beside the parameters.
"""

from __future__ import annotations

import uuid

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLReader,
    MLWritable,
    MLWriter,
)
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexisieve.functions.measures import SURFACE_FEATURES, surface_features
from lexisieve.functions.normalize import NEGATION_STEPS, with_base_text, with_clean_text, with_steps
from lexisieve.operators.features import CHAR, WORD, document_frequency, document_terms, surface_scale, tfidf, vocabulary
from lexisieve.plans import classifier
from lexisieve.session import materialize

FORMS = ("base", "clean", "negation")


class HasIdCol(Params):
    idCol = Param(Params._dummy(), "idCol", "unique integer id of a row", TypeConverters.toString)


class _TablesWriter(MLWriter):
    """Parameters as every stage, then the model's tables."""

    def __init__(self, model):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.save_tables(f"{path}/tables")


class _TablesReader(MLReader):
    def __init__(self, kind):
        super().__init__()
        self.kind = kind

    def load(self, path: str):
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind.from_tables(self.sparkSession, f"{path}/tables")
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


class _WithTables(MLWritable, MLReadable):
    def write(self) -> MLWriter:
        return _TablesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TablesReader(cls)


class TextCleaner(Transformer, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """A text column as base text, clean text, or clean text with negation scopes (``form``)."""

    form = Param(Params._dummy(), "form", f"one of {FORMS}", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCol: str = "TEXT", outputCol: str = "clean_text", form: str = "clean"):
        super().__init__()
        self._setDefault(form="clean")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        form, out = self.getOrDefault(self.form), self.getOutputCol()
        if form not in FORMS:
            raise ValueError(f"form is {form!r}, expected one of {FORMS}")
        base = f"_{uuid.uuid4().hex}"
        df = with_base_text(dataset, self.getInputCol(), base)
        if form == "base":
            return df.withColumnRenamed(base, out) if out not in dataset.columns else df.withColumn(out, F.col(base)).drop(base)
        df = with_clean_text(df, base, out).drop(base)
        return with_steps(df, out, out, NEGATION_STEPS) if form == "negation" else df


class SurfaceScaler(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the largest value of each surface feature of base text."""

    @keyword_only
    def __init__(self, *, inputCol: str = "base_text", outputCol: str = "surface"):
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> SurfaceScalerModel:
        tops = surface_scale(dataset, self.getInputCol()).first().asDict()
        model = SurfaceScalerModel(
            inputCol=self.getInputCol(), outputCol=self.getOutputCol(), scale=[tops[name] for name in SURFACE_FEATURES]
        )
        return model


class SurfaceScalerModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Surface features over their scale as a vector, in the order of ``SURFACE_FEATURES``."""

    scale = Param(Params._dummy(), "scale", "largest value of each feature", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol: str = "base_text", outputCol: str = "surface", scale: list[float] | None = None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        features = surface_features(F.col(self.getInputCol()))
        scaled = [features[name] / top for name, top in zip(SURFACE_FEATURES, self.getOrDefault(self.scale))]
        return dataset.withColumn(self.getOutputCol(), array_to_vector(F.array(*scaled)))


class _TermParams(HasInputCol, HasOutputCol, HasIdCol):
    wordRange = Param(Params._dummy(), "wordRange", "smallest and largest n-gram of words", TypeConverters.toListInt)
    charRange = Param(Params._dummy(), "charRange", "smallest and largest n-gram of characters", TypeConverters.toListInt)
    minDf = Param(Params._dummy(), "minDf", "least documents of a term: words, characters", TypeConverters.toListInt)
    maxDf = Param(Params._dummy(), "maxDf", "largest share of documents of a word term", TypeConverters.toFloat)

    def _settings(self) -> dict:
        return {param.name: value for param, value in self.extractParamMap().items()}

    def _terms(self, dataset: DataFrame) -> DataFrame:
        docs = dataset.select(
            F.col(self.getOrDefault(self.idCol)).alias("row_idx"), F.col(self.getInputCol()).alias("text")
        )
        ranges = {WORD: tuple(self.getOrDefault(self.wordRange)), CHAR: tuple(self.getOrDefault(self.charRange))}
        return materialize(document_terms(docs, ranges, "text"))


class TermWeights(Estimator, _TermParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns the vocabulary of word and character n-grams and their inverse document frequencies."""

    @keyword_only
    def __init__(
        self, *, inputCol: str = "clean_text", outputCol: str = "terms", idCol: str = "row_idx",
        wordRange: list[int] = [1, 2], charRange: list[int] = [3, 5], minDf: list[int] = [2, 3], maxDf: float = 0.95,  # noqa: B006
    ):
        super().__init__()
        self._setDefault(
            inputCol="clean_text", outputCol="terms", idCol="row_idx", wordRange=[1, 2], charRange=[3, 5],
            minDf=[2, 3], maxDf=0.95,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TermWeightsModel:
        words, chars = self.getOrDefault(self.minDf)
        least = {WORD: words, CHAR: chars}
        counts = materialize(document_frequency(self._terms(dataset), least))
        n_docs = dataset.agg(F.count("*")).scalar()
        known = materialize(vocabulary(counts, n_docs, least, {WORD: self.getOrDefault(self.maxDf)}))
        return TermWeightsModel(known)._set(**self._settings())


class TermWeightsModel(Model, _TermParams, _WithTables):
    """Unit-length TF-IDF weights of each row's known terms as an array of ``(branch, term, weight)``."""

    def __init__(self, vocab: DataFrame):
        super().__init__()
        self.vocab = vocab

    def save_tables(self, path: str) -> None:
        self.vocab.write.mode("overwrite").parquet(path)

    @classmethod
    def from_tables(cls, spark: SparkSession, path: str) -> TermWeightsModel:
        return cls(spark.read.parquet(path))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        id_col, out = self.getOrDefault(self.idCol), self.getOutputCol()
        weights = tfidf(self._terms(dataset), self.vocab)
        gathered = weights.groupBy(F.col("row_idx").alias(id_col)).agg(
            F.sort_array(F.collect_list(F.struct("branch", "term", "weight"))).alias(out)
        )
        none = F.array().cast("array<struct<branch:string,term:string,weight:double>>")
        joined = dataset.drop(out).join(gathered, id_col, "left").withColumn(out, F.coalesce(out, none))
        return joined.select(*[c for c in dataset.columns if c != out], out)


class _HingeParams(HasInputCol, HasLabelCol, HasPredictionCol, HasIdCol):
    maxPasses = Param(Params._dummy(), "maxPasses", "passes over the rows at most", TypeConverters.toInt)
    maxLabelledRows = Param(Params._dummy(), "maxLabelledRows", "rows used for fitting at most, 0 for all", TypeConverters.toInt)


class TwoStageHinge(Estimator, _HingeParams, DefaultParamsReadable, DefaultParamsWritable):
    """The two-stage classifier of raw texts."""

    @keyword_only
    def __init__(
        self, *, inputCol: str = "TEXT", labelCol: str = "LABEL", predictionCol: str = "prediction",
        idCol: str = "row_idx", maxPasses: int = classifier.MAX_ITERATIONS, maxLabelledRows: int = 0,
    ):
        super().__init__()
        self._setDefault(
            inputCol="TEXT", labelCol="LABEL", predictionCol="prediction", idCol="row_idx",
            maxPasses=classifier.MAX_ITERATIONS, maxLabelledRows=0,
        )
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TwoStageHingeModel:
        docs = dataset.select(
            F.col(self.getOrDefault(self.idCol)).alias("row_idx"),
            F.col(self.getInputCol()).alias("TEXT"),
            F.col(self.getLabelCol()).alias("LABEL"),
        )
        fitted = classifier.fit(
            classifier.prepare(docs),
            max_iter=self.getOrDefault(self.maxPasses),
            max_labelled_rows=self.getOrDefault(self.maxLabelledRows) or None,
        )
        model = TwoStageHingeModel(fitted)
        return model._set(**{param.name: value for param, value in self.extractParamMap().items()})


class TwoStageHingeModel(Model, _HingeParams, _WithTables):
    """Adds the predicted label of each row's text."""

    def __init__(self, fitted: classifier.TwoStageModel):
        super().__init__()
        self.fitted = fitted

    def save_tables(self, path: str) -> None:
        classifier.save(self.fitted, path)

    @classmethod
    def from_tables(cls, spark: SparkSession, path: str) -> TwoStageHingeModel:
        return cls(classifier.load(spark, path))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        id_col, out = self.getOrDefault(self.idCol), self.getPredictionCol()
        docs = dataset.select(F.col(id_col).alias("row_idx"), F.col(self.getInputCol()).alias("TEXT"))
        told = classifier.predict(classifier.prepare(docs), self.fitted).select(
            F.col("row_idx").alias(id_col), F.col("pred").cast("double").alias(out)
        )
        return dataset.drop(out).join(told, id_col, "left").select(*[c for c in dataset.columns if c != out], out)
