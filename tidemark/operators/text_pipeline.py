"""Text classifier as one pipeline: vocabulary, weights and forest, fitted together, stored together, for tables and streams.

The search is Spark's cross-validation over given folds, judged by macro F1; the candidates of a fold share its vocabulary
and its written vectors and are fitted side by side.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import product
from threading import Lock
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasLabelCol, HasOutputCol, HasPredictionCol, HasSeed
from pyspark.ml.tuning import CrossValidator
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import words
from tidemark.operators.metrics import metrics
from tidemark.operators.models import FOLDS, FOREST_GRID, fit_forest, scored_texts, with_folds
from tidemark.operators.tfidf import MAX_TERMS, MIN_DF, fit_vocabulary, lookup, weighed_vectors
from tidemark.session import materialize

# Candidates fitted at a time.
SIDE_BY_SIDE = 4


def _weigher(terms: Sequence[str], idf: Sequence[float]):
    known, weight = lookup(terms), np.array(idf, np.float64)

    @F.arrow_udf(VectorUDT())
    def weigh(tokens: pa.Array) -> pa.Array:
        return weighed_vectors(known, weight, tokens)

    return weigh


class TfidfModel(Model, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Texts to the weights of ``tfidf_vectors`` as one vector a row, without a shuffle: rows of a stream too.

    A null or empty text, or one of unknown terms, gives the zero vector. Words are found by expressions; looking terms up,
    pairs by the numbers of their words, and weighing them is done on Arrow batches as a whole. The vocabulary goes along with the function: ``MAX_TERMS`` terms at most.
    """

    terms = Param(Params._dummy(), "terms", "vocabulary, in order of position", TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "inverse document frequency of each term", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="features", terms=None, idf=None):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="features")
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        weigh = _weigher(self.getOrDefault(self.terms), self.getOrDefault(self.idf))
        return dataset.withColumn(self.getOutputCol(), weigh(words(F.col(self.getInputCol()))))


class TfidfVectorizer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """Fits ``TfidfModel``: terms in at least ``minDF`` documents, the ``maxTerms`` most frequent of them."""

    minDF = Param(Params._dummy(), "minDF", "least number of documents of a term", TypeConverters.toInt)
    maxTerms = Param(Params._dummy(), "maxTerms", "greatest size of the vocabulary", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="text", outputCol="features", minDF=MIN_DF, maxTerms=MAX_TERMS):
        super().__init__()
        self._setDefault(inputCol="text", outputCol="features", minDF=MIN_DF, maxTerms=MAX_TERMS)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TfidfModel:
        vocabulary = fit_vocabulary(
            dataset, text_col=self.getInputCol(), min_df=self.getOrDefault(self.minDF), max_terms=self.getOrDefault(self.maxTerms)
        )
        rows = sorted(vocabulary.select("idx", "term", "idf").collect())
        fitted = TfidfModel(terms=[row["term"] for row in rows], idf=[row["idf"] for row in rows])
        return self._copyValues(fitted)


class _Candidates:
    """(position, model) as they are asked for, by several threads."""

    def __init__(self, fit, count: int):
        self._fit, self._left, self._lock = fit, iter(range(count)), Lock()

    def __iter__(self):
        return self

    def __next__(self):
        with self._lock:
            position = next(self._left)
        return position, self._fit(position)


class TextForest(Estimator, HasInputCol, HasLabelCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a ``PipelineModel`` of ``TfidfModel`` and forest. Several parameter maps share one vocabulary and its vectors."""

    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)
    depth = Param(Params._dummy(), "depth", "greatest depth", TypeConverters.toInt)
    minDF = Param(Params._dummy(), "minDF", "least number of documents of a term", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="text", labelCol="label", seed=42, trees=200, depth=30, minDF=MIN_DF):
        super().__init__()
        self._setDefault(inputCol="text", labelCol="label", seed=42, trees=200, depth=30, minDF=MIN_DF)
        self._set(**self._input_kwargs)

    def fitMultiple(self, dataset: DataFrame, paramMaps):
        label = self.getLabelCol()
        vectors = TfidfVectorizer(inputCol=self.getInputCol(), minDF=self.getOrDefault(self.minDF)).fit(dataset)
        rows = materialize(vectors.transform(dataset).select(label, "features"), "vectors")

        def fit(position: int) -> PipelineModel:
            chosen = self.copy(paramMaps[position])
            trees, depth = chosen.getOrDefault(chosen.trees), chosen.getOrDefault(chosen.depth)
            return PipelineModel([vectors, fit_forest(rows, trees, depth, chosen.getSeed(), label)])

        return _Candidates(fit, len(paramMaps))

    def _fit(self, dataset: DataFrame) -> PipelineModel:
        return next(self.fitMultiple(dataset, [{}]))[1]


class MacroF1(Evaluator, HasLabelCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """Unweighted mean of the classes' F1; 0 without rows."""

    @keyword_only
    def __init__(self, *, labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(labelCol="label", predictionCol="prediction")
        self._set(**self._input_kwargs)

    def _evaluate(self, dataset: DataFrame) -> float:
        label, pred = F.col(self.getLabelCol()).cast("int"), F.col(self.getPredictionCol()).cast("int")
        return metrics(dataset.select(label.alias("label"), pred.alias("pred"))).first()["f1_macro"] or 0.0

    def isLargerBetter(self) -> bool:
        return True


class Searched(NamedTuple):
    params: dict[str, int]
    f1_macro: float
    model: PipelineModel


def search_forest(
    train: DataFrame,
    grid: dict[str, Sequence[int]] = FOREST_GRID,
    folds: int = FOLDS,
    seed: int = 42,
    min_df: int = MIN_DF,
    side_by_side: int = SIDE_BY_SIDE,
) -> Searched:
    """The best candidate by mean macro F1 (ties: the first of the grid), and the pipeline refitted on all of ``train``."""
    forest = TextForest(seed=seed, minDF=min_df)
    candidates = [dict(zip(grid, values)) for values in product(*grid.values())]
    search = CrossValidator(
        estimator=forest,
        estimatorParamMaps=[{forest.getParam(name): value for name, value in chosen.items()} for chosen in candidates],
        evaluator=MacroF1(),
        numFolds=folds,
        foldCol="fold",
        parallelism=side_by_side,
    )
    found = search.fit(materialize(with_folds(train, folds, seed), "folds"))
    best = max(range(len(candidates)), key=lambda i: found.avgMetrics[i])
    return Searched(candidates[best], float(found.avgMetrics[best]), found.bestModel)


def score(docs: DataFrame, model: PipelineModel) -> DataFrame:
    """Texts of a table or a stream, labelled by a fitted or loaded pipeline."""
    return scored_texts(model.transform(docs.select("id", "text")), pred_col="prediction")
