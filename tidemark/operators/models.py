"""Text classifiers: random forest and nearest neighbours on TF-IDF, searched by cross-validated macro F1."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.labels import SCORED_TEXT_LENGTH, seeded_hash
from tidemark.operators.forest import ForestModel, grow_forest
from tidemark.operators.metrics import metrics
from tidemark.operators.neighbors import knn_vote, nearest
from tidemark.operators.tfidf import MAX_TERMS, MIN_DF, as_features, fit_vocabulary, term_vectors, tfidf_vectors
from tidemark.session import materialize

# The published search grids. Spark trees end at depth 30, which stands in for "no limit" and 40.
KNN_GRID = (5, 11, 21)
FOREST_GRID = {"trees": (200, 400), "depth": (20, 30)}
FOLDS = 3


@dataclass
class Featurizer:
    """A fitted vocabulary; ``transform`` gives (id, label?, indices, values) and, as ``features``, an ML vector."""

    vocabulary: DataFrame
    size: int

    @classmethod
    def fit(cls, docs: DataFrame, min_df: int = MIN_DF, max_terms: int = MAX_TERMS) -> Featurizer:
        vocabulary = materialize(fit_vocabulary(docs, min_df=min_df, max_terms=max_terms), "vocabulary")
        return cls(vocabulary, vocabulary.count())

    def sparse(self, docs: DataFrame) -> DataFrame:
        return tfidf_vectors(docs, self.vocabulary)

    def features(self, docs: DataFrame, *carried: str) -> DataFrame:
        rows = term_vectors(docs, self.vocabulary)
        if carried:
            rows = rows.join(docs.select("id", *carried), "id")
        return as_features(rows, self.size, *carried)


def fit_forest(features: DataFrame, trees: int = 200, depth: int = 30, seed: int = 42, label_col: str = "label") -> ForestModel:
    """A forest whose leaves hold one row at least, as published, however many rows there are."""
    return ForestModel(grow_forest(features, trees, depth, seed, label_col), trees)


def forest_predictions(model: ForestModel, features: DataFrame) -> DataFrame:
    scored = model.transform(features)
    return scored.withColumns(
        {"pred": F.col("prediction").cast("int"), "proba": vector_to_array("probability")[1]}
    ).drop("rawPrediction", "probability", "prediction", "features")


def knn_predictions(neighbours: DataFrame, labels: DataFrame, k: int) -> DataFrame:
    """(id, pred, proba of label 1)."""
    votes = knn_vote(neighbours, labels, k)
    return votes.groupBy(F.col("query_id").alias("id")).agg(
        F.max("predicted").cast("int").alias("pred"),
        F.sum(F.when(F.col("label") == 1, F.col("proba")).otherwise(0.0)).alias("proba"),
    )


def with_folds(train: DataFrame, folds: int = FOLDS, seed: int = 42) -> DataFrame:
    return train.withColumn("fold", F.pmod(F.xxhash64(seeded_hash(seed, "id")), F.lit(folds)).cast("int"))


def _macro_f1(predicted: DataFrame) -> float:
    return metrics(predicted, "label", "pred").first()["f1_macro"]


def search_knn(
    train: DataFrame, ks: Iterable[int] = KNN_GRID, folds: int = FOLDS, seed: int = 42, min_df: int = MIN_DF
) -> tuple[dict[str, int], float]:
    """The best k and its mean macro F1 (ties: the smallest).

    The vocabulary is fitted anew on every fold's training part; neighbours are found once for the largest k, smaller
    k's are prefixes of the same ranking.
    """
    ks = sorted(ks)
    scores: dict[int, list[float]] = {k: [] for k in ks}
    folded = materialize(with_folds(train, folds, seed), "folds")
    for fold in range(folds):
        fitting, held = folded.filter(F.col("fold") != fold), folded.filter(F.col("fold") == fold)
        featurizer = Featurizer.fit(fitting, min_df=min_df)
        truth = held.select("id", "label")
        neighbours = materialize(nearest(featurizer.sparse(held), featurizer.sparse(fitting), ks[-1]), "neighbours")
        for k in ks:
            scores[k].append(_macro_f1(knn_predictions(neighbours, fitting, k).join(truth, "id")))
    means = {k: sum(values) / folds for k, values in scores.items()}
    best = max(ks, key=means.__getitem__)
    return {"k": best}, means[best]


def scored_texts(predicted: DataFrame, text_col: str = "text", pred_col: str = "pred") -> DataFrame:
    """What consumers of the scoring job get: the text cut for display, the label and its name."""
    return predicted.select(
        "id",
        F.substring(text_col, 1, SCORED_TEXT_LENGTH).alias("text"),
        F.col(pred_col).cast("int").alias("label"),
        F.when(F.col(pred_col) == 1, "positive").otherwise("negative").alias("sentiment"),
    )
