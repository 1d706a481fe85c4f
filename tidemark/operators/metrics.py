"""Classification metrics on distributed predictions."""

from __future__ import annotations

import math

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Score ranges per ROC computation: each is ordered by its own task.
SCORE_RANGES = 256


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def class_report(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    """Precision, recall, F1 and support of every class that occurs as label or prediction.

    Rows are first counted per (label, prediction) on the map side; the rest works on those counts.
    """
    cells = df.groupBy(F.col(label).alias("label"), F.col(pred).alias("pred")).agg(F.count(F.lit(1)).alias("n"))
    hit = F.when(F.col("label") == F.col("pred"), F.col("n")).otherwise(0)
    none = F.lit(0).cast("bigint")

    def role(column: str, support: Column, predicted: Column, hits: Column) -> Column:
        return F.struct(
            F.col(column).alias("class"), support.alias("support"), predicted.alias("predicted"), hits.alias("hits")
        )

    as_label, as_prediction = role("label", F.col("n"), none, hit), role("pred", none, F.col("n"), none)
    roles = cells.select(F.explode(F.array(as_label, as_prediction)).alias("r")).select("r.*")
    sums = roles.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    return sums.select(
        "class",
        _ratio(F.col("hits"), F.col("predicted")).alias("precision"),
        _ratio(F.col("hits"), F.col("support")).alias("recall"),
        _ratio(2 * F.col("hits"), F.col("support") + F.col("predicted")).alias("f1"),
        "support",
        "hits",
    )


def roc_auc(df: DataFrame, label: str = "label", proba: str = "proba", ranges: int = SCORE_RANGES) -> DataFrame:
    """One row ``roc_auc``: the share of (positive, negative) pairs ranked right, ties half; NULL for one class.
    A NULL or NaN score ranks nothing and is left out.

    Scores are counted per distinct value, cut into ranges at approximate quantiles, and cumulated per
    range on top of the totals of the lower ranges, so no task orders all scores.
    """
    positive = F.col(label) == 1
    scores = (
        df.groupBy(F.col(proba).cast("double").alias("score"))
        .agg(F.count_if(positive).alias("pos"), F.count_if(~positive).alias("neg"))
        .filter("score IS NOT NULL AND NOT isnan(score)")
    )
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    edges = scores.agg(F.percentile_approx("score", steps)).first()[0] or [0.0]
    splits = [-math.inf, *sorted(set(edges)), math.inf]
    placed = Bucketizer(splits=splits, inputCol="score", outputCol="range").transform(scores)
    totals = placed.groupBy("range").agg(F.sum("neg").alias("range_neg"))
    # ``ranges`` rows at most.
    below = Window.partitionBy(F.lit(0)).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("range", F.coalesce(F.sum("range_neg").over(below), F.lit(0)).alias("lower"))
    inside = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    ranked = placed.join(F.broadcast(offsets.limit(ranges)), "range").select(
        "pos", "neg", (F.col("lower") + F.coalesce(F.sum("neg").over(inside), F.lit(0))).alias("below")
    )
    won = F.sum(F.col("pos").cast("double") * (F.col("below") + F.col("neg") / 2))
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    return ranked.agg(F.try_divide(won, pairs).alias("roc_auc"))


def metrics(df: DataFrame, label: str = "label", pred: str = "pred", proba: str | None = None) -> DataFrame:
    """One row: accuracy and macro averages; ``roc_auc`` when scores are given, NULL when undefined."""
    out = class_report(df, label, pred).agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("f1_macro"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
    )
    return out.withColumn("roc_auc", roc_auc(df, label, proba).scalar()) if proba else out
