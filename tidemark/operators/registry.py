"""Model registry on three narrow tables: versions (model, version, run_id), metrics (run_id, metric, value),
aliases (model, alias, version)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What promotion compares, and what a missing score counts as.
PROMOTION_METRIC = "test_f1_macro"
CHAMPION = "champion"
NO_SCORE = -1.0


def best_candidate(candidates: DataFrame, metric: str = "f1_macro", position: str = "position") -> DataFrame:
    """The best candidate; the first in order wins a tie."""
    scored = candidates.filter(F.col(metric) > NO_SCORE)
    return scored.orderBy(F.desc(metric), position).limit(1)


def promote(versions: DataFrame, metrics: DataFrame, aliases: DataFrame, min_uplift: float = 0.0) -> DataFrame:
    """Per model: newest version against the champion, and whether it takes over (at least champion + uplift)."""
    newest = versions.groupBy("model").agg(F.max(F.struct(F.col("version").cast("int").alias("version"), "run_id")).alias("v"))
    challenger = newest.select("model", F.col("v.version").alias("challenger"), F.col("v.run_id").alias("run_id"))
    scores = metrics.filter(F.col("metric") == PROMOTION_METRIC).select("run_id", F.col("value").alias("score"))
    held = (
        aliases.filter(F.col("alias") == CHAMPION)
        .select("model", F.col("version").cast("int").alias("version"))
        .join(versions.withColumn("version", F.col("version").cast("int")), ["model", "version"])
        .join(scores.withColumnRenamed("score", "champion_score"), "run_id", "left")
        .select("model", F.col("version").alias("champion"), "champion_score")
    )
    compared = challenger.join(scores.withColumnRenamed("score", "challenger_score"), "run_id", "left").join(
        held, "model", "left"
    )
    ours, theirs = (F.coalesce(c, F.lit(NO_SCORE)) for c in ("challenger_score", "champion_score"))
    return compared.select(
        "model",
        "challenger",
        ours.alias("challenger_score"),
        "champion",
        theirs.alias("champion_score"),
        (ours >= theirs + min_uplift).alias("promoted"),
    )
