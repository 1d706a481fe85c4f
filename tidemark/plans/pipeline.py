"""The stages in order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.plans.bronze import run_bronze
from tidemark.plans.delivery import run_delivery
from tidemark.plans.gold import run_gold
from tidemark.plans.ingest import ingest_posts, ingest_reviews
from tidemark.plans.silver import run_silver
from tidemark.settings import Settings

STAGES = ("ingest", "bronze", "silver", "gold")


def run_pipeline(
    spark: SparkSession,
    settings: Settings,
    stages: Sequence[str] = STAGES,
    reviews_path: str | None = None,
    posts_path: str | None = None,
) -> dict[str, object]:
    done: dict[str, object] = {}
    for stage in stages:
        if stage == "ingest":
            manifests = []
            if reviews_path:
                manifests.append(ingest_reviews(spark, settings, reviews_path))
            if posts_path:
                manifests.append(ingest_posts(spark, settings, posts_path))
            done[stage] = manifests
        elif stage == "bronze":
            done[stage] = run_bronze(spark, settings)
        elif stage == "silver":
            done[stage] = run_silver(spark, settings)
        elif stage == "gold":
            done[stage] = run_gold(spark, settings)
        elif stage == "deliver":
            done[stage] = run_delivery(spark, settings)
        else:
            raise ValueError(f"unknown stage {stage}")
    return done
