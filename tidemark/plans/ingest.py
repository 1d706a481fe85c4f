"""Ingest: landing files to normalized batches. Only files of new drops need to be passed in."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.settings import Settings
from tidemark.sources.landing import normalize_posts, normalize_reviews, read_posts_json, read_reviews_csv, write_batch


def ingest_reviews(spark: SparkSession, settings: Settings, csv_path: str, batch_id: str | None = None) -> dict:
    return write_batch(
        normalize_reviews(read_reviews_csv(spark, csv_path)),
        settings.path("landing", "normalized", "reviews"),
        "kaggle_reviews",
        settings.path("_meta", "batches"),
        batch_id,
    )


def ingest_posts(spark: SparkSession, settings: Settings, ndjson_path: str, batch_id: str | None = None) -> dict:
    return write_batch(
        normalize_posts(read_posts_json(spark, ndjson_path)),
        settings.path("landing", "normalized", "reddit_posts"),
        "reddit_posts",
        settings.path("_meta", "batches"),
        batch_id,
    )
