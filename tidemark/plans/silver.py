"""Silver: one clean row per key, quality gated, merged by key."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.labels import engaged, sentiment
from tidemark.functions.text import clean_text
from tidemark.operators.latest import latest_per_key
from tidemark.operators.quality import POST_RULES, REVIEW_RULES, Rule
from tidemark.session import delete_path, scratch_path
from tidemark.settings import Settings
from tidemark.sources.audited import audit, write_audited
from tidemark.sources.buckets import Buckets
from tidemark.sources.progress import finish, stored_batches, unfinished
from tidemark.sources.tables import BATCH_COLUMN, read_batches, rebuild

RECENCY = ("_batch_id", "_ingest_ts")


def conform_reviews(bronze: DataFrame, order_cols: Sequence[str] = RECENCY) -> DataFrame:
    return latest_per_key(bronze, ["review_id"], order_cols).withColumns(
        {
            "text_clean": clean_text("text"),
            "summary_clean": clean_text("summary"),
            "review_date": F.to_date("review_ts"),
            "sentiment_label": sentiment("score"),
        }
    )


def conform_posts(bronze: DataFrame, order_cols: Sequence[str] = RECENCY) -> DataFrame:
    return latest_per_key(bronze, ["post_id"], order_cols).withColumns(
        {
            "title_clean": clean_text("title"),
            "body_clean": clean_text("selftext"),
            "created_date": F.to_date("created_ts"),
            "is_engaged": engaged("num_comments", "score"),
        }
    )


# entity -> (transformation, rules, keys)
SILVER: dict[str, tuple[Callable[[DataFrame], DataFrame], Sequence[Rule], list[str]]] = {
    "reviews": (conform_reviews, REVIEW_RULES, ["review_id"]),
    "reddit_posts": (conform_posts, POST_RULES, ["post_id"]),
}


# The newer batch wins; of two merges of one batch, the later one.
MERGED = "_merge_seq"
VERSION = (BATCH_COLUMN, MERGED)


def silver_table(settings: Settings, entity: str) -> Buckets:
    return Buckets(settings.path("silver", entity), SILVER[entity][2], VERSION, settings.merge_buckets)


def read_silver(spark: SparkSession, settings: Settings, entity: str) -> DataFrame | None:
    live = silver_table(settings, entity).live(spark)
    return None if live is None else live.drop(MERGED)


def build_silver(
    spark: SparkSession, settings: Settings, entity: str, full: bool = False, quarantine: bool = False
) -> bool:
    """Merge the new bronze batches (``full``: all of them); False when there is nothing to do.

    The conformed rows are written once to scratch and the rules are counted on the way; only the merge reads them
    again, and only those that passed. It rewrites the buckets of the keys that the new batches hold.
    """
    conform, rules, _ = SILVER[entity]
    path = settings.path("bronze", entity)
    batches = stored_batches(spark, path)
    if not full:
        batches = unfinished(spark, settings, "silver", entity, batches)
    if not batches:
        return False
    bronze = read_batches(spark, path, list(batches))
    staged = scratch_path(spark, f"silver-{entity}")
    try:
        written = audit(
            write_audited(conform(bronze), rules, staged, settings.fail_pct),
            f"silver.{entity}",
            settings.fail_pct,
            settings.environment,
            settings.path("_meta", "dq_audit"),
        )
        table = silver_table(settings, entity)
        table.merge(written.kept().withColumns({"_op": F.lit("u"), MERGED: F.lit(time.time_ns())}))
        if quarantine:
            rebuild(written.rejected(), settings.path("quarantine", entity))
    finally:
        delete_path(spark, staged)
    finish(spark, settings, "silver", entity, batches)
    return True


def run_silver(spark: SparkSession, settings: Settings, full: bool = False) -> list[str]:
    return [entity for entity in SILVER if build_silver(spark, settings, entity, full)]
