"""Bronze: landed batches with lineage, replaceable batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.settings import Settings
from tidemark.sources.progress import finish, stored_batches, unfinished
from tidemark.sources.tables import read_batches, replace_batches

ENTITIES = ("reviews", "reddit_posts")


def with_lineage(df: DataFrame, source: str) -> DataFrame:
    return df.withColumns({"_ingest_ts": F.current_timestamp(), "_source": F.lit(source)})


def run_bronze(spark: SparkSession, settings: Settings, replay: bool = False) -> dict[str, int]:
    """Rows written per entity. Only batches that are new or were landed again are read; ``replay`` takes all again."""
    written = {}
    for entity in ENTITIES:
        source = settings.path("landing", "normalized", entity)
        batches = stored_batches(spark, source)
        if not replay:
            batches = unfinished(spark, settings, "bronze", entity, batches)
        if batches:
            landed = read_batches(spark, source, list(batches))
            written[entity] = replace_batches(with_lineage(landed, entity), settings.path("bronze", entity))
            finish(spark, settings, "bronze", entity, batches)
    return written
