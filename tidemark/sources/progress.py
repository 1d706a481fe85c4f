"""Which batches a stage has finished, so that a run touches only what is new."""

from __future__ import annotations

import hashlib
from collections.abc import Mapping

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.settings import Settings
from tidemark.sources.tables import BATCH_COLUMN, list_files, list_folders, read_or_none

SCHEMA = "stage string, entity string, batch_id string, stamp string"


def stored_batches(spark: SparkSession, path: str) -> dict[str, str]:
    """Batch id -> stamp, from a listing without a scan.

    Part files are named anew by every write, so the stamp of a batch changes when its content is replaced.
    """
    prefix = f"{BATCH_COLUMN}="
    folders = [name for name in list_folders(spark, path) if name.startswith(prefix)]
    return {name.removeprefix(prefix): _stamp(spark, f"{path}/{name}") for name in folders}


def _stamp(spark: SparkSession, folder: str) -> str:
    return hashlib.md5("/".join(list_files(spark, folder)).encode()).hexdigest()


def unfinished(spark: SparkSession, settings: Settings, stage: str, entity: str, batches: Mapping[str, str]) -> dict[str, str]:
    """Those of ``batches`` not finished with their present stamp."""
    finished = read_or_none(spark, settings.path("_meta", "progress"), SCHEMA)
    if finished is None:
        return dict(batches)
    mine = finished.filter((F.col("stage") == stage) & (F.col("entity") == entity))
    known = mine.filter(F.col("batch_id").isin(list(batches))).select("batch_id", "stamp").distinct()
    done = {(row["batch_id"], row["stamp"]) for row in known.collect()}
    return {batch: stamp for batch, stamp in batches.items() if (batch, stamp) not in done}


def finish(spark: SparkSession, settings: Settings, stage: str, entity: str, batches: Mapping[str, str]) -> None:
    """Recorded after the stage's data is complete; a run lost before that simply repeats the batch."""
    rows = [(stage, entity, batch, stamp) for batch, stamp in batches.items()]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(settings.path("_meta", "progress"))
