"""Batch synchronization: extract since the watermark, merge, advance the watermark."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ranges import reconcile_ranges
from tidemark.session import materialized
from tidemark.settings import Settings
from tidemark.sources.incremental import extract_since, max_watermark, read_watermark, write_watermark
from tidemark.streaming.cdc import TableSpec, read_live

WATERMARK_COLUMN = "updated_at"


def as_changes(rows: DataFrame, version_col: str, op: str = "u") -> DataFrame:
    """Extracted rows are upserts whose version is their change time, so both sync paths can share a table.

    Without a log position, the microseconds order changes within one millisecond.
    """
    changed = F.col(version_col).cast("timestamp")
    return rows.withColumns(
        {"_op": F.lit(op), "_event_ts_ms": F.unix_millis(changed), "_lsn": F.unix_micros(changed)}
    )


def sync_table(
    source: DataFrame,
    spec: TableSpec,
    settings: Settings,
    wm_col: str = WATERMARK_COLUMN,
    overlap: str | None = None,
) -> int:
    """Returns the rows merged. The live source is read once; merge and watermark use what was read."""
    spark = source.sparkSession
    watermarks = settings.path("_meta", "watermarks")
    since = read_watermark(spark, watermarks, spec.name)
    with materialized(extract_since(source, wm_col, since, overlap), f"sync-{spec.name}") as incoming:
        rows = incoming.count()
        if rows:
            spec.table(settings.path("silver", f"cdc_{spec.name}"), settings.merge_buckets).merge(as_changes(incoming, wm_col))
            reached = max_watermark(incoming, wm_col).first()["watermark"]
            write_watermark(spark, watermarks, spec.name, reached)
    return rows


def sync_all(sources: Mapping[str, DataFrame], specs: Sequence[TableSpec], settings: Settings) -> dict[str, int]:
    return {spec.name: sync_table(sources[spec.name], spec, settings) for spec in specs}


def reconcile(source_keys: DataFrame, spec: TableSpec, settings: Settings) -> None:
    """Hard deletes, which a watermark cannot see: what the source no longer has is deleted now.

    Key ranges that are the same on both sides are digested and not compared row by row.
    """
    spark: SparkSession = source_keys.sparkSession
    path = settings.path("silver", f"cdc_{spec.name}")
    current = read_live(spark, path, spec)
    if current is None:
        return
    gone = reconcile_ranges(current, source_keys, spec.keys)
    stamped = as_changes(gone.withColumn("_seen", F.current_timestamp()), "_seen", op="d").drop("_seen")
    spec.table(path, settings.merge_buckets).merge(stamped)
