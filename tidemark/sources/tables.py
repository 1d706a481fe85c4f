"""Layer tables on plain Parquet.

A rebuilt table is a folder of snapshots; the newest one that Spark marked ``_SUCCESS`` is current. Readers
never see half a table, and a job that is lost leaves the old snapshot current. A batch table (bronze) is one
folder partitioned by ``_batch_id``.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.merge import plan_merge, plan_upsert, reject_duplicate_keys
from tidemark.session import delete_path

SNAPSHOT = "snapshot-"
BATCH_COLUMN = "_batch_id"


def _file_system(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    target, fs = _file_system(spark, path)
    return fs.exists(target)


def list_folders(spark: SparkSession, path: str, complete: bool = False) -> list[str]:
    """Folder names in order; ``complete`` keeps those whose write has finished."""
    target, fs = _file_system(spark, path)
    if not fs.exists(target):
        return []
    names = sorted(s.getPath().getName() for s in fs.listStatus(target) if s.isDirectory())
    return [n for n in names if path_exists(spark, f"{path}/{n}/_SUCCESS")] if complete else names


def list_files(spark: SparkSession, path: str) -> list[str]:
    target, fs = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(target) if not s.isDirectory())


def mark_complete(spark: SparkSession, path: str) -> None:
    """What Spark does at the end of a write, for folders that are checked between write and use."""
    target, fs = _file_system(spark, f"{path}/_SUCCESS")
    fs.create(target, True).close()


def read_or_none(spark: SparkSession, path: str, schema=None) -> DataFrame | None:
    """A missing path is no data; every error in reading an existing one surfaces."""
    if not path_exists(spark, path):
        return None
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame | None:
    """The current snapshot of a rebuilt or merged table."""
    complete = list_folders(spark, path, complete=True)
    return spark.read.parquet(f"{path}/{complete[-1]}") if complete else None


def new_batch_id() -> str:
    """Second and eight hex digits; five of them are the microsecond, so that ids order batches of one second too."""
    now = datetime.now(timezone.utc)
    return f"{now:%Y%m%dT%H%M%S}-{now.microsecond:05x}{uuid.uuid4().hex[:3]}"


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] = (), keep: int = 2) -> None:
    """Write a complete new snapshot; schema and content are replaced, ``keep`` snapshots remain.

    Partitioned output is rebalanced first: small dates share a task, a hot date is split over several.
    """
    spark = df.sparkSession
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.partitionBy(*partition_by).parquet(f"{path}/{SNAPSHOT}{time.time_ns():020d}")
    for name in list_folders(spark, path, complete=True)[:-keep]:
        delete_path(spark, f"{path}/{name}")


def replace_batches(df: DataFrame, path: str) -> int:
    """Replace the batches in ``df``, keep all others; replaying a batch changes nothing. Returns the rows written.

    Later batches may bring new columns: read with ``mergeSchema``. The row count is observed during the write.
    """
    seen = Observation()
    (
        df.observe(seen, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "zstd")
        .partitionBy(BATCH_COLUMN)
        .parquet(path)
    )
    return seen.get["rows"]


def read_batches(spark: SparkSession, path: str, batches: Sequence[str] | None = None) -> DataFrame | None:
    """The given batches (default: all) with the union of their columns.

    Named batches are read by folder, so neither listing nor schema merging touches the others. A batch id
    stays text even when it looks like a number.
    """
    if not path_exists(spark, path):
        return None
    folders = [path] if batches is None else [f"{path}/{BATCH_COLUMN}={batch}" for batch in batches]
    return (
        spark.read.option("basePath", path)
        .option("mergeSchema", "true")
        .parquet(*folders)
        .withColumn(BATCH_COLUMN, F.col(BATCH_COLUMN).cast("string"))
    )


def _publish(
    df: DataFrame, path: str, plan: Callable[[DataFrame | None, DataFrame, Sequence[str], bool], DataFrame], keys, unique: bool
) -> None:
    if not unique:
        reject_duplicate_keys(df, keys)
    target = read_table(df.sparkSession, path)
    covered = target is not None and 2 * df.count() >= target.count()
    rebuild(plan(target, df, keys, covered), path)


def publish_upsert(df: DataFrame, path: str, keys: Sequence[str], unique: bool = False) -> None:
    """Upsert into a snapshot table. ``df`` is read several times: hand in a written table."""
    _publish(df, path, lambda target, rows, on, covered: plan_upsert(target, rows, on, covered), keys, unique)


def publish_merge(
    changes: DataFrame, path: str, keys: Sequence[str], op_col: str = "_op", unique: bool = False
) -> None:
    """Merge changes into a snapshot table. ``changes`` are read several times: hand in a written table."""
    _publish(changes, path, lambda target, rows, on, covered: plan_merge(target, rows, on, op_col, covered), keys, unique)
