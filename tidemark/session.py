"""Session defaults and the shared scratch area."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app_name: str, shuffle_partitions: int = 8, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**SESSION_CONF, "spark.sql.shuffle.partitions": str(shuffle_partitions), **conf}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for lineage cuts: the one the cluster names, or a local one in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if spark.sparkContext.master.partition("[")[0] == "local":
        folder = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", folder)
        return folder
    raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared scratch folder and continue from the written columns.

    Cuts lineage like a reliable checkpoint, but stays columnar: later passes prune columns and push
    filters down, and losing an executor costs a re-read instead of a recomputation.
    """
    return write_and_read(df, scratch_path(df.sparkSession, label))


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{_application_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _application_folder(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/tidemark/{spark.sparkContext.applicationId}"


def clear_scratch(spark: SparkSession) -> None:
    """Remove what this application materialized; frames built on it cannot be read afterwards."""
    delete_path(spark, _application_folder(spark))


def write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def materialized(df: DataFrame, label: str = "stage"):
    """``materialize`` for the span of a job; the written files are removed at the end."""
    path = scratch_path(df.sparkSession, label)
    try:
        yield write_and_read(df, path)
    finally:
        delete_path(df.sparkSession, path)
