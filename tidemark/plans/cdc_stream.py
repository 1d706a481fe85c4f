"""Continuous synchronization: one stream per replicated table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tidemark.settings import Settings
from tidemark.streaming.cdc import CUSTOMERS, ORDERS, await_all, change_stream, start_cdc

SPECS = {spec.name: spec for spec in (CUSTOMERS, ORDERS)}
# Fixed value: topics are named <prefix>.public.<table>.
TOPIC_PREFIX = "oltp"


def broker_streams(spark: SparkSession, servers: str) -> dict[str, DataFrame]:
    return {
        name: change_stream(spark, "kafka", **{"kafka.bootstrap.servers": servers, "subscribe": f"{TOPIC_PREFIX}.public.{name}"})
        for name in SPECS
    }


def run_cdc(streams: Mapping[str, DataFrame], settings: Settings, once: bool = False) -> None:
    queries = [
        start_cdc(
            stream,
            SPECS[name],
            settings.path("silver", f"cdc_{name}"),
            settings.path("_checkpoints", f"cdc_{name}"),
            once,
            settings.trigger,
            settings.merge_buckets,
        )
        for name, stream in streams.items()
    ]
    await_all(queries)
