"""Change streams into tables merged by key.

A micro-batch is collapsed and merged with its versions (event time, log position) into the buckets of its keys, so replays
after a restart, late events and reordered batches all lead to the same state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.latest import latest_per_key
from tidemark.sources.buckets import Buckets
from tidemark.streaming.envelope import CUSTOMER_CASTS, CUSTOMER_ROW, ORDER_CASTS, ORDER_ROW, unwrap

VERSION = ("_event_ts_ms", "_lsn")


@dataclass(frozen=True)
class TableSpec:
    name: str
    row: T.StructType
    keys: tuple[str, ...]
    casts: Mapping[str, str] = field(default_factory=dict)

    def table(self, path: str, buckets: int = 16) -> Buckets:
        return Buckets(path, self.keys, VERSION, buckets)


def read_live(spark: SparkSession, path: str, spec: TableSpec) -> DataFrame | None:
    live = spec.table(path).live(spark)
    return None if live is None else live.drop(*VERSION)


CUSTOMERS = TableSpec("customers", CUSTOMER_ROW, ("customer_id",), CUSTOMER_CASTS)
ORDERS = TableSpec("orders", ORDER_ROW, ("order_id",), ORDER_CASTS)


def change_stream(spark: SparkSession, fmt: str = "kafka", path: str | None = None, **options: str) -> DataFrame:
    """A stream with a ``value`` column; a broker topic is read from the start and tolerates expired data."""
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "failOnDataLoss": "false", **options}
    reader = spark.readStream.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def _sink(spec: TableSpec, path: str, buckets: int):
    target = spec.table(path, buckets)

    def upsert(batch: DataFrame, epoch: int) -> None:
        target.merge(batch.filter(F.col("_op").isNotNull()))

    return upsert


def start_cdc(
    stream: DataFrame,
    spec: TableSpec,
    path: str,
    checkpoint: str,
    once: bool = False,
    interval: str = "30 seconds",
    buckets: int = 16,
) -> StreamingQuery:
    """One query per table. ``once`` drains what is there and ends, else a batch runs per ``interval``."""
    writer = (
        unwrap(stream, spec.row, spec.casts)
        .writeStream.foreachBatch(_sink(spec, path, buckets))
        .option("checkpointLocation", checkpoint)
        .queryName(f"cdc_{spec.name}")
    )
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def await_all(queries: Sequence[StreamingQuery], poll_seconds: int = 5) -> None:
    """Wait for every query; the first failure stops the others and surfaces."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [query for query in waiting if not query.awaitTermination(poll_seconds)]
    finally:
        for query in queries:
            query.stop()


def serving_view(orders: DataFrame, as_of: str, days: int = 90) -> DataFrame:
    """Latest row per order within the retention, as served: amount as double, times in milliseconds."""
    recent = F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days))
    updated = F.col("updated_at").cast("timestamp")
    kept = orders.filter(updated >= recent)
    return latest_per_key(kept, ["order_id"], ["updated_at"]).select(
        "order_id",
        "customer_id",
        "segment",
        "country",
        "status",
        F.col("amount").cast("double").alias("amount"),
        F.date_trunc("millisecond", updated).alias("updated_at"),
    )
