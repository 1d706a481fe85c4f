"""Change envelopes: JSON records with the row before and after, the operation and its source position."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The replicated tables as the capture tool serializes them (decimals and times as text).
CUSTOMER_ROW = T.StructType(
    [
        T.StructField("customer_id", T.LongType()),
        T.StructField("full_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("segment", T.StringType()),
        T.StructField("country", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
ORDER_ROW = T.StructType(
    [
        T.StructField("order_id", T.LongType()),
        T.StructField("customer_id", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("amount", T.StringType()),
        T.StructField("currency", T.StringType()),
        T.StructField("updated_at", T.StringType()),
    ]
)
CUSTOMER_CASTS = {"updated_at": "timestamp"}
ORDER_CASTS = {"updated_at": "timestamp", "amount": "decimal(12,2)"}


def envelope_schema(row: T.StructType) -> T.StructType:
    source = T.StructType([T.StructField("lsn", T.LongType()), T.StructField("table", T.StringType())])
    return T.StructType(
        [
            T.StructField("before", row),
            T.StructField("after", row),
            T.StructField("op", T.StringType()),
            T.StructField("ts_ms", T.LongType()),
            T.StructField("source", source),
        ]
    )


def repair_types(df: DataFrame, casts: Mapping[str, str]) -> DataFrame:
    """Text to its real type; what does not parse becomes NULL."""
    return df.withColumns(
        {
            name: F.try_to_timestamp(name) if kind == "timestamp" else F.col(name).try_cast(kind)
            for name, kind in casts.items()
        }
    )


def unwrap(records: DataFrame, row: T.StructType, casts: Mapping[str, str], value_col: str = "value") -> DataFrame:
    """Typed change rows with ``_op``, ``_event_ts_ms`` and ``_lsn``.

    One parse reads both record shapes, bare and below ``payload``. A delete carries its row in ``before``.
    A record that is no envelope yields only NULLs, among them the op, and so has no effect later.
    """
    envelope = envelope_schema(row)
    either = T.StructType([T.StructField("payload", envelope), *envelope.fields])
    parsed = records.select(F.from_json(F.col(value_col).cast("string"), either).alias("j"))
    bare = F.when(F.col("j.op").isNotNull(), F.struct(*[F.col(f"j.{f.name}").alias(f.name) for f in envelope]))
    change = parsed.select(F.coalesce(F.col("j.payload"), bare).alias("e"))
    image = F.when(F.col("e.op") == "d", F.col("e.before")).otherwise(F.col("e.after"))
    rows = change.select(
        image.alias("row"),
        F.col("e.op").alias("_op"),
        F.col("e.ts_ms").alias("_event_ts_ms"),
        F.col("e.source.lsn").alias("_lsn"),
    ).select("row.*", "_op", "_event_ts_ms", "_lsn")
    return repair_types(rows, casts)
