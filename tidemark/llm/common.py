"""What the operators of this package share: tables, keys of rows, words, distributed ranks and running sums."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but these white-space bytes; ``bytes.split()`` cuts at the same ones.
WORD = r"[^\x20\x09-\x0D]+"
LAST_ID = 2**63 - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_of(column: str) -> Column:
    """Ids in ascending order with nulls last."""
    return F.coalesce(F.col(column), F.lit(LAST_ID))


def keyed_texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``docs`` with ``_id`` (nulls last) and ``_th``: together they name a row.

    Rows equal in both id and text are one document given twice: they get the same decision.
    """
    return docs.withColumns({"_id": order_of(id_col), "_th": F.xxhash64(F.coalesce(text_col, F.lit("")))})


def buckets_for(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def with_rank(df: DataFrame, keys: list[str], order: list[str], rows: int, bucket_size: int = 50_000) -> DataFrame:
    """Adds ``_rank``: the position from 0 within ``keys``, by hash bucket and then by ``order``.

    A key with any share of the rows is ranked in many buckets: ranks in a bucket are moved by the row counts of
    the buckets before it, and only those counts (one row per key and bucket) are cumulated. ``df`` must be
    written data, as it is read twice.
    """
    return with_running_sum(df.withColumn("_one", F.lit(1).cast("long")), keys, order, "_one", "_rank", rows, bucket_size).drop("_one")


def with_running_sum(
    df: DataFrame, keys: list[str], order: list[str], value: str, out: str, rows: int, bucket_size: int = 50_000
) -> DataFrame:
    """Adds ``out``: the sum of ``value`` over the rows before this one within ``keys`` (see ``with_rank``)."""
    count = buckets_for(rows, bucket_size)
    spread = df.withColumn("_bucket", F.pmod(F.xxhash64(*order), F.lit(count)))
    before = Window.partitionBy(*keys).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    moved = (
        spread.groupBy(*keys, "_bucket")
        .agg(F.sum(value).alias("_sum"))
        .withColumn("_base", F.coalesce(F.sum("_sum").over(before), F.lit(0)))
        .select(*[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_bucket").alias("_b"), "_base")
    )
    inside = Window.partitionBy(*keys, "_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = spread.withColumn(out, F.coalesce(F.sum(value).over(inside), F.lit(0)))
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys] + [F.col("_bucket") == F.col("_b")]
    condition = same[0]
    for part in same[1:]:
        condition = condition & part
    return (
        local.join(moved, condition)
        .withColumn(out, F.col(out) + F.col("_base"))
        .drop("_bucket", "_b", "_base", *[f"_k_{k}" for k in keys])
    )


def shielded(docs: DataFrame, used: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """``docs`` with all columns but ``used`` renamed, so that none clashes, and what selects the old names again."""
    names = {c: c if c in used else f"_shield_{k}" for k, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), [F.col(n).alias(c) for c, n in names.items()]
