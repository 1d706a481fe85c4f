"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def row_hash(columns: Sequence[str]) -> Column:
    """The last tie-breaker: depends on the content of a row only."""
    return F.xxhash64(*sorted(columns))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_cols: Sequence[str | Column], total: bool = False
) -> DataFrame:
    """One row per key: the greatest by ``order_cols``, NULLs last, any remaining tie broken by row content.

    Say ``total`` when the order leaves no ties: then unused columns are not read for breaking them.

    Catalyst puts a rank limit below the exchange, so each map task ships at most one row per key and a
    hot key costs one row per task, not its whole group.
    """
    order = [F.col(c).desc_nulls_last() if isinstance(c, str) else c for c in order_cols]
    if not total:
        order.append(row_hash(df.columns).desc())
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")
