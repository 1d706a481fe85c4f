"""Joins against sides whose size is checked first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MAX_BROADCAST_ROWS = 100_000


def join_checked(
    df: DataFrame, small: DataFrame, on: Sequence[str], how: str = "inner", max_rows: int = MAX_BROADCAST_ROWS
) -> DataFrame:
    """Broadcast ``small`` when it really has at most ``max_rows`` narrow rows, else leave the join to Catalyst.

    The size is measured, not estimated: at most ``max_rows + 1`` rows are fetched, and they become the
    broadcast side, so ``small`` is computed once and the wide side is not shuffled.
    """
    rows = small.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        return df.join(small, list(on), how)
    return df.join(F.broadcast(df.sparkSession.createDataFrame(rows, small.schema)), list(on), how)
