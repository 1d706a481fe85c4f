"""Delivery contracts: names, types and keys of the delivered tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Contract:
    columns: tuple[tuple[str, str], ...]
    keys: tuple[str, ...]


# Column order, types and keys the consumers were promised.
CONTRACTS = {
    "gold_reviews_daily": Contract(
        (
            ("REVIEW_DATE", "date"),
            ("PRODUCT_ID", "string"),
            ("REVIEW_COUNT", "bigint"),
            ("AVG_SCORE", "double"),
            ("POSITIVES", "bigint"),
            ("NEGATIVES", "bigint"),
            ("AVG_TEXT_LEN", "double"),
        ),
        ("REVIEW_DATE", "PRODUCT_ID"),
    ),
    "gold_subreddit_engagement": Contract(
        (
            ("CREATED_DATE", "date"),
            ("SUBREDDIT", "string"),
            ("POSTS", "bigint"),
            ("AVG_SCORE", "double"),
            ("AVG_COMMENTS", "double"),
            ("AVG_UPVOTE_RATIO", "double"),
            ("ENGAGED_POSTS", "bigint"),
        ),
        ("CREATED_DATE", "SUBREDDIT"),
    ),
    "gold_orders_enriched": Contract(
        (
            ("ORDER_ID", "bigint"),
            ("CUSTOMER_ID", "bigint"),
            ("FULL_NAME", "string"),
            ("SEGMENT", "string"),
            ("COUNTRY", "string"),
            ("STATUS", "string"),
            ("AMOUNT", "decimal(12,2)"),
            ("CURRENCY", "string"),
            ("UPDATED_AT", "timestamp_ntz"),
            ("ORDER_DATE", "date"),
        ),
        ("ORDER_ID",),
    ),
}


def conform(df: DataFrame, contract: Contract) -> DataFrame:
    return df.select(*[F.col(name.lower()).cast(kind).alias(name) for name, kind in contract.columns])
