"""Business aggregates, the enriched join and the feature table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: shorter cleaned texts are no training examples.
MIN_FEATURE_LENGTH = 10


def _rounded_mean(value: Column | str, digits: int, name: str) -> Column:
    return F.round(F.avg(value), digits).alias(name)


def reviews_daily(reviews: DataFrame) -> DataFrame:
    label = F.col("sentiment_label")
    return reviews.groupBy("review_date", "product_id").agg(
        F.count(F.lit(1)).alias("review_count"),
        _rounded_mean("score", 3, "avg_score"),
        F.count_if(label == "positive").alias("positives"),
        F.count_if(label == "negative").alias("negatives"),
        _rounded_mean(F.length("text_clean"), 1, "avg_text_len"),
    )


def engagement_daily(posts: DataFrame) -> DataFrame:
    """``engaged_posts`` is NULL, not 0, for a group whose flags are all NULL."""
    return posts.groupBy("created_date", "subreddit").agg(
        F.count(F.lit(1)).alias("posts"),
        _rounded_mean("score", 2, "avg_score"),
        _rounded_mean("num_comments", 2, "avg_comments"),
        _rounded_mean("upvote_ratio", 4, "avg_upvote_ratio"),
        F.sum(F.col("is_engaged").cast("bigint")).alias("engaged_posts"),
    )


def orders_enriched(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Every order with its customer's attributes, NULL where the customer is unknown.

    No hint: the customer side is broadcast only when its measured size allows, else it is a sort-merge
    join whose hot customers adaptive execution splits.
    """
    attributes = customers.select("customer_id", "full_name", "segment", "country")
    return orders.join(attributes, "customer_id", "left").select(
        "order_id",
        "customer_id",
        "full_name",
        "segment",
        "country",
        "status",
        "amount",
        "currency",
        "updated_at",
        F.to_date("updated_at").alias("order_date"),
    )


def text_features(reviews: DataFrame, min_len: int = MIN_FEATURE_LENGTH) -> DataFrame:
    """Binary sentiment examples; the filters stay on scan columns so that they push down."""
    usable = (F.col("sentiment_label") != "neutral") & (F.length("text_clean") >= min_len)
    return reviews.filter(usable).select(
        F.col("review_id").alias("id"),
        F.col("text_clean").alias("text"),
        (F.col("sentiment_label") == "positive").cast("int").alias("label"),
        "review_date",
    )
