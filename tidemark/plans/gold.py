"""Gold: four tables, each rebuilt in full."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.operators.gold import engagement_daily, orders_enriched, reviews_daily, text_features
from tidemark.plans.silver import read_silver
from tidemark.settings import Settings
from tidemark.sources.tables import rebuild
from tidemark.streaming.cdc import CUSTOMERS, ORDERS, read_live


def run_gold(spark: SparkSession, settings: Settings) -> list[str]:
    """Builds what has its inputs and names it."""
    built = []

    def publish(name, df, partition_by=()):
        rebuild(df, settings.path("gold", name), partition_by)
        built.append(name)

    reviews = read_silver(spark, settings, "reviews")
    posts = read_silver(spark, settings, "reddit_posts")
    orders = read_live(spark, settings.path("silver", "cdc_orders"), ORDERS)
    customers = read_live(spark, settings.path("silver", "cdc_customers"), CUSTOMERS)
    if reviews is not None:
        publish("gold_reviews_daily", reviews_daily(reviews), ["review_date"])
        publish("gold_text_features", text_features(reviews))
    if posts is not None:
        publish("gold_subreddit_engagement", engagement_daily(posts), ["created_date"])
    if orders is not None and customers is not None:
        publish("gold_orders_enriched", orders_enriched(orders, customers), ["order_date"])
    return built
