"""Views over the supplied tables in the shape of the layer tables.

They plant the cases that matter: two batches of one review, NULL and out-of-range scores, equal change
times, deletes, customers without a match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def spread(spark: SparkSession, folder: str, name: str, key: str) -> DataFrame:
    """A table for costly per-row work: rows are distributed first when the input has fewer splits than
    there are cores (the small supplied files have one row group each); large inputs are read as they are."""
    df, cores = table(spark, folder, name), spark.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores, key)


def _day(start: str, offset: str) -> F.Column:
    days = F.make_dt_interval(F.expr(offset).cast("int"))
    return F.lit(start).cast("timestamp_ntz") + days


def reviews_src(spark: SparkSession, folder: str) -> DataFrame:
    docs = spread(spark, folder, "documents", "doc_id")
    common = [
        F.col("doc_id").alias("review_id"),
        F.col("source").alias("product_id"),
        F.col("lang").alias("user_id"),
    ]
    when = _day("2024-01-01", "doc_id % 30").alias("review_ts")
    first = docs.select(
        *common,
        F.expr("CASE WHEN doc_id % 89 = 0 THEN NULL WHEN doc_id % 97 = 0 THEN 99 ELSE 1 + doc_id % 5 END").alias("score"),
        when,
        F.col("text").alias("summary"),
        "text",
        F.lit("B1").alias("_batch_id"),
    )
    revised = docs.filter("doc_id % 7 = 0").select(
        *common,
        F.expr("1 + (doc_id + 2) % 5").alias("score"),
        when,
        F.col("text").alias("summary"),
        F.concat("text", F.lit(" Revised <i>edition</i> http://x.co/1 &amp;")).alias("text"),
        F.lit("B2").alias("_batch_id"),
    )
    return first.unionByName(revised)


def posts_src(spark: SparkSession, folder: str) -> DataFrame:
    return spread(spark, folder, "pages", "page_id").select(
        F.col("page_id").alias("post_id"),
        F.regexp_extract("url", r"^https?://([^/]+)", 1).alias("subreddit"),
        F.expr("concat('u', cast(page_id % 17 AS string))").alias("author"),
        F.regexp_extract("html", r"<title>([^<]*)</title>", 1).alias("title"),
        F.col("html").alias("selftext"),
        F.expr("page_id % 40 - 5").alias("score"),
        F.expr("CASE WHEN page_id % 23 = 0 THEN NULL ELSE page_id % 11 END").alias("num_comments"),
        F.expr("cast(page_id % 100 AS double) / 100").alias("upvote_ratio"),
        _day("2024-02-01", "page_id % 10").alias("created_ts"),
        F.lit("B1").alias("_batch_id"),
    )


def order_changes(spark: SparkSession, folder: str) -> DataFrame:
    """c for every order, u for every second, d for every tenth; equal times when the key divides by 4."""
    steps = F.expr(
        "filter(array(0, 1, 2), s -> s = 0 OR (s = 1 AND o_orderkey % 2 = 0) OR (s = 2 AND o_orderkey % 10 = 0))"
    )
    changes = spread(spark, folder, "orders", "o_orderkey").withColumn("seq", F.explode(steps))
    return changes.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.expr("CASE seq WHEN 0 THEN 'created' WHEN 1 THEN 'paid' ELSE o_orderstatus END").alias("status"),
        F.expr("cast(cast(o_totalprice AS decimal(12,2)) AS string)").alias("amount"),
        F.lit("USD").alias("currency"),
        F.col("o_orderdate").alias("updated_at"),
        F.expr("CASE seq WHEN 0 THEN 'c' WHEN 1 THEN 'u' ELSE 'd' END").alias("op"),
        F.expr(
            "1700000000000 + o_orderkey * 1000 + CASE WHEN seq = 1 AND o_orderkey % 4 = 0 THEN 0 ELSE seq END"
        ).alias("ts_ms"),
        F.expr("o_orderkey * 10 + seq").alias("lsn"),
    )


def customers_src(spark: SparkSession, folder: str) -> DataFrame:
    # every fiftieth goes by another id, so that its orders find no customer
    customers = table(spark, folder, "customer")
    nations = table(spark, folder, "nation")
    return customers.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.expr("CASE WHEN c_custkey % 50 = 0 THEN -c_custkey ELSE c_custkey END").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.lower(F.concat("c_name", F.lit("@example.com"))).alias("email"),
        F.col("c_mktsegment").alias("segment"),
        F.col("n_name").alias("country"),
    )


def predictions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "labels").select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("label"),
        F.expr("CASE WHEN doc_id % 3 <> 0 THEN 1 ELSE 0 END").alias("pred"),
        F.expr("cast(doc_id % 101 AS double) / 101").alias("proba"),
    )


def labelled_texts(spark: SparkSession, folder: str) -> DataFrame:
    """Labelled documents: the input of the text classifiers."""
    labels = table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return docs.join(labels, "doc_id").select(F.col("doc_id").alias("id"), "text", "label")


def envelopes(changes: DataFrame) -> DataFrame:
    """Changes as JSON records, half of them below ``payload``."""
    row = F.struct(
        "order_id",
        "customer_id",
        "status",
        "amount",
        "currency",
        F.date_format("updated_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("updated_at"),
    )
    deleted = F.col("op") == "d"
    record = F.struct(
        F.when(deleted, row).alias("before"),
        F.when(~deleted, row).alias("after"),
        "op",
        "ts_ms",
        F.struct("lsn", F.lit("orders").alias("table")).alias("source"),
    )
    wrapped = F.to_json(F.struct(record.alias("payload")))
    return changes.select(F.when(F.col("order_id") % 2 == 0, wrapped).otherwise(F.to_json(record)).alias("value"))
