"""Landing files: reviews as CSV, posts as NDJSON, normalized into one typed Parquet batch table each."""

from __future__ import annotations

import csv
import json
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.joins import join_checked
from tidemark.session import materialize
from tidemark.sources.tables import BATCH_COLUMN, new_batch_id, replace_batches

# The published file layouts.
REVIEW_FIELDS = T.StructType(
    [
        T.StructField("Id", T.LongType()),
        T.StructField("ProductId", T.StringType()),
        T.StructField("UserId", T.StringType()),
        T.StructField("Score", T.LongType()),
        T.StructField("Time", T.LongType()),
        T.StructField("Summary", T.StringType()),
        T.StructField("Text", T.StringType()),
    ]
)
POST_FIELDS = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("subreddit", T.StringType()),
        T.StructField("author", T.StringType()),
        T.StructField("title", T.StringType()),
        T.StructField("selftext", T.StringType()),
        T.StructField("score", T.StringType()),
        T.StructField("num_comments", T.StringType()),
        T.StructField("upvote_ratio", T.StringType()),
        T.StructField("created_utc", T.StringType()),
    ]
)


def file_headers(spark: SparkSession, path: str) -> DataFrame:
    """(file, header): the first line of every file that has one.

    One job over the lines of the folder; of each file only the lines of its first split are looked at, and one line per
    task and file is shuffled.
    """
    lines = spark.read.option("recursiveFileLookup", True).text(path)
    first = lines.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    numbered = first.filter("start = 0").select("file", "value", F.monotonically_increasing_id().alias("line"))
    return numbered.groupBy("file").agg(F.min_by("value", "line").alias("header"))


def _names(header: str) -> list[str]:
    return next(csv.reader([header.removeprefix("\ufeff")]), [])


def read_reviews_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """Columns are taken by header name, in any order and among others; a bad number becomes NULL.

    Files of one folder may differ in their headers. Only the distinct headers reach the driver; all files are read in one
    scan by position, and each row finds its columns by its file's header. Of columns of one name the first counts; files
    without a line give no rows. Everything is read as text and cast afterwards, so one bad field never empties the whole
    row. Without ``multi_line`` no text may hold a line break, and large files are split among tasks; with it a file is one
    task, so drops come in many files.
    """
    headers = materialize(file_headers(spark, path), "headers")
    layouts = {row["header"]: _names(row["header"]) for row in headers.select("header").distinct().collect()}
    if not layouts:
        return spark.createDataFrame([], REVIEW_FIELDS)
    places = [f"_{i}" for i in range(max(map(len, layouts.values())) or 1)]
    rows = (
        spark.read.options(header=True, multiLine=multi_line, quote='"', escape='"', mode="PERMISSIVE", recursiveFileLookup=True)
        .schema(T.StructType([T.StructField(place, T.StringType()) for place in places]))
        .csv(path)
    )
    if len(layouts) > 1:
        rows = join_checked(rows.select("*", F.col("_metadata.file_path").alias("file")), headers, ["file"])

    def column(name: str) -> Column:
        found = {header: places[names.index(name)] for header, names in layouts.items() if name in names}
        if len(layouts) == 1:
            return F.col(*found.values()) if found else F.lit(None).cast("string")
        return F.coalesce(*[F.when(F.col("header") == header, F.col(place)) for header, place in found.items()], F.lit(None).cast("string"))

    return rows.select(*[column(f.name).try_cast(f.dataType).alias(f.name) for f in REVIEW_FIELDS])


def read_posts_json(spark: SparkSession, path: str) -> DataFrame:
    """All NDJSON files below ``path``. Numbers may come as numbers or as text, epochs also as 1.7e9."""
    raw = (
        spark.read.schema(POST_FIELDS)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.ndjson")
        .json(path)
    )
    whole = {name: F.col(name).try_cast("decimal(38,6)").try_cast("bigint") for name in ("score", "num_comments", "created_utc")}
    return raw.withColumns({**whole, "upvote_ratio": F.col("upvote_ratio").try_cast("double")})


def normalize_reviews(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("Id").alias("review_id"),
        F.col("ProductId").alias("product_id"),
        F.col("UserId").alias("user_id"),
        F.col("Score").alias("score"),
        F.timestamp_seconds("Time").alias("review_ts"),
        F.col("Summary").alias("summary"),
        F.col("Text").alias("text"),
    )


def normalize_posts(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("id").alias("post_id"),
        "subreddit",
        "author",
        "title",
        "selftext",
        F.col("score").cast("bigint").alias("score"),
        F.col("num_comments").cast("bigint").alias("num_comments"),
        F.col("upvote_ratio").cast("double").alias("upvote_ratio"),
        F.timestamp_seconds("created_utc").alias("created_ts"),
    )


def write_batch(df: DataFrame, path: str, source: str, manifest_path: str, batch_id: str | None = None) -> dict:
    """Stamp, write and record one batch; the manifest's row count is observed during the write."""
    batch_id = batch_id or new_batch_id()
    rows = replace_batches(df.withColumn(BATCH_COLUMN, F.lit(batch_id)), path)
    manifest = {
        "batch_id": batch_id,
        "source": source,
        "rows": rows,
        "created_at": datetime.now(timezone.utc).isoformat(),
    }
    spark = df.sparkSession
    spark.createDataFrame([(json.dumps(manifest),)], "value string").coalesce(1).write.mode("append").text(manifest_path)
    return manifest
