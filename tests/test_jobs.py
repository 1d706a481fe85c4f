from __future__ import annotations

import json
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from tidemark.operators.quality import QualityGateError
from tidemark.plans.cdc_stream import run_cdc
from tidemark.plans.fixtures import envelopes, order_changes, posts_src, reviews_src
from tidemark.plans.pipeline import run_pipeline
from tidemark.plans.bronze import run_bronze
from tidemark.plans.silver import build_silver, read_silver, run_silver, silver_table
from tidemark.sources.tables import read_batches, read_table, replace_batches
from tidemark.streaming.cdc import change_stream

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def landing(spark, tmp_path):
    """The supplied tables as landing files."""
    reviews = reviews_src(spark, FOLDER).filter("_batch_id = 'B1'").select(
        F.col("review_id").alias("Id"), F.col("product_id").alias("ProductId"), F.col("user_id").alias("UserId"),
        F.col("score").alias("Score"), F.unix_seconds(F.col("review_ts").cast("timestamp")).alias("Time"),
        F.col("summary").alias("Summary"), F.col("text").alias("Text"),
    )
    reviews.write.option("header", True).option("quoteAll", True).option("escape", '"').csv(str(tmp_path / "csv"))
    posts = posts_src(spark, FOLDER).select(
        F.col("post_id").cast("string").alias("id"), "subreddit", "author", "title", "selftext", "score", "num_comments",
        "upvote_ratio", F.unix_seconds(F.col("created_ts").cast("timestamp")).alias("created_utc"),
    )
    folder = tmp_path / "nd"
    folder.mkdir()
    (folder / "posts.ndjson").write_text("\n".join(posts.toJSON().collect()))
    return str(tmp_path / "csv"), str(folder)


def test_all_stages(spark, settings, landing, tmp_path):
    csv, ndjson = landing
    inbox = str(tmp_path / "orders")
    envelopes(order_changes(spark, FOLDER)).write.text(inbox)
    customer = {"customer_id": 7, "full_name": "n", "email": "e", "segment": "s", "country": "c", "updated_at": "2024-01-01"}
    (tmp_path / "customers").mkdir()
    (tmp_path / "customers" / "a.txt").write_text(json.dumps({"after": customer, "op": "c", "ts_ms": 1}))
    streams = {"orders": change_stream(spark, "text", inbox), "customers": change_stream(spark, "text", str(tmp_path / "customers"))}
    run_cdc(streams, settings, once=True)

    done = run_pipeline(spark, settings, ("ingest", "bronze", "silver", "gold", "deliver"), csv, ndjson)
    assert [m["rows"] for m in done["ingest"]] == [200, 50]
    assert done["bronze"] == {"reviews": 200, "reddit_posts": 50}
    assert done["silver"] == ["reviews", "reddit_posts"]
    assert len(done["gold"]) == 4 and len(done["deliver"]) == 3

    bronze = read_batches(spark, settings.path("bronze", "reviews"))
    assert {"_ingest_ts", "_source", "_batch_id"} <= set(bronze.columns) and "batch_id" not in bronze.columns
    silver = read_silver(spark, settings, "reviews")
    expected = reviews_src(spark, FOLDER).filter("_batch_id = 'B1' AND score BETWEEN 1 AND 5").count()
    assert silver.count() == expected
    audit = spark.read.parquet(settings.path("_meta", "dq_audit"))
    assert audit.groupBy("table").count().count() == 2 and audit.count() == 7
    enriched = read_table(spark, settings.path("gold", "gold_orders_enriched"))
    assert enriched.count() == 1350 and enriched.filter("full_name = 'n'").count() == enriched.filter("customer_id = 7").count()

    first = {name: _content(spark, settings, name) for name in done["gold"]}
    again = run_pipeline(spark, settings, ("bronze", "silver", "gold"))
    assert again["bronze"] == {} and again["silver"] == []
    assert {name: _content(spark, settings, name) for name in done["gold"]} == first
    assert run_bronze(spark, settings, replay=True) == done["bronze"]
    assert run_silver(spark, settings, full=True) == done["silver"]
    run_pipeline(spark, settings, ("gold",))
    assert {name: _content(spark, settings, name) for name in done["gold"]} == first


def _content(spark, settings, name):
    df = read_table(spark, settings.path("gold", name))
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_missing_inputs_are_skipped(spark, settings):
    done = run_pipeline(spark, settings, ("bronze", "silver", "gold", "deliver"))
    assert done == {"bronze": {}, "silver": [], "gold": [], "deliver": []}
    with pytest.raises(ValueError):
        run_pipeline(spark, settings, ("nothing",))


def test_a_failed_gate_publishes_nothing_but_the_audit(spark, settings):
    rows = [(None, 5, "b1"), (1, 4, "b1")]
    bad = spark.createDataFrame(rows, "review_id long, score long, _batch_id string").select(
        "*", F.lit("text").alias("text"), F.lit("s").alias("summary"), F.current_timestamp().alias("review_ts"), F.current_timestamp().alias("_ingest_ts")
    )
    bad.write.partitionBy("_batch_id").parquet(settings.path("bronze", "reviews"))
    with pytest.raises(QualityGateError):
        build_silver(spark, settings, "reviews")
    assert read_silver(spark, settings, "reviews") is None
    assert spark.read.parquet(settings.path("_meta", "dq_audit")).count() == 1


def bronze_rows(spark, settings, *rows):
    df = spark.createDataFrame(rows, "review_id long, score long, text string, _batch_id string").select(
        "*", F.lit("s").alias("summary"), F.current_timestamp().alias("review_ts"), F.current_timestamp().alias("_ingest_ts")
    )
    replace_batches(df, settings.path("bronze", "reviews"))


def scores(spark, settings):
    return sorted((r["review_id"] or 0, r["score"]) for r in read_silver(spark, settings, "reviews").collect())


def test_silver_takes_new_batches_only(spark, settings):
    bronze_rows(spark, settings, (1, 5, "t", "b1"), (2, 99, "t", "b1"))
    assert build_silver(spark, settings, "reviews", quarantine=True)
    assert [r["review_id"] for r in read_table(spark, settings.path("quarantine", "reviews")).collect()] == [2]
    assert not build_silver(spark, settings, "reviews")
    bronze_rows(spark, settings, (1, 4, "t", "b2"), (3, 4, "t", "b2"))
    assert build_silver(spark, settings, "reviews")
    assert scores(spark, settings) == [(1, 4), (3, 4)]
    # An older batch that is merged again does not win over a newer one.
    bronze_rows(spark, settings, (1, 1, "t", "b1"), (5, 2, "t", "b1"))
    assert build_silver(spark, settings, "reviews", full=True)
    assert scores(spark, settings) == [(1, 4), (3, 4), (5, 2)]


def test_rows_without_key_are_kept_once_per_merge(spark, settings):
    lenient = replace(settings, fail_pct=60.0)
    bronze_rows(spark, settings, (None, 5, "t", "b1"), (None, 4, "u", "b1"), (1, 3, "t", "b1"))
    assert build_silver(spark, lenient, "reviews")
    table = silver_table(settings, "reviews")
    assert len(scores(spark, settings)) == 2 and table.state(spark).count() == 2
    bronze_rows(spark, settings, (None, 2, "t", "b2"), (7, 3, "t", "b2"))
    assert build_silver(spark, lenient, "reviews")
    assert len(scores(spark, settings)) == 4


def test_a_batch_landed_again_is_taken_again(spark, settings):
    """Replaced content under the same batch id reaches bronze and silver; an unchanged batch is left alone."""
    moment = "cast('2024-01-01' as timestamp)"

    def land(*rows):
        frame = spark.createDataFrame(rows, "review_id long, score long").selectExpr(
            "review_id", "'p' product_id", "'u' user_id", "score", f"{moment} review_ts", "'s' summary", "'text' text", "'B1' _batch_id"
        )
        replace_batches(frame, settings.path("landing", "normalized", "reviews"))

    land((1, 2))
    assert run_bronze(spark, settings) == {"reviews": 1} and run_silver(spark, settings) == ["reviews"]
    assert run_bronze(spark, settings) == {} and run_silver(spark, settings) == []
    land((1, 5), (2, 4))
    assert run_bronze(spark, settings) == {"reviews": 2} and run_silver(spark, settings) == ["reviews"]
    silver = read_silver(spark, settings, "reviews")
    assert {(r["review_id"], r["score"]) for r in silver.collect()} == {(1, 5), (2, 4)}
