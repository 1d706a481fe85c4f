from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.plans.cdc_batch import reconcile, sync_all, sync_table
from tidemark.sources.incremental import EPOCH, extract_since, jdbc_options, read_watermark, write_watermark
from tidemark.streaming.cdc import CUSTOMERS, ORDERS, read_live

SCHEMA = "order_id long, customer_id long, status string, amount string, currency string, updated_at string"


def source(spark, *rows):
    df = spark.createDataFrame([(k, 1, status, "1.00", "USD", at) for k, status, at in rows], SCHEMA)
    return df.withColumns({"updated_at": F.to_timestamp("updated_at"), "amount": F.col("amount").cast("decimal(12,2)")})


def live(spark, settings):
    table = read_live(spark, settings.path("silver", "cdc_orders"), ORDERS)
    return {r["order_id"]: r["status"] for r in table.collect()}


def test_sync_advances_and_merges(spark, settings):
    assert sync_table(source(spark, (1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-02 00:00:00.5")), ORDERS, settings) == 2
    path = settings.path("_meta", "watermarks")
    assert read_watermark(spark, path, "orders") == "2024-01-02 00:00:00.5"
    assert read_watermark(spark, path, "other") == EPOCH
    rows = source(spark, (1, "a", "2024-01-01 00:00:00"), (2, "paid", "2024-01-03 00:00:00"), (3, "c", "2024-01-03 00:00:00"))
    assert sync_table(rows, ORDERS, settings) == 2
    assert live(spark, settings) == {1: "a", 2: "paid", 3: "c"}
    assert sync_table(rows, ORDERS, settings) == 0
    assert read_watermark(spark, path, "orders") == "2024-01-03 00:00:00"


def test_overlap_picks_up_late_commits(spark, settings):
    sync_table(source(spark, (1, "a", "2024-01-02 00:00:00")), ORDERS, settings)
    late = source(spark, (1, "a", "2024-01-02 00:00:00"), (2, "late", "2024-01-01 23:55:00"))
    assert sync_table(late, ORDERS, settings) == 0
    assert sync_table(late, ORDERS, settings, overlap="10 minutes") == 2
    assert live(spark, settings) == {1: "a", 2: "late"}


def test_changes_within_a_millisecond_keep_their_order(spark, settings):
    sync_table(source(spark, (1, "first", "2024-01-01 00:00:00.000100")), ORDERS, settings)
    sync_table(source(spark, (1, "second", "2024-01-01 00:00:00.000200")), ORDERS, settings)
    assert live(spark, settings) == {1: "second"}


def test_reconcile_finds_hard_deletes(spark, settings):
    sync_table(source(spark, (1, "a", "2024-01-01 00:00:00"), (2, "b", "2024-01-01 00:00:00")), ORDERS, settings)
    reconcile(spark.createDataFrame([(2,)], "order_id long"), ORDERS, settings)
    assert live(spark, settings) == {2: "b"}


def test_all_tables(spark, settings):
    customers = spark.createDataFrame([(1, "n", "e", "s", "c")], "customer_id long, full_name string, email string, segment string, country string")
    customers = customers.withColumn("updated_at", F.lit("2024-01-01").cast("timestamp"))
    done = sync_all({"orders": source(spark, (1, "a", "2024-01-01 00:00:00")), "customers": customers}, [ORDERS, CUSTOMERS], settings)
    assert done == {"orders": 1, "customers": 1}


def test_latest_watermark_wins(spark, tmp_path):
    path = str(tmp_path / "w")
    write_watermark(spark, path, "t", "2024-01-02 00:00:00")
    write_watermark(spark, path, "t", "2024-01-01 00:00:00")
    assert read_watermark(spark, path, "t") == "2024-01-01 00:00:00"


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_extract_filter_reaches_the_scan(spark, tmp_path, kind):
    path = str(tmp_path / "src")
    source(spark, (1, "a", "2024-01-01 00:00:00")).withColumn("updated_at", F.col("updated_at").cast(kind)).write.parquet(path)
    plan = extract_since(spark.read.parquet(path), "updated_at", "2023-01-01 00:00:00")._jdf.queryExecution().toString()
    assert "GreaterThan(updated_at" in plan


def test_jdbc_reads_can_be_partitioned():
    base = dict(url="u", table="t", user="me", password="p", driver="d")
    assert jdbc_options(**base)["fetchsize"] == "10000" and "numPartitions" not in jdbc_options(**base)
    assert jdbc_options(**base, partition=("id", "0", "100", 8))["numPartitions"] == "8"
