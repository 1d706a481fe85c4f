from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tidemark.operators.contracts import CONTRACTS, conform
from tidemark.operators.gold import orders_enriched, reviews_daily
from tidemark.plans.delivery import deliver, deliver_jdbc, merge_statement, read_delivered


def daily(spark, *rows):
    df = spark.createDataFrame([(p, n) for p, n in rows], "product_id string, review_count long")
    return df.select(F.lit("2024-01-01").cast("date").alias("review_date"), "*", *[F.lit(1).alias(c) for c in ("avg_score", "positives", "negatives", "avg_text_len")])


def test_deliver_upserts_and_never_deletes(spark, tmp_path):
    path, contract = str(tmp_path / "d"), CONTRACTS["gold_reviews_daily"]
    assert deliver(daily(spark, ("p1", 1), ("p2", 2)), path, contract)
    assert deliver(daily(spark, ("p2", 5), ("p3", 3)), path, contract)
    assert not deliver(daily(spark, ("x", 1)).filter("false"), path, contract)
    delivered = read_delivered(spark, path, contract)
    assert delivered.columns == [name for name, _ in contract.columns]
    assert {r["PRODUCT_ID"]: r["REVIEW_COUNT"] for r in delivered.collect()} == {"p1": 1, "p2": 5, "p3": 3}


@pytest.mark.parametrize("name", sorted(CONTRACTS))
def test_conform_types(spark, name):
    contract = CONTRACTS[name]
    df = spark.range(1).select(*[F.lit(None).cast("string").alias(c.lower()) for c, _ in contract.columns])
    assert conform(df, contract).dtypes == list(contract.columns)
    assert set(contract.keys) <= {c for c, _ in contract.columns}


def test_merge_statement():
    lines = merge_statement("SALES", 'SALES"STG', ["DAY", "SHOP", "SUM"], ["DAY", "SHOP"]).split("\n")
    assert lines == [
        'MERGE INTO "SALES" AS held',
        'USING "SALES""STG" AS fresh',
        'ON held."DAY" = fresh."DAY" AND held."SHOP" = fresh."SHOP"',
        'WHEN MATCHED THEN UPDATE SET "SUM" = fresh."SUM"',
        'WHEN NOT MATCHED THEN INSERT ("DAY", "SHOP", "SUM") VALUES (fresh."DAY", fresh."SHOP", fresh."SUM")',
    ]
    assert "MATCHED THEN UPDATE" not in merge_statement("T", "S", ["K"], ["K"])


class Recorder:
    """Stands in for a warehouse connection."""

    def __init__(self, broken=False):
        self.log, self.broken = [], broken

    def cursor(self):
        return self

    def execute(self, statement):
        self.log.append(statement.split()[0])
        if self.broken:
            raise RuntimeError("refused")

    def commit(self):
        self.log.append("commit")

    def rollback(self):
        self.log.append("rollback")

    def close(self):
        self.log.append("close")


def test_jdbc_delivery_stages_then_merges(spark, monkeypatch):
    staged = []
    monkeypatch.setattr("pyspark.sql.readwriter.DataFrameWriter.jdbc", lambda self, url, table, properties: staged.append(table))
    good, bad = Recorder(), Recorder(broken=True)
    assert deliver_jdbc(daily(spark, ("p", 1)), "gold_reviews_daily", "u", {}, good)
    assert staged == ["GOLD_REVIEWS_DAILY_STG"] and good.log == ["MERGE", "commit", "close"]
    with pytest.raises(RuntimeError):
        deliver_jdbc(daily(spark, ("p", 1)), "gold_reviews_daily", "u", {}, bad)
    assert bad.log == ["MERGE", "rollback", "close"]
    assert not deliver_jdbc(daily(spark, ("p", 1)).filter("false"), "gold_reviews_daily", "u", {}, good)


def test_enriched_orders_keep_orders_without_customer(spark):
    orders = spark.createDataFrame([(1, 7), (2, 8), (3, None)], "order_id int, customer_id int").select(
        "*", F.lit("s").alias("status"), F.lit(1).alias("amount"), F.lit("USD").alias("currency"), F.lit("2024-01-02").cast("timestamp").alias("updated_at")
    )
    customers = spark.createDataFrame([(7, "n", "g", "c")], "customer_id int, full_name string, segment string, country string")
    rows = {r["order_id"]: r for r in orders_enriched(orders, customers).collect()}
    assert len(rows) == 3 and rows[1]["full_name"] == "n" and rows[2]["full_name"] is None
    assert str(rows[3]["order_date"]) == "2024-01-02"


def test_daily_metrics_group_null_keys(spark):
    df = spark.createDataFrame([(None, 5, "positive", "abc"), (None, 1, "negative", "ab")], "product_id string, score int, sentiment_label string, text_clean string")
    row = reviews_daily(df.withColumn("review_date", F.lit("2024-01-01").cast("date"))).first()
    assert (row["review_count"], row["avg_score"], row["positives"], row["negatives"], row["avg_text_len"]) == (2, 3.0, 1, 1, 2.5)
