from __future__ import annotations

import random

import pytest

from tidemark.operators.metrics import class_report, metrics, roc_auc


def brute_auc(rows):
    pos = [p for y, p in rows if y == 1]
    neg = [p for y, p in rows if y == 0]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("ranges", [2, 16, 256])
@pytest.mark.parametrize("kind", ["spread", "tied", "hot"])
def test_auc_equals_pair_counting(spark, ranges, kind):
    rng = random.Random(11)
    draw = {"spread": rng.random, "tied": lambda: rng.randrange(5) / 5, "hot": lambda: 0.5 if rng.random() < 0.6 else rng.random()}[kind]
    rows = [(int(rng.random() < 0.4), draw()) for _ in range(400)]
    df = spark.createDataFrame(rows, "label int, proba double")
    assert roc_auc(df, ranges=ranges).first()["roc_auc"] == pytest.approx(brute_auc(rows))


def test_auc_is_undefined_for_one_class(spark):
    df = spark.createDataFrame([(1, 1, 0.2), (1, 0, 0.4)], "label int, pred int, proba double")
    assert metrics(df, proba="proba").first()["roc_auc"] is None
    assert roc_auc(df.filter("false")).first()["roc_auc"] is None


def test_macro_averages(spark):
    rows = [(0, 0), (0, 1), (1, 1), (1, 1), (2, 1), (2, 3)]
    df = spark.createDataFrame(rows, "label int, pred int")
    report = {r["class"]: r for r in class_report(df).collect()}
    assert (report[0]["precision"], report[0]["recall"], report[0]["f1"], report[0]["support"]) == (1.0, 0.5, pytest.approx(2 / 3), 2)
    assert (report[1]["precision"], report[1]["recall"]) == (0.5, 1.0)
    assert (report[2]["precision"], report[2]["f1"], report[3]["recall"], report[3]["support"]) == (0.0, 0.0, 0.0, 0)
    row = metrics(df).first()
    assert row["accuracy"] == 0.5 and row["precision_macro"] == pytest.approx(1.5 / 4)
    assert row["recall_macro"] == pytest.approx(1.5 / 4) and row["f1_macro"] == pytest.approx((2 / 3 + 2 / 3) / 4)
