from __future__ import annotations

import hashlib
import math

import pytest

from tidemark.functions.labels import seeded_hash
from tidemark.operators import splits
from tidemark.operators.splits import read_splits, sample_cap, stratified_split, write_splits


def order(i, seed=42):
    return hashlib.md5(f"{seed}-{i}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of all rows in one class, one class of a single row, one row without label."""
    rows = [(i, 0 if i % 3 else 1 + i % 2) for i in range(3000)] + [(5000, 7), (5001, None)]
    return spark.createDataFrame(rows, "id int, label int").cache()


def test_seeded_hash(spark):
    assert spark.createDataFrame([(5,)], "id int").select(seeded_hash(42, "id").alias("h")).first()["h"] == order(5)


@pytest.mark.parametrize("cap", [1, 17, 2999, 3001, 3002, 5000])
def test_sample_is_exact_and_repeatable(skewed, cap):
    expected = sorted([*range(3000), 5000, 5001], key=order)[:cap]
    assert sorted(r["id"] for r in sample_cap(skewed, cap, 42).collect()) == sorted(expected)
    assert sorted(r["id"] for r in sample_cap(skewed.repartition(7), cap, 42).collect()) == sorted(expected)


def test_no_cap(skewed):
    assert sample_cap(skewed, 0, 42) is skewed


def test_split_equals_ranking_whole_classes(skewed):
    got = {r["id"]: r["split"] for r in stratified_split(skewed).collect()}
    want = {}
    labels = {r["id"]: r["label"] for r in skewed.collect() if r["label"] is not None}
    for label in set(labels.values()):
        members = sorted((i for i in labels if labels[i] == label), key=order)
        tested = math.ceil(len(members) / 5)
        held = tested + math.ceil((len(members) - tested) / 8)
        want |= {i: "test" if n < tested else "val" if n < held else "train" for n, i in enumerate(members)}
    assert got == want


def test_split_does_not_depend_on_broadcast(skewed, monkeypatch):
    small = {(r["id"], r["split"]) for r in stratified_split(skewed).collect()}
    monkeypatch.setattr(splits.join_checked, "__defaults__", ("inner", 1))
    assert {(r["id"], r["split"]) for r in stratified_split(skewed).collect()} == small


def test_wide_rows_are_not_shuffled(skewed):
    plan = stratified_split(skewed)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_splits_are_read_by_folder(skewed, spark, tmp_path):
    path = str(tmp_path / "splits")
    write_splits(stratified_split(skewed), path)
    test = read_splits(spark, path, "test")
    assert test.count() == stratified_split(skewed).filter("split = 'test'").count()
    assert "PartitionFilters: [isnotnull(split" in test._jdf.queryExecution().toString()
