from __future__ import annotations

import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from tidemark.operators.merge import AmbiguousMergeError
from tidemark.session import materialize, materialized, scratch_root
from tidemark.sources.tables import (
    new_batch_id,
    publish_merge,
    publish_upsert,
    read_batches,
    read_or_none,
    read_table,
    rebuild,
    replace_batches,
)


def test_missing_path_is_none_other_errors_surface(spark, tmp_path):
    assert read_or_none(spark, str(tmp_path / "absent")) is None
    (tmp_path / "empty").mkdir()
    with pytest.raises(AnalysisException):
        read_or_none(spark, str(tmp_path / "empty"))


def test_replaying_a_batch_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "bronze")
    one = spark.createDataFrame([(1, "a", "b1"), (2, "b", "b1")], "id int, v string, _batch_id string")
    two = spark.createDataFrame([(3, "c", "b2")], "id int, v string, _batch_id string")
    assert replace_batches(one, path) == 2
    assert replace_batches(two, path) == 1
    before = sorted(map(tuple, read_batches(spark, path).select("id", "v", "_batch_id").collect()))
    replace_batches(one, path)
    assert sorted(map(tuple, read_batches(spark, path).select("id", "v", "_batch_id").collect())) == before
    replace_batches(one.filter("id = 1"), path)
    assert sorted(r["id"] for r in read_batches(spark, path).collect()) == [1, 3]


def test_later_batches_may_add_columns(spark, tmp_path):
    path = str(tmp_path / "bronze")
    replace_batches(spark.createDataFrame([(1, "b1")], "id int, _batch_id string"), path)
    replace_batches(spark.createDataFrame([(2, "x", "b2")], "id int, extra string, _batch_id string"), path)
    assert {r["id"]: r["extra"] for r in read_batches(spark, path).collect()} == {1: None, 2: "x"}


def test_rebuild_switches_to_complete_snapshots_only(spark, tmp_path):
    path = str(tmp_path / "gold")
    assert read_table(spark, path) is None
    for n in (1, 2, 3):
        rebuild(spark.range(n), path)
    assert read_table(spark, path).count() == 3
    snapshots = sorted(f for f in os.listdir(path) if f.startswith("snapshot-"))
    assert len(snapshots) == 2
    os.makedirs(f"{path}/snapshot-{10**19 + 1}")  # a write that was lost half way
    assert read_table(spark, path).count() == 3


def test_rebuild_partitions_and_replaces_the_schema(spark, tmp_path):
    path = str(tmp_path / "gold")
    rebuild(spark.range(10).withColumn("d", F.col("id") % 2), path, ["d"])
    assert read_table(spark, path).filter("d = 1").count() == 5
    rebuild(spark.range(4).select(F.col("id").alias("other")), path)
    assert read_table(spark, path).columns == ["other"]


def test_published_merges(spark, tmp_path):
    path = str(tmp_path / "t")
    publish_upsert(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), path, ["id"])
    publish_upsert(spark.createDataFrame([(2, "c"), (3, "d")], "id int, v string"), path, ["id"])
    assert {r["id"]: r["v"] for r in read_table(spark, path).collect()} == {1: "a", 2: "c", 3: "d"}
    publish_merge(spark.createDataFrame([(1, "a", "d"), (3, "e", "u")], "id int, v string, _op string"), path, ["id"])
    assert {r["id"]: r["v"] for r in read_table(spark, path).collect()} == {2: "c", 3: "e"}
    with pytest.raises(AmbiguousMergeError):
        publish_upsert(spark.createDataFrame([(1, "a"), (1, "b")], "id int, v string"), path, ["id"])
    assert {r["id"]: r["v"] for r in read_table(spark, path).collect()} == {2: "c", 3: "e"}


def test_batch_ids_are_stamped_with_time():
    first, second = new_batch_id(), new_batch_id()
    assert first != second and len(first) == len("20240101T000000-12345678") and first[8] == "T"


def test_scratch_comes_from_the_session(spark, tmp_path):
    root = scratch_root(spark)
    kept = materialize(spark.range(3), "kept")
    assert kept.count() == 3 and root in kept.inputFiles()[0]
    with materialized(spark.range(2), "gone") as staged:
        folder = os.path.dirname(staged.inputFiles()[0].removeprefix("file://"))
        assert staged.count() == 2 and os.path.isdir(folder)
    assert not os.path.exists(folder)
