from __future__ import annotations

import random

from tidemark.operators.latest import latest_per_key


def test_keeps_the_newest(spark):
    readings = [("north", 4.0, 11), ("north", 6.5, 47), ("north", 5.0, 30), ("south", 1.5, 2)]
    df = spark.createDataFrame(readings, "station string, level double, minute long")
    assert sorted(tuple(r) for r in latest_per_key(df, ["station"], ["minute"]).collect()) == [readings[1], readings[3]]


def test_later_columns_break_ties(spark):
    rows = [(7, "x", "first", 9, 1), (7, "x", "second", 9, 3), (7, "x", "third", 8, 5), (7, "y", "other", 1, 1)]
    df = spark.createDataFrame(rows, "a int, b string, note string, at int, seq int")
    assert sorted(r["note"] for r in latest_per_key(df, ["a", "b"], ["at", "seq"]).collect()) == ["other", "second"]


def test_nulls_order_last_and_null_keys_group(spark):
    rows = [(1, "a", None), (1, "b", 5), (None, "c", 1), (None, "d", 2)]
    out = latest_per_key(spark.createDataFrame(rows, "id int, payload string, ts int"), ["id"], ["ts"])
    assert sorted(r["payload"] for r in out.collect()) == ["b", "d"]


def test_ties_do_not_depend_on_order_or_partitioning(spark):
    rows = [(i % 3, f"v{i}", 7) for i in range(60)]
    seen = set()
    for seed, parts in ((1, 1), (2, 3), (3, 8)):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "id int, payload string, ts int").repartition(parts)
        seen.add(tuple(sorted(tuple(r) for r in latest_per_key(df, ["id"], ["ts"]).collect())))
    assert len(seen) == 1
