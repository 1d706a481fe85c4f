from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given
from hypothesis import settings as hyp
from hypothesis import strategies as st

from tidemark.operators.latest import latest_per_key
from tidemark.operators.merge import (
    AmbiguousMergeError,
    live_rows,
    merge_into_catalog,
    plan_merge,
    plan_upsert,
    plan_versioned,
    reconcile_deletes,
    reject_duplicate_keys,
    with_tombstones,
)

SCHEMA = "order_id int, status string, _op string"
RELAXED = hyp(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def state(df):
    return {r["order_id"]: r["status"] for r in df.collect()}


@pytest.mark.parametrize("covered", [False, True])
def test_change_merge(spark, covered):
    held = [(order, "open", "c") for order in range(10, 16)]
    target = plan_merge(None, spark.createDataFrame(held, SCHEMA), ["order_id"])
    changes = [(10, "sent", "u"), (12, None, "u"), (14, "open", "d"), (15, "gone", "d"), (90, "new", "u"), (91, "new", "c")]
    merged = plan_merge(target, spark.createDataFrame(changes, SCHEMA), ["order_id"], covered=covered)
    assert state(merged) == {10: "sent", 11: "open", 12: None, 13: "open", 90: "new", 91: "new"}


def test_null_op_and_unmatched_delete_have_no_effect(spark):
    target = spark.createDataFrame([(1, "a")], "order_id int, status string")
    changes = spark.createDataFrame([(1, "b", None), (2, "c", None), (3, "d", "d")], SCHEMA)
    assert state(plan_merge(target, changes, ["order_id"])) == {1: "a"}


@pytest.mark.parametrize("covered", [False, True])
def test_null_keys_never_match(spark, covered):
    target = spark.createDataFrame([(None, "old"), (1, "a")], "order_id int, status string")
    changes = spark.createDataFrame([(None, "new", "u"), (1, "b", "u")], SCHEMA)
    rows = plan_merge(target, changes, ["order_id"], covered=covered).collect()
    assert sorted((r["order_id"] or 0, r["status"]) for r in rows) == [(0, "new"), (0, "old"), (1, "b")]


@pytest.mark.parametrize("covered", [False, True])
def test_target_only_columns_survive_and_new_columns_arrive(spark, covered):
    target = spark.createDataFrame([(1, "a", "keep"), (2, "b", "keep")], "order_id int, status string, note string")
    source = spark.createDataFrame([(1, "z", 7), (3, "c", 8)], "order_id int, status string, extra int")
    rows = {r["order_id"]: r.asDict() for r in plan_upsert(target, source, ["order_id"], covered).collect()}
    assert rows[1] == {"order_id": 1, "status": "z", "note": "keep", "extra": 7}
    assert rows[2]["note"] == "keep" and rows[2]["extra"] is None
    assert rows[3]["note"] is None and rows[3]["extra"] == 8


def test_duplicate_source_keys_are_rejected(spark):
    twice = spark.createDataFrame([(1, "a"), (1, "b")], "order_id int, status string")
    with pytest.raises(AmbiguousMergeError):
        reject_duplicate_keys(twice, ["order_id"])
    reject_duplicate_keys(spark.createDataFrame([(None, "a"), (None, "b")], "order_id int, status string"), ["order_id"])


def test_versioned_merge_evolves_the_schema(spark):
    target = spark.createDataFrame([(1, "a", "keep", 5), (2, "b", "keep", 5)], "order_id int, status string, note string, at int")
    source = spark.createDataFrame([(1, "z", 7, 6), (2, "old", 7, 4), (3, "c", 8, 1)], "order_id int, status string, extra int, at int")
    rows = {r["order_id"]: r.asDict() for r in plan_versioned(target, source, ["order_id"], ["at"]).collect()}
    assert rows[1] == {"order_id": 1, "status": "z", "note": "keep", "at": 6, "extra": 7}
    assert rows[2] == {"order_id": 2, "status": "b", "note": "keep", "at": 5, "extra": None}
    assert rows[3]["note"] is None and rows[3]["extra"] == 8


def test_catalog_merge_is_refused_by_plain_tables(spark, tmp_path):
    spark.createDataFrame([(1, "a")], "order_id int, status string").write.option("path", str(tmp_path / "t")).saveAsTable("plain_orders")
    try:
        with pytest.raises(Exception, match="MERGE"):
            merge_into_catalog(spark.createDataFrame([(1, "b", "u")], SCHEMA), "plain_orders", ["order_id"])
    finally:
        spark.sql("DROP TABLE plain_orders")


def test_reconcile(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "order_id int, status string")
    gone = reconcile_deletes(target, spark.createDataFrame([(2,)], "order_id int"), ["order_id"])
    assert [(r["order_id"], r["_op"]) for r in gone.collect()] == [(1, "d")]


changes = st.lists(st.tuples(st.integers(0, 5), st.sampled_from(["x", "y", "z"]), st.sampled_from(["c", "u", "d"])), min_size=1, max_size=25)


@RELAXED
@given(changes)
def test_merge_is_a_replay(spark, events):
    """Merging the collapsed changes of each half in turn equals replaying all of them on a dict."""
    expected: dict[int, str] = {}
    for key, status, op in events:
        if op == "d":
            expected.pop(key, None)
        else:
            expected[key] = status
    rows = [(*event, position) for position, event in enumerate(events)]
    target = None
    for part in (rows[: len(rows) // 2], rows[len(rows) // 2 :]):
        df = spark.createDataFrame(part, SCHEMA + ", at int")
        target = plan_merge(target, latest_per_key(df, ["order_id"], ["at"]).drop("at"), ["order_id"])
    assert state(target) == expected


@RELAXED
@given(changes, st.randoms(use_true_random=False))
def test_versioned_merge_ignores_arrival_order(spark, events, rng):
    rows = [(*event, position) for position, event in enumerate(events)]
    expected: dict[int, str] = {}
    for key, status, op, _ in rows:
        expected.pop(key, None)
        if op != "d":
            expected[key] = status
    shuffled = rows + rows[:3]
    rng.shuffle(shuffled)
    table = None
    for start in range(0, len(shuffled), 10):
        batch = spark.createDataFrame(shuffled[start : start + 10], SCHEMA + ", at int")
        table = plan_versioned(table, with_tombstones(batch), ["order_id"], ["at"])
    assert state(live_rows(table)) == expected
