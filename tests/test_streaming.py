from __future__ import annotations

import json
import random
from datetime import datetime
from pathlib import Path
from types import SimpleNamespace

import pyarrow as pa
import pytest
from pyspark.sql import Row
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQueryException

from tidemark.operators.merge import AmbiguousMergeError
from tidemark.sources.buckets import Buckets
from tidemark.streaming import serving
from tidemark.streaming.cdc import CUSTOMERS, ORDERS, TableSpec, await_all, change_stream, read_live, serving_view, start_cdc
from tidemark.streaming.envelope import ORDER_CASTS, ORDER_ROW, unwrap
from tidemark.streaming.serving import served, start_serving


def files_of(path):
    return {str(f) for f in Path(path).rglob("*.parquet")}


def order(key, status, op, ts, lsn=None, wrapped=False, amount="1.50"):
    row = {"order_id": key, "customer_id": 1, "status": status, "amount": amount, "currency": "USD", "updated_at": "2024-01-01T00:00:00Z"}
    before, after = (row, None) if op == "d" else (None, row)
    record = {"before": before, "after": after, "op": op, "ts_ms": ts, "source": {"lsn": lsn, "table": "orders"}}
    return json.dumps({"payload": record} if wrapped else record)


@pytest.fixture
def drain(spark, tmp_path):
    """Runs the change stream over everything in the inbox, one file per micro-batch."""
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    target = str(tmp_path / "table")
    files = iter(range(1000))

    def run(*batches, spec: TableSpec = ORDERS, buckets=4):
        for lines in batches:
            (inbox / f"{next(files):04d}.txt").write_text("\n".join(lines) + "\n")
        stream = change_stream(spark, "text", str(inbox), maxFilesPerTrigger="1", latestFirst="false")
        query = start_cdc(stream, spec, target, str(tmp_path / "checkpoint"), once=True, buckets=buckets)
        await_all([query], 1)
        live = read_live(spark, target, spec)
        return {} if live is None else {r["order_id"]: r["status"] for r in live.collect()}

    run.target = target
    return run


def test_unwrap_both_shapes_and_garbage(spark):
    lines = [order(1, "a", "c", 5, 9), order(2, "b", "d", 6, 10, wrapped=True), "no json", "{}", order(3, "c", "u", 7, amount="x")]
    rows = unwrap(spark.createDataFrame([(line,) for line in lines], "value string"), ORDER_ROW, ORDER_CASTS).collect()
    assert [(r["order_id"], r["_op"], r["_event_ts_ms"], r["_lsn"]) for r in rows] == [
        (1, "c", 5, 9), (2, "d", 6, 10), (None, None, None, None), (None, None, None, None), (3, "u", 7, None),
    ]
    assert str(rows[0]["amount"]) == "1.50" and rows[4]["amount"] is None and rows[0]["updated_at"].year == 2024


def test_bytes_values_are_read_too(spark):
    df = spark.createDataFrame([(bytearray(order(1, "a", "c", 5), "utf8"),)], "value binary")
    assert unwrap(df, ORDER_ROW, ORDER_CASTS).first()["order_id"] == 1


def test_upserts_deletes_and_reinserts(drain):
    assert drain([order(1, "created", "c", 1), order(2, "created", "c", 1, wrapped=True)]) == {1: "created", 2: "created"}
    assert drain([order(1, "paid", "u", 2), order(2, "created", "d", 2), order(3, "created", "r", 2)]) == {1: "paid", 3: "created"}
    assert drain([order(2, "again", "c", 3)]) == {1: "paid", 2: "again", 3: "created"}


def test_restart_reads_nothing_twice(drain, spark):
    drain([order(1, "a", "c", 1)])
    before = files_of(drain.target)
    assert drain() == {1: "a"}
    assert files_of(drain.target) == before


def test_late_and_repeated_events_do_not_win(drain):
    batches = [[order(1, "late", "u", 3)], [order(1, "early", "c", 1)], [order(1, "late", "u", 3)], [order(2, "x", "d", 9)], [order(2, "x", "c", 8)]]
    assert drain(*batches) == {1: "late"}


def test_equal_times_are_ordered_by_log_position(drain):
    assert drain([order(1, "second", "u", 5, 20), order(1, "first", "u", 5, 10)], [order(1, "zeroth", "u", 5, 1)]) == {1: "second"}


def test_garbage_is_ignored_and_keyless_changes_are_inserted(drain, spark):
    assert drain(["garbage", json.dumps({"op": "u", "after": {"status": "x"}}), order(1, "a", "c", 1)]) == {1: "a", None: "x"}
    assert ORDERS.table(drain.target).state(spark).count() == 2


def test_batches_rewrite_their_buckets_alone(drain, spark):
    batches = [[order(k, f"s{n}", "d" if (k + n) % 5 == 0 else "u", n) for k in range(6)] for n in range(1, 8)]
    assert drain(*batches) == {k: "s7" for k in range(6) if (k + 7) % 5}
    before = files_of(drain.target)
    state = drain([order(0, "after", "u", 99)], buckets=32)  # the table keeps its number of buckets
    assert state[0] == "after"
    changed = {Path(f).parent for f in before ^ files_of(drain.target)}
    assert len(changed) == 1 < len({Path(f).parent for f in before})


def test_a_lost_move_is_made_up_for(spark, tmp_path, monkeypatch):
    table = Buckets(str(tmp_path / "t"), ["k"], ["at"], 4)
    rows = lambda at, value: spark.createDataFrame([(k, value, at, "u") for k in range(20)], "k long, v string, at long, _op string")
    table.merge(rows(1, "old"))
    with monkeypatch.context() as patched:
        patched.setattr(Buckets, "recover", lambda self, spark: None)
        table.merge(rows(2, "new").where("k < 7"))
    seen = lambda: {r["k"]: r["v"] for r in table.live(spark).collect()}
    assert seen() == {k: "new" if k < 7 else "old" for k in range(20)}
    table.merge(rows(3, "newer").where("k = 8"))
    assert seen() == {k: "newer" if k == 8 else "new" if k < 7 else "old" for k in range(20)}
    assert not [f for f in (tmp_path / "t").iterdir() if f.name.startswith("staged")]


def test_tables_of_nothing_and_of_more_columns(spark, tmp_path):
    table = Buckets(str(tmp_path / "t"), ["k"], count=4)
    assert table.live(spark) is None and table.upsert(spark.createDataFrame([], "k long, v string")) == 0
    table.upsert(spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (None, "d")], "k long, v string"))
    table.upsert(spark.createDataFrame([(2, "e", 5)], "k long, v string, w int"))
    assert {(r.k, r.v, r.w) for r in table.live(spark).collect()} == {(1, "a", None), (2, "e", 5), (None, "c", None), (None, "d", None)}
    with pytest.raises(AmbiguousMergeError):
        table.upsert(spark.createDataFrame([(2, "e"), (2, "f")], "k long, v string"))


def test_a_failing_query_surfaces(spark, tmp_path):
    inbox = tmp_path / "inbox"
    inbox.mkdir()
    (inbox / "a.txt").write_text(order(1, "a", "c", 1))
    broken = TableSpec("orders", ORDER_ROW, ("no_such_key",), ORDER_CASTS)
    queries = [
        start_cdc(change_stream(spark, "text", str(inbox)), spec, str(tmp_path / spec.name), str(tmp_path / f"c-{n}"), once=False, interval="1 second")
        for n, spec in enumerate((broken, CUSTOMERS))
    ]
    with pytest.raises(StreamingQueryException):
        await_all(queries, 1)
    assert not any(q.isActive for q in queries)


def test_serving_view(spark):
    rows = [(1, "old", "2024-05-01 00:00:00.123456"), (1, "new", "2024-05-02 00:00:00.123456"), (2, "gone", "2024-01-01 00:00:00")]
    orders = spark.createDataFrame(rows, "order_id int, status string, updated_at string").select(
        "order_id", "status", F.col("updated_at").cast("timestamp").alias("updated_at"), F.lit(1).alias("customer_id"),
        F.lit("s").alias("segment"), F.lit("c").alias("country"), F.lit("2.50").cast("decimal(12,2)").alias("amount"),
    )
    out = serving_view(orders, "2024-05-30 00:00:00").collect()
    assert [(r["status"], r["amount"], r["updated_at"].microsecond) for r in out] == [("new", 2.5, 123000)]


def test_served_rows_are_the_newest_whatever_the_order(spark, tmp_path):
    """Late, repeated, keyless and incomplete rows; a restart without new rows changes nothing."""
    schema = "k long, v string, at timestamp, n long"
    inbox, checkpoint = str(tmp_path / "in"), str(tmp_path / "checkpoint")
    table = Buckets(str(tmp_path / "t"), ["k"], ["at", "n"], 2)
    day = lambda d: datetime(2024, 1, d)
    batches = [
        [(1, "first", day(1), 1), (1, "third", day(3), 1), (2, "b", day(2), 1), (3, "no version", None, 1)],
        [(1, "second", day(2), 1), (1, "third", day(3), 1), (2, "tie", day(2), 2), (None, "keyless", day(4), 1), (4, "old", day(1), 1)],
        [],
    ]
    for rows in batches:
        if rows:
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        before = files_of(tmp_path / "t") if table.live(spark) is not None else set()
        start_serving(spark.readStream.schema(schema).parquet(inbox), table, checkpoint, once=True).awaitTermination()
    assert files_of(tmp_path / "t") == before
    assert {(r.k, r.v) for r in table.live(spark).collect()} == {(1, "third"), (2, "tie"), (None, "keyless"), (4, "old")}
    assert {r.k for r in served(spark, table, "2024-01-31", "at", days=29).collect()} == {1, 2, None}


def test_the_serving_query_writes_its_batches_in_several_tasks(spark, tmp_path, monkeypatch):
    from tidemark.plans import catalog

    rows = "id AS o_orderkey, id AS o_custkey, 'O' AS o_orderstatus, 1.0D AS o_totalprice, TIMESTAMP_NTZ '2001-07-01 00:00:00' AS o_orderdate"
    spark.range(200).selectExpr(*rows.split(", ")).coalesce(1).write.parquet(f"{tmp_path}/orders.parquet")
    monkeypatch.setattr(catalog, "scratch_path", lambda spark, label: f"{tmp_path}/{label}")
    assert catalog.QUERIES["serving_stream"](spark, str(tmp_path)).count() == 200
    assert len(list(tmp_path.glob("serving-inbox/*.parquet"))) > 2


class Parts(dict):
    """State as a processor sees it, with the calls counted."""

    calls = 0

    def getValue(self, key):
        self.calls += 1
        return self.get(key)

    def updateValue(self, key, value):
        self.calls += 1
        self[key] = value


def passed_on(state, rows, now, days=90):
    """What passes of rows of (key, version 1, version 2), all of one group."""
    columns = {"k": [r[0] for r in rows], "v": [r[1] for r in rows], "w": [r[2] for r in rows], "_place": [len(str(r[0])) % serving.PARTS for r in rows]}
    table = pa.table(columns, pa.schema([("k", pa.string()), ("v", pa.int64()), ("w", pa.string()), ("_place", pa.int64())]))
    processor = serving.NewestVersions(["k", "v", "w"], ["k"], ["v", "w"], days)
    processor.newest = state
    halves = [Row(_rows=serving._packed(table.slice(a, b))) for a, b in ((0, len(rows) // 2), (len(rows) // 2, None))]
    timer = SimpleNamespace(getCurrentProcessingTimeInMs=lambda: now)
    return [(r["k"], r["v"], r["w"]) for out in processor.handleInputRows((0,), iter(halves), timer) for r in serving._unpacked([out["_rows"]]).to_pylist()]


def test_state_is_read_and_written_in_parts_and_not_by_key():
    rng, state, held = random.Random(4), Parts(), {}
    for batch in range(6):
        rows = [(rng.choice([None, *map(str, range(0, 9000, 3))]), rng.randrange(4), rng.choice("ab")) for _ in range(4000)]
        best = {}
        for row in rows:
            if row[1:] > best.get(row[0], held.get(row[0], (-1, ""))):
                best[row[0]] = row[1:]
        state.calls = 0
        got = passed_on(state, rows, batch)
        assert sorted(got, key=str) == sorted(((k, *v) for k, v in best.items()), key=str)
        assert state.calls <= 2 * serving.PARTS
        held |= best


def test_versions_are_forgotten_days_after_their_keys_last_change():
    state, day = Parts(), serving.DAY_MS
    assert passed_on(state, [("a", 5, "x"), ("b", 5, "x")], 0) == [("a", 5, "x"), ("b", 5, "x")]
    assert passed_on(state, [("a", 6, "x"), ("b", 4, "x")], 50 * day) == [("a", 6, "x")]
    assert passed_on(state, [("a", 3, "x"), ("b", 3, "x")], 90 * day) == [("b", 3, "x")]
    assert passed_on(state, [("a", 3, "x"), ("b", 3, "x")], 140 * day) == [("a", 3, "x")]


def test_newest_rows_by_keys_of_several_columns_and_any_order():
    rng = random.Random(8)
    rows = [(rng.choice([None, 1, 2]), rng.choice([None, "p", "q"]), rng.choice("zyx"), datetime(2024, 1, rng.randrange(1, 4))) for _ in range(60)]
    table = pa.table({name: pa.array([r[n] for r in rows]) for n, name in enumerate("abcd")})
    best = {}
    for n, (a, b, c, d) in enumerate(rows):
        if (a, b) not in best or (d, c) > best[a, b][0]:
            best[a, b] = (d, c), n
    assert serving.newest_of(table, ["a", "b"], ["d", "c"]).tolist() == sorted(n for _, n in best.values())


def test_a_batch_goes_through_the_state_once(spark, tmp_path, monkeypatch):
    merged = []
    monkeypatch.setattr(Buckets, "merge", lambda self, changes: merged.append(len(changes.inputFiles())))
    inbox, schema = str(tmp_path / "in"), "k long, at long"
    spark.createDataFrame([(1, 1), (2, 1), (2, 2)], schema).write.parquet(inbox)
    stream = spark.readStream.schema(schema).parquet(inbox)
    start_serving(stream, Buckets(str(tmp_path / "t"), ["k"], ["at"], 2), str(tmp_path / "c"), once=True).awaitTermination()
    assert merged and all(merged)
