"""A live table of the latest row of each key: keyed state over a stream of row versions.

The state is kept in parts: the newest versions of all keys with the same hash place are one stored Arrow table, and the
rows of a micro-batch reach it as Arrow tables too. So Python is called for a group of places and not for each key, and a
micro-batch reads and writes the parts it meets.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tidemark.session import materialized
from tidemark.sources.buckets import Buckets

# Tasks get these functions by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
DAY_MS = 24 * 3600 * 1000
# Groups of keys that the state is dealt by, and parts of a group that are read and written as one. A checkpoint holds to them.
GROUPS, PARTS = 1024, 4
# Rows, and bytes of them, that a task brings together before it sends them on by group.
HELD_ROWS, HELD_BYTES = 1 << 20, 1 << 26
PLACE, SEEN = "_place", "_seen"


def _packed(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as out:
        out.write_table(rows)
    return sink.getvalue().to_pybytes()


def _unpacked(stored: Iterable[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(pa.py_buffer(bytes(one))).read_all() for one in stored])


def _ordered(column: pa.ChunkedArray) -> np.ndarray:
    """Numbers in the order of the values."""
    if pa.types.is_integer(column.type) or pa.types.is_timestamp(column.type):
        return column.cast(pa.int64()).to_numpy()
    return pc.rank(column.combine_chunks(), "ascending", tiebreaker="dense").to_numpy()


def newest_of(rows: pa.Table, keys: Sequence[str], version: Sequence[str]) -> np.ndarray:
    """The place of each key's newest row, the first of equal ones. A NULL in a key is a value as any other."""
    key = np.zeros(len(rows), np.int64)
    for name in keys:
        coded = rows[name].combine_chunks().dictionary_encode(null_encoding="encode")
        key = np.unique(key * len(coded.dictionary) + coded.indices.to_numpy(), return_inverse=True)[1]
    order = np.lexsort((-np.arange(len(rows)), *(_ordered(rows[name]) for name in reversed(version)), key))
    return np.sort(order[np.flatnonzero(np.diff(key[order], append=-1))])


def _dealt(keys: Sequence[str], version: Sequence[str]):
    """A task over rows: (group, the newest of them for each key of the group), of as many rows as it may hold."""

    def sent(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        rows = rows.take(newest_of(rows, keys, version))
        group = rows[PLACE].to_numpy() // PARTS
        order = np.argsort(group, kind="stable")
        rows, group = rows.take(order).combine_chunks(), group[order]
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        packed = [_packed(rows.slice(a, b - a)) for a, b in zip(starts, [*starts[1:], len(rows)])]
        return pa.RecordBatch.from_arrays([pa.array(group[starts].astype(np.int32)), pa.array(packed, pa.binary())], ["_group", "_rows"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) >= HELD_ROWS or sum(b.nbytes for b in held) >= HELD_BYTES:
                yield sent(held)
                held = []
        if sum(map(len, held)):
            yield sent(held)

    return deal


def _rows_again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for packed in batch.column(0):
            yield from _unpacked([packed.as_py()]).to_batches()


class NewestVersions(StatefulProcessor):
    """Remembers the newest version of each key of a group and lets rows pass only if they are newer.

    The state is the versions alone, not the rows: what is kept for a key is a few numbers, in RocksDB and so not in
    memory, for ``days`` after the key's last change. A version that comes after that is taken for new; the table it is
    merged into compares versions too, so that an old row doesn't win there either.
    """

    def __init__(self, columns: Sequence[str], keys: Sequence[str], version: Sequence[str], days: int):
        self.columns, self.keys, self.version, self.days = list(columns), list(keys), list(version), days

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getMapState("newest", "part int", "versions binary", self.days * DAY_MS)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        now, kept = timerValues.getCurrentProcessingTimeInMs(), [*self.keys, *self.version, PLACE]
        new = _unpacked(row["_rows"] for row in rows)
        stored = (self.newest.getValue((int(part),)) for part in np.unique(new[PLACE].to_numpy() % PARTS))
        held = [_unpacked([one[0]]) for one in stored if one is not None]
        both, seen = new.select(kept), np.full(len(new), now)
        if held:
            before = pa.concat_tables(held)
            before = before.filter(pc.greater(before[SEEN], now - self.days * DAY_MS))
            seen = np.concatenate([before[SEEN].to_numpy(), seen])
            both = pa.concat_tables([before.select(kept).cast(both.schema), both])
        chosen, known = newest_of(both, self.keys, self.version), len(both) - len(new)
        fresh = chosen[chosen >= known]
        if not len(fresh):
            return
        versions = both.append_column(SEEN, pa.array(seen, pa.int64())).take(chosen)
        part = versions[PLACE].to_numpy() % PARTS
        for changed in np.unique(part[chosen >= known]):
            self.newest.updateValue((int(changed),), (_packed(versions.filter(part == changed).combine_chunks()),))
        yield Row(_rows=_packed(new.select(self.columns).take(fresh - known)))

    def close(self) -> None:
        pass


@contextmanager
def _state_store(spark: SparkSession):
    """Arbitrary keyed state needs the RocksDB store; a query keeps the setting that it was started with."""
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(PROVIDER, before)


def newest_rows(stream: DataFrame, keys: Sequence[str], version: Sequence[str], days: int = 90) -> DataFrame:
    """The rows of ``stream`` that are newer than all rows of their key before, one for each key and micro-batch.

    Rows with a NULL in their version are left out, those with a NULL in the key are a key of their own. Rows equal in
    key and version are the same row given twice.
    """
    # times as numbers, which any zone orders alike
    parts = {f"_v{n}": F.unix_micros(c) if stream.schema[c].dataType == T.TimestampType() else F.col(c) for n, c in enumerate(version)}
    place = F.pmod(F.xxhash64(*keys), F.lit(GROUPS * PARTS)).alias(PLACE)
    whole = reduce(and_, (F.col(c).isNotNull() for c in version))
    marked = stream.filter(whole).select("*", *[c.alias(name) for name, c in parts.items()], place)
    dealt = marked.mapInArrow(_dealt(list(keys), list(parts)), "_group int, _rows binary")
    newest = dealt.groupBy("_group").transformWithState(
        statefulProcessor=NewestVersions(stream.columns, keys, list(parts), days),
        outputStructType=T.StructType([T.StructField("_rows", T.BinaryType())]),
        outputMode="Update",
        timeMode="ProcessingTime",
    )
    return newest.mapInArrow(_rows_again, stream.schema)


def start_serving(
    stream: DataFrame,
    table: Buckets,
    checkpoint: str,
    days: int = 90,
    once: bool = False,
    interval: str = "30 seconds",
) -> StreamingQuery:
    """Keep ``table`` at the newest row of each of its keys. State is dealt by key over the shuffle partitions.

    ``once`` takes all that is there in one batch and ends. (State that ages by the clock asks for a next batch without
    end, so that a drain in several batches would not.)
    """
    spark = stream.sparkSession

    def put(batch: DataFrame, epoch: int) -> None:
        # a merge reads its changes twice, and the state would be worked through each time
        with materialized(batch.withColumn("_op", F.lit("u")), "newest") as rows:
            table.merge(rows)

    trigger = {"once": True} if once else {"processingTime": interval}
    with _state_store(spark):
        newest = newest_rows(stream, table.keys, table.version, days)
        writer = newest.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint)
        return writer.trigger(**trigger).start()


def served(spark: SparkSession, table: Buckets, as_of: str, updated_col: str = "updated_at", days: int = 90) -> DataFrame | None:
    """The table's rows within the retention before ``as_of``."""
    live = table.live(spark)
    if live is None:
        return None
    return live.where(F.col(updated_col) >= F.lit(as_of).cast("timestamp") - F.make_dt_interval(F.lit(days)))
