"""Tables merged by key: Parquet partitioned by a bucket of the key's hash.

A merge reads and rewrites only the buckets that its changes touch, in one join that Spark plans like any other, and
overwrites just those partitions. Untouched buckets are neither read nor written, so a merge costs as much as the buckets
it meets; the number of buckets is chosen when a table is first written, so that a bucket is a few files.

The touched buckets are first written aside and then put in place. A job that is lost in between leaves the written buckets
with Spark's ``_SUCCESS`` mark, and the next one puts them in place before anything else. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key, row_hash
from tidemark.operators.merge import DELETED, keys_present, live_rows, plan_upsert, plan_versioned, reject_duplicate_keys, with_tombstones
from tidemark.session import delete_path, materialized
from tidemark.sources.tables import list_folders, path_exists

BUCKET = "_bucket"
#: Hash of the row, stored with it: the last tie-breaker, so that comparing versions needs no other columns.
ROW = "_row"
#: Prefixes of the table's folder, which names its number of buckets, and of the one that a merge writes first.
TABLE, STAGED = "of-", "staged-"


def _read(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("mergeSchema", "true").parquet(path)
    return rows.withColumn(BUCKET, F.col(BUCKET).cast("string"))


@dataclass(frozen=True)
class Buckets:
    """A table with ``keys``; with ``version`` columns, changes are versioned and deletes leave tombstones.

    Rows with a NULL in the key never match; they are dealt over the buckets by their other columns.
    """

    path: str
    keys: Sequence[str]
    version: Sequence[str] = ()
    count: int = 16

    def buckets(self, spark: SparkSession) -> int:
        """The number of buckets that the table was first written with, whatever is asked for now."""
        known = [name for name in list_folders(spark, self.path) if name.startswith((TABLE, STAGED))]
        return int(known[0].rpartition("-")[2]) if known else self.count

    def _table(self, spark: SparkSession) -> str:
        return f"{self.path}/{TABLE}{self.buckets(spark)}"

    def _bucket(self, df: DataFrame, count: int) -> Column:
        spread = F.xxhash64(*(self.version or [c for c in df.columns if c not in self.keys] or self.keys))
        of = F.when(keys_present(self.keys), F.xxhash64(*self.keys)).otherwise(spread)
        return F.pmod(of, F.lit(count)).cast("string")

    def state(self, spark: SparkSession, buckets: Sequence[str] | None = None) -> DataFrame | None:
        """The stored rows, of some buckets or all, with versions, tombstones and buckets.

        Buckets that are written and not yet in place are read where they are.
        """
        table, found = self._table(spark), None
        if path_exists(spark, table):
            found = _read(spark, table)
        for name in self._staged(spark):
            moving = [f.partition("=")[2] for f in list_folders(spark, f"{self.path}/{name}")]
            staged = _read(spark, f"{self.path}/{name}")
            found = staged if found is None else found.where(~F.col(BUCKET).isin(moving)).unionByName(staged, allowMissingColumns=True)
        return found if found is None or buckets is None else found.where(F.col(BUCKET).isin(list(buckets)))

    def _staged(self, spark: SparkSession) -> list[str]:
        return [name for name in list_folders(spark, self.path, complete=True) if name.startswith(STAGED)]

    def live(self, spark: SparkSession) -> DataFrame | None:
        """The rows of the table as consumers see them."""
        state = self.state(spark)
        if state is None:
            return None
        return (live_rows(state) if DELETED in state.columns else state).drop(ROW, BUCKET)

    def merge(self, changes: DataFrame, op_col: str = "_op") -> int:
        """Merge one batch of versioned changes, deletes as tombstones; returns how many buckets it touched.

        The highest version of a key wins, so that merging the same changes again, late or in another order leads to
        the same state; no op means no effect.
        """
        flagged = with_tombstones(changes, op_col)
        flagged = flagged.withColumn(ROW, row_hash(flagged.columns))
        order = [*self.version, ROW]
        keyed = latest_per_key(flagged.filter(keys_present(self.keys)), self.keys, order, total=True)
        keyless = flagged.filter(~keys_present(self.keys) & ~F.col(DELETED))
        return self._apply(keyed.unionByName(keyless), lambda state, new: plan_versioned(state, new, self.keys, order))

    def upsert(self, rows: DataFrame) -> int:
        """Update the rows of known keys, insert the others; an error if two of ``rows`` have the same key."""
        reject_duplicate_keys(rows, self.keys)
        return self._apply(rows, lambda state, new: plan_upsert(state, new, self.keys))

    def _apply(self, rows: DataFrame, plan: Callable[[DataFrame | None, DataFrame], DataFrame]) -> int:
        spark = rows.sparkSession
        self.recover(spark)
        count = self.buckets(spark)
        # the changes are read several times
        with materialized(rows.withColumn(BUCKET, self._bucket(rows, count)), "changes") as staged:
            touched = [r[BUCKET] for r in staged.select(BUCKET).distinct().collect()]
            if not touched:
                return 0
            merged = plan(self.state(spark, touched), staged)
            merged.hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/{STAGED}{count}")
        self.recover(spark)
        return len(touched)

    def recover(self, spark: SparkSession) -> None:
        """Put buckets in place that were written and not yet moved; doing so again changes nothing."""
        for name in self._staged(spark):
            staged, table = f"{self.path}/{name}", f"{self.path}/{TABLE}{name.removeprefix(STAGED)}"
            (
                _read(spark, staged)
                .hint("rebalance", BUCKET)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(BUCKET)
                .parquet(table)
            )
            delete_path(spark, staged)
