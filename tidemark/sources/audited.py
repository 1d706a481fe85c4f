"""Write, audit, publish: rules are counted while the rows are written, and a table shows them only if no FAIL rule breaks.

The outcomes that the ordered semantics need are known before the write: for each rule, how many rows break it among those
that pass each choice of the drops before it. These counts are observed by the tasks that write, so the input is read once.
Rows are written apart by the drops they fail; which drops are active is settled afterwards, by folder.
"""

from __future__ import annotations

import time
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.quality import Action, QualityGateError, Rule, Tally, append_audit, evaluate, keep_filter, outcome, percent
from tidemark.session import delete_path
from tidemark.sources.tables import SNAPSHOT, list_folders, mark_complete

# Number of the combination of drops that a row fails: bit i for the i-th drop rule.
FAILED = "_failed_drops"
PART = "part-"
# Counts observed at most; longer rule lists are counted on the written rows.
OBSERVED = 512


def _choices(rules: Sequence[Rule]) -> Iterator[tuple[int, tuple[int, ...]]]:
    """(position of a rule, drops before it that may be active)."""
    drops: list[int] = []
    for position, rule in enumerate(rules):
        for size in range(len(drops) + 1):
            yield from ((position, chosen) for chosen in combinations(drops, size))
        if rule.action is Action.DROP:
            drops.append(position)


def _observed(rules: Sequence[Rule]) -> bool:
    total, factor = 0, 1
    for rule in rules:
        total += factor
        factor *= 2 if rule.action is Action.DROP else 1
    return total <= OBSERVED


def _settle(rules: Sequence[Rule], counts: dict[str, int], fail_pct: float) -> tuple[list[Tally], list[Rule], Tally | None]:
    tallies: list[Tally] = []
    active: list[int] = []
    for position, rule in enumerate(rules):
        tallies.append(Tally(rule, counts["rows"], counts[_name(position, active)]))
        if rule.action is Action.FAIL and percent(tallies[-1]) > fail_pct:
            return tallies, [rules[i] for i in active], tallies[-1]
        if rule.action is Action.DROP and tallies[-1].broken:
            active.append(position)
    return tallies, [rules[i] for i in active], None


def _name(position: int, chosen: Sequence[int]) -> str:
    return "_".join(["broken", str(position), *map(str, chosen)])


def _failed_drops(drops: Sequence[Rule]) -> Column:
    number = F.lit(0)
    for i, rule in enumerate(drops):
        number = number + F.when(keep_filter([rule]), 0).otherwise(1 << i)
    return number


@dataclass(frozen=True)
class Audited:
    """Written rows and what the rules found. ``failed`` is the result that closes the gate."""

    spark: SparkSession
    path: str
    schema: T.StructType
    rules: tuple[Rule, ...]
    tallies: list[Tally]
    active: list[Rule]
    failed: Tally | None

    def _written(self) -> DataFrame:
        return self.spark.read.schema(T.StructType([*self.schema, T.StructField(FAILED, T.IntegerType())])).parquet(self.path)

    def _dropped(self) -> Column:
        drops = [rule for rule in self.rules if rule.action is Action.DROP]
        return F.col(FAILED).bitwiseAND(F.lit(sum(1 << i for i, rule in enumerate(drops) if rule in self.active))) != 0

    def kept(self) -> DataFrame:
        """The rows that pass: a filter on folders, so those of dropped rows are not read."""
        return self._written().filter(~self._dropped()).drop(FAILED)

    def rejected(self) -> DataFrame:
        return self._written().filter(self._dropped()).drop(FAILED)

    def remove_rejected(self) -> None:
        for folder in list_folders(self.spark, self.path):
            drops = [rule for rule in self.rules if rule.action is Action.DROP]
            number = int(folder.partition("=")[2])
            if any(number >> i & 1 for i, rule in enumerate(drops) if rule in self.active):
                delete_path(self.spark, f"{self.path}/{folder}")


def write_audited(
    df: DataFrame, rules: Sequence[Rule], path: str, fail_pct: float = 5.0, null_policy: str = "reference"
) -> Audited:
    """Write ``df`` to ``path`` without marking it complete, and count what breaks the rules on the way.

    The rules mean the same as in ``quality.evaluate``. Counts are exact when tasks are repeated: they are taken in the stage
    that writes. An empty ``df`` breaks nothing. A column named like ``FAILED`` is refused.
    """
    if FAILED in df.columns:
        raise ValueError(f"{FAILED} is the name of a column of the gate")
    spark, rules = df.sparkSession, tuple(rules)
    drops = [rule for rule in rules if rule.action is Action.DROP]
    rows = df.withColumn(FAILED, _failed_drops(drops))
    seen = Observation() if _observed(rules) else None
    if seen is not None:
        counts = [
            F.count_if(keep_filter([rules[i] for i in chosen]) & ~outcome(rules[position].condition, null_policy)).alias(
                _name(position, chosen)
            )
            for position, chosen in _choices(rules)
        ]
        rows = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)
    (
        rows.write.mode("overwrite")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .partitionBy(FAILED)
        .parquet(path)
    )
    if seen is not None:
        settled = _settle(rules, seen.get, fail_pct)
    else:
        written = spark.read.schema(rows.schema).parquet(path)
        tallies, active, failed = evaluate(written, rules, fail_pct, null_policy)
        settled = tallies, active, failed
    return Audited(spark, path, df.schema, rules, *settled)


def audit(written: Audited, table: str, fail_pct: float, environment: str = "dev", audit_path: str | None = None) -> Audited:
    """Record what was found; a failed gate raises and leaves nothing of the written rows."""
    if audit_path:
        append_audit(written.spark, written.tallies, table, environment, audit_path)
    if written.failed:
        delete_path(written.spark, written.path)
        share, name = percent(written.failed), written.failed.rule.name
        raise QualityGateError(f"{table}: {share:.2f}% of the rows break {name}, {fail_pct}% may")
    return written


def _publish(df: DataFrame, rules: Sequence[Rule], path: str, table: str, fail_pct: float, null_policy: str, **audited) -> list[Tally]:
    written = audit(write_audited(df, rules, path, fail_pct, null_policy), table, fail_pct, **audited)
    written.remove_rejected()
    mark_complete(df.sparkSession, path)
    return written.tallies


def publish_gated(
    df: DataFrame,
    rules: Sequence[Rule],
    path: str,
    table: str,
    fail_pct: float = 5.0,
    null_policy: str = "reference",
    keep: int = 2,
    **audited,
) -> list[Tally]:
    """Replace the table at ``path`` by the rows that pass. A failed or lost job leaves the old rows current."""
    tallies = _publish(df, rules, f"{path}/{SNAPSHOT}{time.time_ns():020d}", table, fail_pct, null_policy, **audited)
    for name in list_folders(df.sparkSession, path, complete=True)[:-keep]:
        delete_path(df.sparkSession, f"{path}/{name}")
    return tallies


def read_gated(spark: SparkSession, path: str) -> DataFrame | None:
    """What was published last."""
    complete = [name for name in list_folders(spark, path, complete=True) if name.startswith(SNAPSHOT)]
    return _read(spark, [f"{path}/{complete[-1]}"]) if complete else None


def gate_batches(rules: Sequence[Rule], path: str, table: str, fail_pct: float = 5.0, null_policy: str = "reference", **audited):
    """A function for ``foreachBatch``: each micro-batch is one part of the table and passes the gate whole or not at all.

    A failed gate ends the stream; a batch that comes again replaces its part.
    """

    def gate(batch: DataFrame, number: int) -> None:
        _publish(batch, rules, f"{path}/{PART}{number:020d}", table, fail_pct, null_policy, **audited)

    return gate


def read_parts(spark: SparkSession, path: str) -> DataFrame | None:
    """All parts that passed."""
    complete = [name for name in list_folders(spark, path, complete=True) if name.startswith(PART)]
    return _read(spark, [f"{path}/{name}" for name in complete]) if complete else None


def _read(spark: SparkSession, folders: list[str]) -> DataFrame | None:
    """Folders that hold no rows hold no files either, and nothing to read a schema from."""
    filled = [name for name in folders if list_folders(spark, name)]
    frames = [spark.read.parquet(name).drop(FAILED) for name in filled]
    if not frames:
        return None
    first, *rest = frames
    for other in rest:
        first = first.unionByName(other, allowMissingColumns=True)
    return first
