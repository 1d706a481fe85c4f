"""Keyed merges as plans: the new state of a table from its old state and a set of changes.

Both sides of every join are unique per key, so a join never multiplies rows. Change keys are joined
without a hint: a small change set is broadcast once its size is known, and then the table is not shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.latest import latest_per_key

DELETED = "_deleted"


class AmbiguousMergeError(ValueError):
    """Several source rows address one target row."""


def keys_present(keys: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, (F.col(k).isNotNull() for k in keys))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once. Rows with a NULL in the key never match, hence never clash."""
    counts = df.filter(keys_present(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return counts.filter("copies > 1")


def reject_duplicate_keys(df: DataFrame, keys: Sequence[str]) -> None:
    clash = duplicate_keys(df, keys).take(1)
    if clash:
        raise AmbiguousMergeError(f"{clash[0]['copies']} source rows for key {clash[0].asDict()}")


def _keep_target_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """An update leaves columns alone that the source does not have."""
    extra = [c for c in target.columns if c not in source.columns]
    if not extra:
        return source
    matched = target.filter(keys_present(keys)).select(*keys, *extra)
    return source.join(matched, list(keys), "left")


def _survivors(target: DataFrame, touched: DataFrame, keys: Sequence[str], covered: bool) -> DataFrame:
    """Target rows that no touched key matches.

    ``covered``: most of the target is touched. Then the few remaining keys are found on key columns alone
    and pick their rows, so that the wide rows about to be replaced are not shuffled first.
    """
    if not covered:
        return target.join(touched, list(keys), "left_anti")
    remaining = target.filter(keys_present(keys)).select(*keys).join(touched, list(keys), "left_anti")
    return target.join(remaining, list(keys), "left_semi").unionByName(target.filter(~keys_present(keys)))


def plan_upsert(
    target: DataFrame | None, source: DataFrame, keys: Sequence[str], covered: bool = False
) -> DataFrame:
    """Matched rows updated, others inserted, nothing deleted; new source columns are added."""
    if target is None:
        return source
    survivors = _survivors(target, source.select(*keys), keys, covered)
    incoming = _keep_target_only(target, source, keys)
    return survivors.unionByName(incoming, allowMissingColumns=True)


def plan_merge(
    target: DataFrame | None, changes: DataFrame, keys: Sequence[str], op_col: str = "_op", covered: bool = False
) -> DataFrame:
    """Matched and ``d``: delete. Matched, other: update. Unmatched, other: insert. NULL op: no effect."""
    effective = changes.filter(F.col(op_col).isNotNull())
    incoming = effective.filter(F.col(op_col) != "d").drop(op_col)
    if target is None:
        return incoming
    survivors = _survivors(target, effective.select(*keys), keys, covered)
    return survivors.unionByName(_keep_target_only(target, incoming, keys), allowMissingColumns=True)


def plan_versioned(
    state: DataFrame | None, changes: DataFrame, keys: Sequence[str], version_cols: Sequence[str]
) -> DataFrame:
    """State with tombstones after ``changes``: per key the highest version wins, whatever came in first.

    Late, repeated and reordered changes therefore lead to the same state; ``version_cols`` must leave no
    ties between different rows. The state is read once for the wanted columns and once for its keys, and
    is not shuffled as long as the changed keys are few enough to broadcast. Rows with a NULL in the key
    never match; they are told apart by their version.
    """
    keyed, keyless = changes.filter(keys_present(keys)), changes.filter(~keys_present(keys))
    latest = latest_per_key(keyed, keys, version_cols, total=True)
    identity = [*keys, *version_cols]
    keyless = keyless.dropDuplicates(identity)
    if state is None:
        return latest.unionByName(keyless)

    shared = [c for c in state.columns if c in changes.columns]
    added = [c for c in changes.columns if c not in state.columns]
    # Separate columns, not one struct: what a reader does not want is not read from the changes either.
    incoming = latest.select(
        *keys, F.lit(True).alias("_found"), *[F.col(c).alias(f"_new_{c}") for c in latest.columns if c not in keys]
    )
    theirs = F.struct(*[F.col(f"_new_{c}").alias(c) for c in version_cols])
    newer = F.col("_found").isNotNull() & (theirs > F.struct(*version_cols))
    updated = state.join(incoming, list(keys), "left").withColumn("_beaten", newer)
    settled = updated.select(
        *keys,
        *[F.when(F.col("_beaten"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in shared if c not in keys],
        *[c for c in state.columns if c not in shared],
        *[F.when(F.col("_beaten"), F.col(f"_new_{c}")).alias(c) for c in added],
    )
    known = state.select(*keys).join(latest.select(*keys), list(keys), "left_semi")
    inserted = latest.join(known, list(keys), "left_anti")

    held = state.filter(~keys_present(keys)).select(*[F.col(c).alias(f"_held_{c}") for c in identity])
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_held_{c}")) for c in identity))
    fresh = keyless.join(held, same, "left_anti")
    return settled.unionByName(inserted, allowMissingColumns=True).unionByName(fresh, allowMissingColumns=True)


def with_tombstones(changes: DataFrame, op_col: str = "_op") -> DataFrame:
    """Deletes become flagged rows; changes without an op have no effect and go."""
    return changes.filter(F.col(op_col).isNotNull()).withColumn(DELETED, F.col(op_col) == "d").drop(op_col)


def live_rows(state: DataFrame) -> DataFrame:
    return state.filter(~F.col(DELETED)).drop(DELETED)


def reconcile_deletes(target: DataFrame, source_keys: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete changes for target rows that the source no longer has."""
    gone = target.filter(keys_present(keys)).join(source_keys.select(*keys), list(keys), "left_anti")
    return gone.withColumn("_op", F.lit("d"))


def merge_into_catalog(changes: DataFrame, table: str, keys: Sequence[str], op_col: str = "_op") -> None:
    """The same merge through the catalog, for table formats with row-level operations."""
    columns = {c: F.col(f"s.{c}") for c in changes.columns if c != op_col}
    on = reduce(lambda a, b: a & b, (F.col(f"{table}.{k}") == F.col(f"s.{k}") for k in keys))
    op = F.col(f"s.{op_col}")
    (
        changes.alias("s")
        .mergeInto(table, on)
        .whenMatched(op == "d")
        .delete()
        .whenMatched(op != "d")
        .update(columns)
        .whenNotMatched(op != "d")
        .insert(columns)
        .merge()
    )
