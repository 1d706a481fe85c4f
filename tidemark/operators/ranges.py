"""Two sides of a table compared by digests of key ranges, so that only ranges that differ are read further.

A digest is the same whatever the order of the rows: their number, the exclusive or and the sum of their keys' hashes.
Ranges whose digests agree on both sides hold the same keys; the others are cut finer, level by level, with the range
as a filter that reaches the scan. Only digests come to the driver, at most ``MAX_RANGES`` of them a level.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.merge import keys_present

Range = tuple[int, int]

#: Ranges that one range is cut into, levels of cutting, and differing ranges kept apart at most.
FANOUT, LEVELS, MAX_RANGES = 64, 3, 256
#: Ranges of so few rows on both sides are not cut any finer.
LEAF_ROWS = 10_000


def _whole(df: DataFrame, key: str) -> bool:
    return isinstance(df.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))


def _hash(df: DataFrame, keys: Sequence[str]) -> Column:
    """Integers of all widths hash alike."""
    return F.xxhash64(*[F.col(k).cast("bigint") if _whole(df, k) else F.col(k) for k in keys])


def position(df: DataFrame, keys: Sequence[str]) -> Column:
    """Where a key lies: the first key itself if it is an integer, else a hash of all of them.

    Only integers order the stored rows so that files and row groups outside a range can be skipped.
    """
    return F.col(keys[0]) if _whole(df, keys[0]) else _hash(df, keys)


def within(at: Column, ranges: Sequence[Range]) -> Column:
    return reduce(lambda a, b: a | b, ((at >= low) & (at <= high) for low, high in ranges), F.lit(False))


def cut(whole: Range, parts: int) -> list[Range]:
    """The range in at most ``parts`` ranges of equal width."""
    low, high = whole
    width = -(-(high - low + 1) // parts)
    return [(start, min(start + width - 1, high)) for start in range(low, high + 1, width)]


def joined(ranges: Sequence[Range], most: int) -> list[Range]:
    """Neighbouring ranges as one; beyond ``most``, those with the smallest gaps between them too."""
    out = [ranges[0]] if ranges else []
    for low, high in ranges[1:]:
        if low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], high)
        else:
            out.append((low, high))
    while len(out) > most:
        gaps = sorted(range(1, len(out)), key=lambda i: out[i][0] - out[i - 1][1])
        closed = set(gaps[: len(out) - most])
        merged = [out[0]]
        for i in range(1, len(out)):
            if i in closed:
                merged[-1] = (merged[-1][0], out[i][1])
            else:
                merged.append(out[i])
        out = merged
    return out


def digests(df: DataFrame, keys: Sequence[str], ranges: Sequence[Range]) -> DataFrame:
    """(range, n, mixed, total) of every range that holds rows; ``ranges`` are ascending and apart.

    One scan of the key columns, summed up before the shuffle.
    """
    at = position(df, keys)
    lows = F.array(*[F.lit(low).cast("bigint") for low, _ in ranges])
    highs = F.array(*[F.lit(high).cast("bigint") for _, high in ranges])
    # The last range that starts at or before the key is the one that may hold it.
    found = F.size(F.filter(lows, lambda low: low <= at)) - 1
    return (
        df.filter(keys_present(keys))
        .filter(within(at, joined(ranges, MAX_RANGES)))
        .select(at.alias("_at"), _hash(df, keys).alias("_hash"), found.alias("range"))
        .filter(F.col("_at") <= F.get(highs, F.col("range")))
        .groupBy("range")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.bit_xor("_hash").alias("mixed"),
            F.sum(F.col("_hash").cast("decimal(20,0)")).alias("total"),
        )
    )


def _differing(ours: DataFrame, theirs: DataFrame, keys: Sequence[str], ranges: Sequence[Range]) -> list[tuple[Range, int]]:
    """The ranges whose digests differ, ascending, with the larger number of rows of both sides."""
    sides = [{row["range"]: tuple(row) for row in digests(side, keys, ranges).collect()} for side in (ours, theirs)]
    out = []
    for number, bounds in enumerate(ranges):
        one, two = (side.get(number) for side in sides)
        if one != two:
            out.append((bounds, max(side[1] for side in (one, two) if side)))
    return out


def differing_ranges(
    ours: DataFrame, theirs: DataFrame, keys: Sequence[str], fanout: int = FANOUT, levels: int = LEVELS, leaf_rows: int = LEAF_ROWS
) -> list[Range]:
    """Ranges of ``position`` outside which both sides hold the same keys as often; at most ``MAX_RANGES``.

    Rows with a NULL in the key are on neither side.
    """
    if _whole(ours, keys[0]) != _whole(theirs, keys[0]):
        raise TypeError(f"the sides have keys of other kinds: {ours.schema[keys[0]].dataType}, {theirs.schema[keys[0]].dataType}")
    ends = [
        side.filter(keys_present(keys)).agg(F.min(position(side, keys)), F.max(position(side, keys))).first() for side in (ours, theirs)
    ]
    known = [end for pair in ends for end in pair if end is not None]
    if not known:
        return []
    open_ranges: list[Range] = [(min(known), max(known))]
    settled: list[Range] = []
    for _ in range(levels):
        # as many parts in all as fit, so that a level costs one scan of what is left and a bounded answer
        parts = max(2, min(fanout, MAX_RANGES // len(open_ranges)))
        pieces = [piece for whole in open_ranges for piece in cut(whole, parts)]
        found = _differing(ours, theirs, keys, pieces)
        fine = lambda bounds, n: n <= leaf_rows or bounds[0] == bounds[1]
        settled += [bounds for bounds, n in found if fine(bounds, n)]
        open_ranges = [bounds for bounds, n in found if not fine(bounds, n)]
        if not open_ranges or len(open_ranges) > MAX_RANGES // 2:
            break
    return joined(sorted(settled + open_ranges), MAX_RANGES)


def reconcile_ranges(target: DataFrame, source_keys: DataFrame, keys: Sequence[str], **limits: int) -> DataFrame:
    """Delete changes for target rows that the source no longer has: the rows of ``merge.reconcile_deletes``.

    Both sides are read in full for their keys' digests alone; rows are read and matched in differing ranges only.
    Repeated rows of the target are all deleted; rows with a NULL in the key match nothing and stay.
    """
    ranges = differing_ranges(target, source_keys, keys, **limits)
    ours, theirs = (
        side.filter(within(position(side, keys), ranges)) for side in (target.filter(keys_present(keys)), source_keys.select(*keys))
    )
    return ours.join(theirs, list(keys), "left_anti").withColumn("_op", F.lit("d"))
