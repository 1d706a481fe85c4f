"""SimHash fingerprints of texts and groups of near fingerprints, found at the anchors of a covering code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.components import components
from tidemark.session import materialize

CHUNK = 1 << 20
#: Homes of one anchor that one task holds at a time, and cells of one comparison.
BLOCK = 4096
CELLS = 1 << 22
BIT_OF_BYTE = np.array([[(byte >> bit) & 1 for bit in range(8)] for byte in range(256)], dtype=np.int64)


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit fingerprint as a signed number; 0 for a text without words."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    width = min(shingle, len(words))
    first, last = starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    counts = np.zeros((8, 8), np.int64)
    for at in range(0, len(first), CHUNK):
        hashes = [digest(line[s:e], seed) for s, e in zip(first[at : at + CHUNK], last[at : at + CHUNK], strict=True)]
        columns = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        for byte in range(8):
            counts[byte] += np.bincount(columns[:, byte], minlength=256) @ BIT_OF_BYTE
    bits = (2 * counts.reshape(64) > len(first)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4) -> DataFrame:
    """(doc_id, fp: signed long) for every row, in one pass without a shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(text, shingle) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.int64())], ["doc_id", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


# The covering code: 64 bits are cut into parts, so that fingerprints that differ in at most k bits differ in at
# most k // parts bits of some part. In a part the code is the direct sum of the perfect Hamming code [15, 11]
# and of all words on the other bits: every word lies within its covering radius, 1, of exactly one anchor.
RADIUS = 1
HAMMING = 15


def parts_of(max_bits: int) -> list[tuple[int, int]]:
    """(first bit, width) of each part; a pair within ``max_bits`` differs in one bit of some part at most."""
    count = max_bits // 2 + 1
    edges = [64 * k // count for k in range(count + 1)]
    return [(low, high - low) for low, high in zip(edges, edges[1:], strict=False)]


def _syndrome(words: np.ndarray) -> np.ndarray:
    """The 1-based place of the bit that is off the code, or 0, of the low 15 bits."""
    found = np.zeros(words.shape, np.uint64)
    for place in range(1, HAMMING + 1):
        found ^= ((words >> np.uint64(place - 1)) & np.uint64(1)) * np.uint64(place)
    return found


def _home(words: np.ndarray) -> np.ndarray:
    """The anchor that decodes each word of a part."""
    off = _syndrome(words)
    return np.where(off > 0, words ^ (np.uint64(1) << (np.maximum(off, np.uint64(1)) - np.uint64(1))), words)


def _word(fps: np.ndarray, part: tuple[int, int]) -> np.ndarray:
    low, width = part
    return (fps >> np.uint64(low)) & np.uint64((1 << width) - 1)


def anchors_within(words: np.ndarray, width: int, reach: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, anchors) of all anchors within ``reach`` (at most 2) bits of each word of a part."""
    rows = np.arange(len(words))
    off = _syndrome(words)
    home, away = _home(words), (off > 0).astype(np.int64)
    rest = [np.uint64(1) << np.uint64(b) for b in range(HAMMING, width)]
    yield rows, home
    if reach < 1:
        return
    near = away + 1 <= reach
    for bit in rest:
        yield rows[near], home[near] ^ bit
    if reach < 2:
        return
    on = away == 0
    for i, bit in enumerate(rest):
        for other in rest[i + 1 :]:
            yield rows[on], home[on] ^ bit ^ other
    # two flips in the Hamming part: places p and q with p xor q equal to the syndrome
    for p in range(1, HAMMING + 1):
        q = off.astype(np.int64) ^ p
        fits = (off > 0) & (q > p)
        flipped = words[fits] ^ (np.uint64(1) << np.uint64(p - 1)) ^ (np.uint64(1) << (q[fits] - 1).astype(np.uint64))
        yield rows[fits], flipped


def _replicas(max_bits: int):
    parts = parts_of(max_bits)
    reach = RADIUS + max_bits // len(parts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(every), 1 << 14):
                fps = every[at : at + (1 << 14)]
                for number, part in enumerate(parts):
                    words = _word(fps, part)
                    home = _home(words)
                    mark = np.uint64(number << 60)
                    for rows, anchors in anchors_within(words, part[1], reach):
                        if len(rows):
                            yield pa.RecordBatch.from_arrays(
                                [
                                    pa.array((anchors ^ mark).view(np.int64)),
                                    pa.array(fps[rows].view(np.int64)),
                                    pa.array(anchors == home[rows]),
                                ],
                                ["anchor", "fp", "home"],
                            )

    return run


def _links_of(asked: np.ndarray, homes: np.ndarray, labels: np.ndarray, max_bits: int, out: list) -> None:
    """Adds a spanning set of the links between ``asked`` and ``homes``; ``labels`` groups homes linked so far."""
    step = max(1, CELLS // max(1, len(homes)))
    for at in range(0, len(asked), step):
        some = asked[at : at + step]
        near = np.bitwise_count(some[:, None] ^ homes[None, :]) <= max_bits
        degree = near.sum(axis=1)
        for row in np.flatnonzero(degree):
            met = np.flatnonzero(near[row])
            first = met[0]
            if degree[row] == 1:
                if homes[first] != some[row]:
                    out.append((some[row], homes[first]))
                continue
            if not (homes[met] == some[row]).any():
                out.append((some[row], homes[first]))
            groups, where = np.unique(labels[met], return_index=True)
            for group, other in zip(groups, met[where], strict=True):
                if group != labels[first]:
                    out.append((homes[first], homes[other]))
                    labels[labels == group] = labels[first]


def _compare(max_bits: int):
    """Streams rows sorted by anchor and block, homes first; holds the homes of one block at a time."""

    def flush(out: list) -> pa.RecordBatch:
        pairs = np.array(out, np.uint64).reshape(-1, 2).view(np.int64)
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, homes, labels, out = None, np.array([], np.uint64), np.array([], np.int64), []
        for batch in batches:
            if not batch.num_rows:
                continue
            anchor, block, fps, home = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            fps = fps.view(np.uint64)
            cuts = np.flatnonzero((np.diff(anchor) != 0) | (np.diff(block) != 0)) + 1
            edges = [0, *cuts.tolist(), len(fps)]
            for low, high in zip(edges, edges[1:], strict=False):
                if key != (anchor[low], block[low]):
                    key, homes = (anchor[low], block[low]), np.array([], np.uint64)
                fresh = fps[low:high][home[low:high]]
                if len(fresh):
                    homes = np.concatenate([homes, fresh])
                    labels = np.arange(len(homes))
                    # homes come first: those of this block are complete when others follow; homes ask one another too
                    _links_of(fresh, homes, labels, max_bits, out)
                others = fps[low:high][~home[low:high]]
                if len(others) and len(homes):
                    _links_of(others, homes, labels, max_bits, out)
                if len(out) >= 10_000:
                    yield flush(out)
        if out:
            yield flush(out)

    return run


def links(fps: DataFrame, max_bits: int = 4, block: int = BLOCK) -> DataFrame:
    """(a, b): links between distinct ``fp`` that keep every group of fingerprints within ``max_bits`` connected.

    Each fingerprint is at home at the one anchor within the covering radius and is replicated to every anchor
    within radius plus threshold; so a near pair meets at the home of either. An anchor with many homes is cut
    into blocks of homes, and every fingerprint replicated there visits all of its blocks. Of the links found in a
    block, one for each fingerprint and one for each joining of home groups are returned, never all pairs.
    """
    visits = fps.select("fp").mapInArrow(_replicas(max_bits), "anchor long, fp long, home boolean")
    crowds = visits.where("home").groupBy("anchor").count().where(F.col("count") > block)
    crowds = materialize(crowds.select("anchor", F.ceil(F.col("count") / block).cast("int").alias("blocks")), "crowds")
    dealt = visits.join(crowds, "anchor", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    placed = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    placed = placed.select("anchor", "block", "fp", (F.col("home") & (F.col("block") == own)).alias("home"))
    spread = placed.repartition("anchor", "block").sortWithinPartitions("anchor", "block", F.desc("home"))
    return spread.mapInArrow(_compare(max_bits), "a long, b long").distinct()


def near_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """(doc_id, fp, component_id) for every row of ``docs``.

    Equal texts share a fingerprint and form one class; only distinct fingerprints are compared. A component is
    named by the smallest doc_id in it. Null or empty texts have fingerprint 0 and are linked like any other;
    rows without an id get the component of their fingerprint (null if no row of it has an id); repeated rows
    stay repeated.
    """
    marked = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    classes = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes, max_bits))
    joined = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    owners = materialize(joined.join(named, "root").select("fp", "component_id"), "owners")
    return marked.join(owners, "fp").select("doc_id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame, shingle: int = 4, max_bits: int = 4) -> DataFrame:
    """``docs`` without the documents whose group holds a smaller doc_id; repeated rows of one id become one.

    Rows without an id go where their group has a row with one, and stay otherwise.
    """
    groups = materialize(near_groups(docs, shingle=shingle, max_bits=max_bits), "groups")
    losers = groups.where("doc_id <> component_id").select("doc_id").distinct().hint("shuffle_hash")
    nameless = groups.where("doc_id is null and component_id is not null").select("fp").distinct()
    repeated = groups.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    kept = docs.where("doc_id is not null").join(losers, "doc_id", "left_anti").select(*docs.columns)
    once = kept.join(repeated, "doc_id", "left_anti").select(*docs.columns)
    twice = kept.join(repeated, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    return once.unionByName(twice).unionByName(_without_ids(docs, nameless, shingle))


def _without_ids(docs: DataFrame, nameless: DataFrame, shingle: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.large_binary()).to_pylist()
            yield batch.append_column("_fp", pa.array([fingerprint(t, shingle) for t in texts], pa.int64()))

    rows = docs.where("doc_id is null")
    marked = rows.mapInArrow(run, rows.withColumn("_fp", F.lit(0).cast("long")).schema)
    return marked.join(nameless.withColumnRenamed("fp", "_fp"), "_fp", "left_anti").select(*docs.columns)


def op5_simhash(spark, sf_dir):
    found = near_groups(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")
