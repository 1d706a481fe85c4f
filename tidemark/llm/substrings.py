"""Substring dedup: repeated windows of words found level by level, each about twice as long as the one before."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.session import materialize

WINDOW = 13
BASE = np.uint64(0x9E3779B97F4A7C15)
MIX = np.uint64(0xBF58476D1CE4E5B9)
CHUNK = 1 << 20


def lengths_of(window: int) -> list[int]:
    """The levels: from about half of ``window`` (or less, down to 7) by doubling, ending with ``window`` itself."""
    lengths = [window]
    while lengths[0] > 13:
        lengths.insert(0, -(-lengths[0] // 2))
    return [-(-lengths[0] // 2), *lengths]


WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of BASE and of its inverse modulo 2^64."""
    inverse = pow(int(BASE), -1, 1 << 64)
    up, down = np.full(CHUNK + 1, BASE), np.full(CHUNK + 1, inverse, np.uint64)
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(31))) * MIX
    return values ^ (values >> np.uint64(29))


def _sums(data: np.ndarray) -> np.ndarray:
    """Before each byte, the polynomial of the bytes up to it."""
    found = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers()[0][: len(data)], out=found[1:])
    return found


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word of a text, from running sums over its bytes; long texts go by chunks of whole words."""
    data = np.frombuffer(text, np.uint8)
    white = WHITE[data]
    edges = np.diff(np.concatenate([[True], white, [True]]).astype(np.int8))
    starts, ends = np.flatnonzero(edges == -1), np.flatnonzero(edges == 1)
    down, found, first = _powers()[1], np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        low = starts[first]
        last = int(np.searchsorted(ends, low + CHUNK, side="right"))
        if last <= first:  # one word longer than a chunk
            value, place = np.zeros(1, np.uint64), np.ones(1, np.uint64)
            for at in range(low, ends[first], CHUNK):
                value += place * _sums(data[at : min(at + CHUNK, ends[first])])[-1]
                place *= _powers()[0][CHUNK]
            found[first], first = value[0], first + 1
            continue
        sums = _sums(data[low : ends[last - 1]])
        begin = starts[first:last] - low
        found[first:last] = (sums[ends[first:last] - low] - sums[begin]) * down[begin]
        first = last
    return _mixed(found)


def window_hashes(hashed: np.ndarray, length: int) -> np.ndarray:
    """A mixed polynomial hash of each run of ``length`` words."""
    count = len(hashed) - length + 1
    if count <= 0:
        return np.array([], np.uint64)
    found = np.zeros(count, np.uint64)
    for k in range(length):
        found = found * BASE + hashed[k : k + count]
    return _mixed(found)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    count = len(values) - width + 1
    found = values[:count].copy()
    for k in range(1, width):
        np.minimum(found, values[k : k + count], out=found)
    return found


def chosen_windows(hashed: np.ndarray, window: int, short: int, shift: int) -> np.ndarray:
    """For each ``window`` the least hash of its ``short`` windows, cut by ``shift`` bits: equal windows choose alike."""
    if len(hashed) < window:
        return np.array([], np.int64)
    return (_least(window_hashes(hashed, short), window - short + 1) >> np.uint64(shift)).view(np.int64)


def _within(flags: np.ndarray, width: int) -> np.ndarray:
    """For each position whether one of the last ``width`` flags up to it is set; as long as flags + width - 1."""
    edge = np.zeros(len(flags) + width, np.int64)
    np.add.at(edge, np.flatnonzero(flags), 1)
    np.add.at(edge, np.flatnonzero(flags) + width, -1)
    return np.cumsum(edge)[:-1] > 0


def candidates(hashed: np.ndarray, window: int, level: int, lengths: list[int], alive: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, flags) of the windows at ``level``; a window is flagged where what it is made of is alive.

    ``alive`` holds what repeats at the level before: chosen short windows first, then hashes of whole levels.
    """
    length = lengths[level]
    found = window_hashes(hashed, length)
    if level == 1:
        whole = np.isin(chosen_windows(hashed, window, lengths[0], shift), alive)
        return found, _within(whole, window - length + 1)[: len(found)]
    half = np.isin(window_hashes(hashed, lengths[level - 1]).view(np.int64), alive)
    return found, half[: len(found)] & half[length - lengths[level - 1] :][: len(found)]


def covered(flags: np.ndarray, window: int, count: int) -> np.ndarray:
    return _within(flags, window)[:count] if len(flags) else np.zeros(count, bool)


def _name_of(id_col: str, text_col: str) -> Column:
    """What orders rows and tells them apart: the id, or a hash of the text in the highest quarter of the numbers."""
    of_text = F.shiftrightunsigned(F.xxhash64(F.coalesce(text_col, F.lit(""))), 2).bitwiseOR(F.lit(3 << 61))
    return F.coalesce(F.col(id_col), of_text)


def _rows(found: list[tuple[np.ndarray, int]]) -> pa.RecordBatch:
    hashes = np.concatenate([h for h, _ in found]) if found else np.array([], np.int64)
    ids = np.repeat(np.array([i for _, i in found], np.int64), [len(h) for h, _ in found])
    return pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(ids)], ["h", "_id"])


def _repeated(rows: DataFrame, label: str) -> DataFrame:
    """(h, first) of hashes in at least two documents, written so that the rows of a hot one can be split in joins."""
    ends = rows.groupBy("h").agg(F.min("_id").alias("first"), F.max("_id").alias("last"))
    return materialize(ends.where("first < last").select("h", "first"), label)


def dedup_substrings(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, digest: bool = False
) -> DataFrame:
    """(doc_id, n_words, n_removed, text) for every row: words covered by a window known from a smaller id go.

    A window is ``window`` consecutive words, unchanged, of one document; it goes where its word sequence also starts in
    a document with a smaller id. Windows are judged on the input. ``text`` holds the kept words joined by one space;
    with ``digest`` there is ``kept_sha256`` instead. Null texts have no words. Rows without an id come after those with
    one, in the order of their texts' hashes; rows of equal id, or without one and of equal text, are no copies of one another.

    Levels: of each window the least-hashed short window (about half as long) stands for it; those found in one document
    alone can't be part of a repeat. Only windows whose part repeats are extended to the next length, about
    twice as long, until the window's length or no candidate is left. Hashes of the first level are as many bits as number
    the corpus's characters and ten more, so its false hits are as rare at every size; the last level has 64 bits on
    what is left. The shuffles carry a hash and an id for each chosen window, and the text once; the text of
    documents with candidates is shuffled a second time.
    """
    spark = docs.sparkSession
    lengths = lengths_of(window)
    texts = docs.select(
        F.col(id_col).alias("doc_id"), _name_of(id_col, text_col).alias("_id"), F.col(text_col).cast("binary").alias("text")
    )
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shift = max(0, 64 - (max(1, int(size)).bit_length() + 10))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                hashed = word_hashes(text or b"")
                found.append((np.unique(chosen_windows(hashed, window, lengths[0], shift)), doc))
            yield _rows(found)

    def finish(words: list[bytes], gone: np.ndarray | None) -> tuple[int, object]:
        kept = words if gone is None else [word for word, out in zip(words, gone.tolist(), strict=True) if not out]
        line = b" ".join(kept)
        return len(words) - len(kept), hashlib.sha256(line).hexdigest() if digest else line.decode("utf-8", "replace")

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, order, text, alive in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                words = (text or b"").split()
                done = finish(words, None)[1] if alive is None else None
                rows.append((doc, order, len(words), done, (text or b"") if alive is not None else None, alive))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 6
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary(), pa.list_(pa.int64())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], opened_names)

    def extended(level: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                found = []
                for doc, text, alive in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                    hashes, flags = candidates(word_hashes(text), window, level, lengths, np.array(alive or [], np.int64), shift)
                    found.append((np.unique(hashes[flags]).view(np.int64), doc))
                yield _rows(found)

        return run

    def closed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, text, alive in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                words = text.split()
                found = window_hashes(word_hashes(text), window).view(np.int64)
                gone = covered(np.isin(found, np.array(alive or [], np.int64)), window, len(words))
                rows.append((doc, len(words), *finish(words, gone)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

    opened_names = ["doc_id", "_id", "n_words", "kept", "text", "alive"]
    names = ["doc_id", "n_words", "n_removed", "kept"]
    out_name = "kept_sha256" if digest else "text"

    def of_docs(rows: DataFrame) -> DataFrame:
        # the few hashes of a document are the hashed side of joins: texts stream past and aren't sorted
        return rows.groupBy("_id").agg(F.collect_set("h").alias("alive")).hint("shuffle_hash")

    first = texts.select("_id", "text").mapInArrow(chosen, "h long, _id long")
    alive = of_docs(first.join(_repeated(first, "chosen").select("h"), "h", "left_semi"))
    state = materialize(
        texts.join(alive, "_id", "left")
        .select("doc_id", "_id", "text", "alive")
        .mapInArrow(opened, "doc_id long, _id long, n_words long, kept string, text binary, alive array<long>"),
        "substring-candidates",
    )
    with_windows = state.where("text is not null")
    current = with_windows
    for level in range(1, len(lengths)):
        if current.isEmpty():
            with_windows = with_windows.withColumn("alive", F.lit(None).cast("array<long>"))
            break
        rows = current.select("_id", "text", "alive").mapInArrow(extended(level), "h long, _id long")
        repeats = _repeated(rows, "windows")
        last = level == len(lengths) - 1
        kept = rows.join(repeats, "h").where("_id > first") if last else rows.join(repeats, "h", "left_semi")
        alive = of_docs(kept.select("h", "_id"))
        current = with_windows.drop("alive").join(alive, "_id", "left" if last else "inner")
        if not last:
            current = materialize(current, "substring-level")
    else:
        with_windows = current
    open_rows = with_windows.select("doc_id", "text", "alive").mapInArrow(closed, "doc_id long, n_words long, n_removed long, kept string")
    done = state.where("text is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept")
    return done.unionByName(open_rows).withColumnRenamed("kept", out_name)


def op7_substrings(spark, sf_dir):
    return dedup_substrings(table(spark, sf_dir, "documents"), digest=True)


OP7_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), p AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM d WHERE len(w) >= 13)
), f AS (
  SELECT k, min(doc_id) AS first FROM p GROUP BY k HAVING min(doc_id) < max(doc_id)
), gone AS (
  SELECT DISTINCT doc_id, i + s.s AS i FROM p JOIN f USING (k), range(0, 13) AS s(s) WHERE doc_id > first
), each AS (
  SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM d
), kept AS (
  SELECT e.doc_id, count(g.i) AS n_removed, string_agg(e.w[e.i], ' ' ORDER BY e.i) FILTER (WHERE g.i IS NULL) AS line
  FROM each e LEFT JOIN gone g ON e.doc_id = g.doc_id AND e.i = g.i GROUP BY e.doc_id
)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(k.n_removed, 0) AS n_removed, sha256(coalesce(k.line, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
