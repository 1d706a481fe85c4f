"""Periodic runs of words: an online sparse dynamic program over the diagonals of equal words."""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table

#: A run has at least so many words, and at least so many times its period.
LEAST_WORDS, LEAST_TURNS = 6, 4
#: Exponents are given in thousandths.
MILLI = 1000

Run = tuple[int, int, int]  # start, length, period


def numbered(words: list[bytes]) -> np.ndarray:
    """Equal words get equal numbers."""
    known: dict[bytes, int] = {}
    return np.fromiter((known.setdefault(word, len(known)) for word in words), np.int64, len(words))


def _pairs(names: np.ndarray, width: int) -> tuple[np.ndarray, bool]:
    """Names of the stretches of 2 * width words from those of width words, and whether any of them comes twice."""
    joined = names[:-width] * (int(names.max()) + 1) + names[width:]
    values, found = np.unique(joined, return_inverse=True)
    return found, len(values) < len(joined)


def _lags(names: np.ndarray, width: int, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, lag), in this order, of each earlier occurrence of a block's words at a lag from width to 2 * width - 1."""
    count = len(names)
    order = np.argsort(names, kind="stable")
    keys = names[order] * (count + 1) + order
    at = np.arange(blocks) * width
    base = names[at] * (count + 1)
    low = np.searchsorted(keys, base + np.maximum(at - 2 * width + 1, 0))
    high = np.searchsorted(keys, base + np.maximum(at - width, -1), side="right")
    met = np.maximum(high - low, 0)
    block = np.repeat(np.arange(blocks), met)
    first = np.cumsum(met) - met
    places = order[np.arange(len(block)) - first[block] + low[block]]
    return block, at[block] - places


def _continued(block: np.ndarray, lag: np.ndarray, blocks: int) -> np.ndarray:
    """Flags of the matches that the block before or behind continues on the same diagonal."""
    keys = lag * (blocks + 1) + block
    order = np.argsort(keys)
    next_to = np.diff(keys[order]) == 1
    found = np.zeros(len(keys), bool)
    found[order[:-1][next_to]] = found[order[1:][next_to]] = True
    return found


def _equal_steps(words: np.ndarray, left: int, right: int, most: int, step: int) -> int:
    """How many words, going by ``step`` from two places, are equal; at most ``most``."""
    if most <= 0:
        return 0
    one, other = (words[p : p + most] if step > 0 else words[max(0, p - most + 1) : p + 1][::-1] for p in (left, right))
    size = min(len(one), len(other))
    unequal = np.flatnonzero(one[:size] != other[:size])
    return int(unequal[0]) if len(unequal) else size


def runs_of(words: np.ndarray) -> list[Run]:
    """All runs (start, length, period) of a sequence of word numbers, by start and then period.

    A diagonal is a lag at which words equal earlier ones. Lags are tracked by scale: those from 2^k to 2^(k+1) - 1 by
    blocks of 2^k words, as a run holds at least two whole blocks behind its first period. For each block in turn,
    its earlier occurrences at lags of the scale add a block to the match length of their diagonals; a diagonal without
    such an occurrence ends there, and if its length can be enough, it emits its run at once, measured to the word. A
    block has at most 2^k lags, so that a frequent word costs n log n steps where all pairs of its places would be n^2.

    Periods that are multiples of another give the same words again; the smaller period comes in an earlier scale.
    """
    count, found = len(words), {}

    def emit(lag: int, first: int, end: int, width: int) -> None:
        # the blocks beside don't match, so that less than a block is left to compare on either side
        start = first - _equal_steps(words, first - 1, first - lag - 1, min(width - 1, first - lag), -1)
        end += _equal_steps(words, end, end - lag, min(width - 1, count - end), 1)
        if end - start + lag >= max(LEAST_WORDS, LEAST_TURNS * lag):
            found.setdefault((start - lag, end - start + lag), lag)

    names, width = words, 1
    while count >= LEAST_TURNS * width:
        blocks = count // width
        where, lags = _lags(names, width, blocks)
        # one block alone is never enough: 3 * lag words exceed it and what is left on either side
        kept = _continued(where, lags, blocks)
        where, lags = where[kept], lags[kept]
        active: dict[int, int] = {}
        last = -1

        def close(ended: dict[int, int], upto: int) -> None:
            for lag in sorted(ended):
                matched = ended[lag] * width
                if matched + 2 * (width - 1) >= max(LEAST_WORDS - lag, (LEAST_TURNS - 1) * lag):
                    emit(lag, upto - matched, upto, width)

        edges = np.flatnonzero(np.diff(where)) + 1
        for begin, stop in zip([0, *edges.tolist()], [*edges.tolist(), len(where)], strict=True):
            if begin == stop:
                break
            block = int(where[begin])
            if block != last + 1:
                close(active, (last + 1) * width)
                active = {}
            longer = {lag: active.pop(lag, 0) + 1 for lag in lags[begin:stop].tolist()}
            if active:
                close(active, block * width)
            active, last = longer, block
        close(active, (last + 1) * width)
        if count < 2 * width:
            break
        names, again = _pairs(names, width)
        width *= 2
        if not again:
            break
    return sorted((start, length, lag) for (start, length), lag in found.items())


def planted(words: list, number: int) -> list:
    """The words of a document with a periodic tail, where the crc32 ``number`` of its id calls for one."""
    count = len(words)
    if number % 10 or not count:
        return words
    factor = number // 10
    at = factor % count
    period = 1 + (count - at) // (3 + factor % 8)
    return words[:at] + (words[at : at + period] * (-(-(count - at) // period)))[: count - at]


def strongest(runs: list[Run]) -> Run | None:
    """The run of greatest exact length / period; ties by smaller start, then period."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


def collapsed(words: list, runs: list[Run]) -> list:
    """The words without those that a run holds behind its first period."""
    if not runs:
        return words
    edges = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edges[start + period] += 1
        edges[start + length] -= 1
    gone = np.cumsum(edges)[:-1] > 0
    return [word for word, out in zip(words, gone.tolist(), strict=True) if not out]


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, digest: bool = False) -> DataFrame:
    """One row for each of ``docs``: its periodic runs and its text without their repeats.

    Returns doc_id, n_runs, the strongest run (start, length, period, exponent_milli; nulls without a run), ``runs``
    (array of start, length, period) and ``text``, the kept words joined by one space; with ``digest`` there are
    ``runs_sha256`` and ``collapsed_sha256`` instead of the last two. ``plant`` rewrites the tail of each tenth document, chosen
    by the crc32 of its id, before that.

    Null texts, empty ones and those of white space have no words and no runs. Rows without an id are never rewritten;
    repeated rows give equal rows. Other columns are not read. One pass, no shuffle: each document is worked on alone,
    in memory that grows with its words.
    """
    run_type = pa.struct([(name, pa.int64()) for name in ("start", "length", "period")])
    names = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli"]
    last = ["runs_sha256", "collapsed_sha256"] if digest else ["runs", "text"]
    types = [pa.int64()] * 6 + ([pa.string()] * 2 if digest else [pa.list_(run_type), pa.string()])

    def row(doc: int | None, text: bytes | None) -> tuple:
        words = (text or b"").split()
        if plant and doc is not None:
            words = planted(words, zlib.crc32(str(doc).encode()))
        runs = runs_of(numbered(words)) if len(words) >= LEAST_WORDS else []
        best = strongest(runs)
        head = (*best, MILLI * best[1] // best[2]) if best else (None,) * 4
        line = b" ".join(collapsed(words, runs))
        if digest:
            listed = "".join(f"{start},{length},{period}\n" for start, length, period in runs)
            return (doc, len(runs), *head, hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(line).hexdigest())
        as_rows = [dict(zip(("start", "length", "period"), run, strict=True)) for run in runs]
        return (doc, len(runs), *head, as_rows, line.decode("utf-8", "replace"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [row(doc, text) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(types)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], [*names, *last])

    kinds = "runs_sha256 string, collapsed_sha256 string" if digest else "runs array<struct<start: long, length: long, period: long>>, text string"
    schema = ", ".join(f"{name} long" for name in names) + ", " + kinds
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text")).mapInArrow(run, schema)


def op12_periods(spark, sf_dir):
    return find_runs(table(spark, sf_dir, "documents"), plant=True, digest=True)
