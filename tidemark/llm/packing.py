"""Packing of token pieces into sequences: cutting-stock column generation over the histogram of lengths."""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table, with_rank
from tidemark.session import materialize

CAPACITY = 2048
#: Lengths are planned in classes (up to this length, of so many tokens): some 350 of them bound the linear program
#: whatever the corpus, and a piece is charged for at most a 64th more tokens than it has.
CLASSES = ((64, 1), (128, 2), (256, 4))
WIDEST = 8
#: The linear program ends within this share of its optimum.
GAP = 1e-3
END_ID = 1
#: Entries of a task's memo of words; it starts anew when full.
MEMO = 400_000
BREAK = re.compile(r"(?= \S)")
UNEVEN = re.compile(r" (?=\s|$)|^\s")


# fixed value: the pattern of byte-level pre-tokenization
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: What a plain byte-level file says of its pre-tokenization.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


class _Ids(dict):
    """Ids of a word with the space before it, as little-endian 32-bit bytes."""

    def __init__(self, encode):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        if len(self) >= MEMO:
            self.clear()
        ids = self[word] = self.encode(" " + word)
        return ids


def byte_letters() -> dict[str, int]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in plain}
    return letters | {chr(256 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}


@lru_cache(maxsize=2)
def tokenizer(vocabulary: str):
    """text -> bytes of ids, for a byte-level BPE file given as text.

    Words are encoded once per task and remembered; a space before a non-space always starts a new word of the
    pattern, so that the ids of a text are those of its words in turn. Texts that hold a special token's string are
    left to the file's own tokenizer.
    """
    import tiktoken
    from tokenizers import Tokenizer

    described = json.loads(vocabulary)
    if described["pre_tokenizer"] != BYTE_LEVEL or described["normalizer"]:
        raise ValueError("not a plain byte-level vocabulary")
    special = [t["content"] for t in described.get("added_tokens", [])]
    letters = byte_letters()
    ranks = {
        bytes(letters[c] for c in token): rank for token, rank in described["model"]["vocab"].items() if token not in special
    }
    words = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    whole = Tokenizer.from_str(vocabulary)

    def as_bytes(ids: list[int]) -> bytes:
        return np.array(ids, "<u4").tobytes()

    def encode(text: str) -> bytes:
        return as_bytes(words.encode_ordinary(text))

    known = _Ids(encode)

    def ids_of(text: str) -> bytes:
        if not text:
            return b""
        if any(s in text for s in special):
            return as_bytes(whole.encode(text, add_special_tokens=False).ids)
        if UNEVEN.search(text):
            first, *rest = BREAK.split(text)
            # a piece may hold trailing white space: its ids don't depend on what follows
            return encode(first) + b"".join([known[piece[1:]] for piece in rest])
        first, *rest = text.split(" ")
        return encode(first) + b"".join(map(known.__getitem__, rest))

    return ids_of


def pieces(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): each document in full pieces of ``capacity`` and a rest.

    A document is its ids and the end id after them; a null text counts as empty and so has the end id alone.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = tokenizer(shared.value)
        end = np.array([END_ID], "<u4").tobytes()
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = memoryview(ids_of(text or "") + end)
                count = len(ids) // 4
                for start in range(0, count, capacity):
                    stop = min(count, start + capacity)
                    rows.append((doc, start, stop - start, zlib.crc32(ids[4 * start : 4 * stop]), count))
            columns = zip(*rows, strict=True) if rows else [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(run, ", ".join(f"{n} long" for n in names))


def best_pattern(values: np.ndarray, sizes: np.ndarray, capacity: int) -> np.ndarray:
    """How many of each size (ascending) to take for the greatest value: the unbounded knapsack by dynamic programming."""
    best, choice = np.zeros(capacity + 1), np.full(capacity + 1, -1)
    fitting = np.searchsorted(sizes, np.arange(capacity + 1), side="right")
    for room in range(int(sizes[0]), capacity + 1):
        gain = best[room - sizes[: fitting[room]]] + values[: fitting[room]]
        top = gain.argmax()
        if gain[top] > best[room - 1] + 1e-12:
            best[room], choice[room] = gain[top], top
        else:
            best[room] = best[room - 1]
    taken, room = np.zeros(len(sizes), np.int64), capacity
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            taken[choice[room]] += 1
            room -= sizes[choice[room]]
    return taken


def first_fit(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """A basis of patterns, one for each size that it uses up, filled with the largest sizes still in demand."""
    count = len(sizes)
    patterns, uses = np.diag(capacity // sizes).astype(np.int64), np.zeros(count)
    left, open_sizes = demand.astype(float).copy(), np.ones(count, bool)
    while open_sizes.any():
        column, room = np.zeros(count, np.int64), capacity
        for k in np.flatnonzero(open_sizes)[::-1]:
            column[k], room = room // sizes[k], room % sizes[k]
        held = np.flatnonzero(column)
        times = left[held] / column[held]
        spent = held[int(times.argmin())]
        patterns[:, spent], uses[spent] = column, times.min()
        left -= times.min() * column
        open_sizes[spent] = False
    return patterns, uses


def class_of(length: Column, capacity: int = CAPACITY) -> Column:
    """The tokens that a piece is charged for: its length, rounded up within its class."""
    found = F.ceil(length / WIDEST) * WIDEST
    for upto, width in reversed(CLASSES):
        found = F.when(length <= upto, F.ceil(length / width) * width).otherwise(found)
    return F.least(found, F.lit(capacity)).cast("int")


def inverse_of(matrix: np.ndarray) -> np.ndarray:
    """The inverse, by elimination in plain array operations: linear-algebra libraries with threads of their own can
    hang in a driver."""
    count = len(matrix)
    work = np.concatenate([matrix.astype(float), np.eye(count)], axis=1)
    for k in range(count):
        pivot = k + int(np.abs(work[k:, k]).argmax())
        if pivot != k:
            work[[k, pivot]] = work[[pivot, k]]
        work[k] /= work[k, k]
        factor = work[:, k].copy()
        factor[k] = 0.0
        rows = np.flatnonzero(factor)
        work[rows] -= factor[rows, None] * work[k]
    return work[:, count:]


def _times(matrix: np.ndarray, vector: np.ndarray) -> np.ndarray:
    return (matrix * vector).sum(axis=1)


def column_generation(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(patterns as columns, uses as floats): near the least sequences that cover ``demand``, by revised simplex steps.

    The basis starts with the patterns of first-fit decreasing, each used until a size runs out; each step prices a new pattern by the knapsack over the dual values, or
    gives up a size that is covered beyond its demand where its dual is negative, and exchanges the column for the basic
    one that runs out first. The duals divided by the priced value bound the optimum from below, so it ends when the
    uses are within GAP of it.
    """
    count = len(sizes)
    patterns, uses = first_fit(sizes, demand, capacity)
    costs = np.ones(count)
    inverse = inverse_of(patterns)
    for turn in range(1, 20 * count):
        if turn % 100 == 0:  # rounding errors don't add up
            inverse = inverse_of(patterns)
            uses = np.maximum(_times(inverse, demand), 0.0)
        duals = (costs[:, None] * inverse).sum(axis=0)
        worst = int(duals.argmin())
        if duals[worst] < -1e-9:
            column, cost = -np.eye(count, dtype=np.int64)[worst], 0.0
        else:
            column, cost = best_pattern(duals, sizes, capacity), 1.0
            if (duals * column).sum() <= 1 + GAP:
                break
        step = _times(inverse, column)
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step > 1e-9, uses / step, np.inf)
        leaving = int(ratio.argmin())
        if not np.isfinite(ratio[leaving]):
            break
        uses = np.maximum(uses - ratio[leaving] * step, 0.0)
        uses[leaving] = ratio[leaving]
        pivot = inverse[leaving] / step[leaving]
        inverse -= np.outer(step, pivot)
        inverse[leaving] = pivot
        patterns[:, leaving], costs[leaving] = column, cost
    return patterns[:, costs > 0], uses[costs > 0]


def rounded(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, int]]:
    """(pattern, times) that use up ``demand`` exactly: patterns rounded down, the few left over best fit first."""
    left, plan = demand.astype(np.int64).copy(), []
    patterns, uses = column_generation(sizes, demand.astype(float), capacity)
    for k in np.argsort(-uses):
        column = patterns[:, k]
        held = column > 0
        times = int(min(np.floor(uses[k] + 1e-9), (left[held] // column[held]).min()))
        if times > 0:
            plan.append((column, times))
            left -= times * column
    by_room: dict[int, list[np.ndarray]] = {}
    for k in np.argsort(-sizes):
        for _ in range(left[k]):
            size = int(sizes[k])
            room = min((r for r, b in by_room.items() if r >= size and b), default=None)
            content = by_room[room].pop() if room is not None else np.zeros(len(sizes), np.int64)
            content[k] += 1
            by_room.setdefault((capacity if room is None else room) - size, []).append(content)
    return plan + [(content, 1) for held in by_room.values() for content in held]


def plan_rows(lengths: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """(cls, first rank, end rank, items per sequence, first sequence, place in the sequence) from counts by class."""
    open_classes = sorted(c for c in lengths if c <= capacity and lengths[c])
    plan = [(np.array([1]), n, [c]) for c, n in lengths.items() if c > capacity and n]
    if open_classes:
        sizes = np.array(open_classes, np.int64)
        demand = np.array([lengths[c] for c in open_classes], np.int64)
        plan += [(pattern, times, open_classes) for pattern, times in rounded(sizes, demand, capacity)]
    used: dict[int, int] = {}
    rows, sequence = [], 0
    for pattern, times, classes in plan:
        place = 0
        for k in np.flatnonzero(pattern)[::-1]:
            each, cls = int(pattern[k]), classes[k]
            first = used.get(cls, 0)
            rows.append((cls, first, first + times * each, each, sequence, place))
            used[cls] = first + times * each
            place += each
        sequence += times
    return rows


def pack(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (pieces of at most ``capacity`` tokens, with ``length``) with ``sequence_id`` and ``offset``.

    The histogram of length classes, some 350 rows, is all that reaches the driver. The linear
    program's patterns, rounded, take the pieces of each class by rank; a piece finds its pattern, sequence and place
    by a join with the plan, whose rows are bounded by classes and patterns. Ranks are counted in buckets, so a
    class may hold any share of the pieces. Short pieces are planned to the token, and none is charged for over a
    64th more than it has. A table without pieces gives one without rows; pieces that are alike are packed each.
    """
    spark = cut.sparkSession
    cut = materialize(cut.withColumn("_cls", class_of(F.col("length"), capacity)), "pieces")
    counts = {row["_cls"]: row["count"] for row in cut.groupBy("_cls").count().collect()}
    plan = spark.createDataFrame(
        plan_rows(counts, capacity), "_c int, _first long, _end long, _each long, _seq long, _place long"
    )
    ranked = with_rank(cut, ["_cls"], ["doc_id", "start", "ids_crc32", "length"], sum(counts.values()))
    fits = (F.col("_cls") == F.col("_c")) & (F.col("_rank") >= F.col("_first")) & (F.col("_rank") < F.col("_end"))
    placed = ranked.join(F.broadcast(plan), fits)
    within = F.col("_rank") - F.col("_first")
    placed = placed.select(
        *[c for c in cut.columns if c != "_cls"],
        (F.col("_seq") + F.floor(within / F.col("_each"))).cast("long").alias("sequence_id"),
        (F.col("_place") + F.pmod(within, F.col("_each"))).alias("_at"),
    )
    # a sequence has at most capacity pieces
    before = Window.partitionBy("sequence_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    return placed.withColumn("offset", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long")).drop("_at")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pack_documents(docs: DataFrame, vocabulary_path: str | None = None) -> DataFrame:
    """The pieces of all ``docs`` (doc_id, text) with their places in sequences: see ``pieces`` and ``pack``.

    Null and empty texts have the end id alone; repeated rows and rows without an id are packed each; other columns are
    not read. The vocabulary must be a plain byte-level one, else a ValueError is raised.
    """
    vocabulary = Path(vocabulary_path or default_vocabulary()).read_text(encoding="utf-8")
    return pack(pieces(docs, vocabulary))


def op2_packing(spark, sf_dir):
    packed = pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")
