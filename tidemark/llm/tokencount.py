"""Greedy word-piece counts by a linear longest-match automaton."""

from __future__ import annotations

import json
from collections import deque
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.packing import MEMO, byte_letters, default_vocabulary

START = b" "


class LongestMatch:
    """Counts the pieces that greedy longest-match-first cutting of a word gives, without building them.

    The vocabulary is a trie over bytes; a piece that starts a word begins with a space, any other one goes on. Each
    node knows, for the case that its string can't be extended, how many pieces cutting it pops (``pops``) and
    which node spells what is left (``fails``). So a word is read once: a byte either extends the node or follows the
    failure link, and each link pops at least one piece for good. Every single byte is a piece, so that no word is left
    without a cut and every node has a failure link.
    """

    def __init__(self, pieces: list[bytes]):
        self.edges: list[dict[int, int]] = [{}]
        whole = [False]
        for piece in [*pieces, *(bytes([byte]) for byte in range(256))]:
            node = 0
            for byte in piece:
                follower = self.edges[node].get(byte)
                if follower is None:
                    follower = self.edges[node][byte] = len(self.edges)
                    self.edges.append({})
                    whole.append(False)
                node = follower
            whole[node] = node != 0
        self.fails = [0] * len(self.edges)
        self.pops = [0] * len(self.edges)
        waiting = deque([0])
        while waiting:
            node = waiting.popleft()
            for byte, child in self.edges[node].items():
                waiting.append(child)
                if whole[child]:
                    self.pops[child] = 1
                    continue
                # what the parent pops, then on from its rest with this byte, popping more where it doesn't fit
                popped, rest = self.pops[node], self.fails[node]
                while byte not in self.edges[rest]:
                    popped, rest = popped + self.pops[rest], self.fails[rest]
                self.fails[child], self.pops[child] = self.edges[rest][byte], popped

    def count(self, word: bytes) -> int:
        edges, fails, pops = self.edges, self.fails, self.pops
        node = found = 0
        for byte in word:
            while byte not in edges[node]:
                found, node = found + pops[node], fails[node]
            node = edges[node][byte]
        while node:
            found, node = found + pops[node], fails[node]
        return found


@lru_cache(maxsize=2)
def automaton(vocabulary: str) -> LongestMatch:
    described = json.loads(vocabulary)
    special = {t["content"] for t in described.get("added_tokens", [])}
    letters = byte_letters()
    return LongestMatch([bytes(letters[c] for c in piece) for piece in described["model"]["vocab"] if piece not in special])


class _Counts(dict):
    def __init__(self, counter: LongestMatch):
        super().__init__()
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        if len(self) >= MEMO:
            self.clear()
        found = self[word] = self.counter.count(START + word)
        return found


@lru_cache(maxsize=2)
def memo(vocabulary: str) -> _Counts:
    return _Counts(automaton(vocabulary))


def token_counts(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``n_tokens`` and ``longest_word_tokens`` (long) added.

    Words are runs without white space; each is cut greedily into the longest pieces of the vocabulary, whose text
    (a byte-level file) is broadcast. Null and empty texts count 0. Words seen before are looked up in a bounded memo.
    Existing columns of these names are replaced. One pass, no shuffle.
    """
    added = ["n_words", "n_tokens", "longest_word_tokens"]
    docs = docs.drop(*added)
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    where = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = memo(shared.value)
        for batch in batches:
            rows = []
            for text in batch.column(where).cast(pa.large_binary()).to_pylist():
                counts = list(map(known.__getitem__, (text or b"").split()))
                rows.append((len(counts), sum(counts), max(counts, default=0)))
            columns = zip(*rows, strict=True) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *(pa.array(c, pa.int64()) for c in columns)], [*batch.schema.names, *added]
            )

    return docs.mapInArrow(run, docs.withColumns({name: F.lit(0).cast("long") for name in added}).schema)


def op10_token_counts(spark, sf_dir, vocabulary_path: str | None = None):
    vocabulary = Path(vocabulary_path or default_vocabulary()).read_text(encoding="utf-8")
    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")
