"""Alignment of two tokenizers' tokens on the same bytes, and how often their ids go together in the corpus."""

from __future__ import annotations

import hashlib
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.llm.packing import BYTE_LEVEL, PATTERN, byte_letters
from tidemark.session import materialize

#: Pairs with at least this share of all links are broadcast: there are at most 2^18 such pairs, whatever the corpus.
HEAVY_SHARE = 2.0**-18
#: An id pair as one number.
SHIFT = 1 << 20


class ByteLevel:
    """A byte-level BPE file: ids of a space and a text as 32-bit bytes, special tokens' strings being plain text."""

    def __init__(self, described: str):
        import tiktoken

        parts = json.loads(described)
        if parts["pre_tokenizer"] != BYTE_LEVEL or parts["normalizer"]:
            raise ValueError("not a plain byte-level vocabulary")
        special = {t["content"] for t in parts.get("added_tokens", [])}
        letters = byte_letters()
        ranks = {bytes(letters[c] for c in t): rank for t, rank in parts["model"]["vocab"].items() if t not in special}
        self.words = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.table = _Bytes({rank: token for token, rank in ranks.items()})

    def ids(self, text: str) -> bytes:
        return array("I", self.words.encode_ordinary(" " + text)).tobytes()


class Pieces:
    """A sentence-piece model file: ids of a text, before which it sets a space itself, as 32-bit bytes."""

    def __init__(self, model: bytes):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=model)
        found = {}
        for token in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(token)
            if self.model.is_byte(token):
                found[token] = bytes([int(piece[3:5], 16)])
            elif not (self.model.is_control(token) or self.model.is_unknown(token)):
                found[token] = piece.replace("▁", " ").encode()
        self.table = _Bytes(found)

    def ids(self, text: str) -> bytes:
        return self.model.encode_as_numpy(text).astype("<u4").tobytes()


class _Bytes:
    """Bytes and byte counts of ids."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens = [tokens.get(k, b"") for k in range(max(tokens) + 1)]
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


class Aligner:
    """Aligns the tokens of whole texts by the places where they end."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.a, self.b = a, b
        # ids as they are told, each followed by its mark: inside a group, at the end of A's tokens, at the end of B's
        names = range(max(len(a.table.tokens), len(b.table.tokens)))
        self.told = [f"{k}{mark}".encode() for k in names for mark in ",|;"]

    def document(self, text: str | None) -> tuple[int, int, int, bytes, np.ndarray] | None:
        """(n_a, n_b, n_groups, groups as text, pair of each link); None for an empty text, or where bytes aren't a space and the text."""
        if not text:
            return None
        a, b = np.frombuffer(self.a.ids(text), "<u4"), np.frombuffer(self.b.ids(text), "<u4")
        data = b" " + text.encode()
        if not len(b) or self.a.table.joined(a) != data or self.b.table.joined(b) != data:
            return None
        a, b = a.astype(np.int64), b.astype(np.int64)
        ends_a, ends_b = np.cumsum(self.a.table.lengths[a]), np.cumsum(self.b.table.lengths[b])
        # the token of each side that holds the other side's last byte, and whether it ends there too: a group's end
        over_a, over_b = np.searchsorted(ends_b, ends_a), np.searchsorted(ends_a, ends_b)
        closes_a, closes_b = ends_b[over_a] == ends_a, ends_a[over_b] == ends_b
        # a link ends where a token of either side does, once where both do
        links_a, links_b = a * SHIFT + b[over_a], (a[over_b] * SHIFT + b)[~closes_b]
        last_a, last_b = np.flatnonzero(closes_a) + 1, np.flatnonzero(closes_b) + 1
        before_a, before_b = np.cumsum(closes_a) - closes_a, np.cumsum(closes_b) - closes_b
        told = np.empty(len(a) + len(b), np.int64)
        told[np.arange(len(a)) + np.concatenate([[0], last_b])[before_a]] = 3 * a + closes_a
        told[np.arange(len(b)) + last_a[before_b]] = 3 * b + 2 * closes_b
        groups = b"".join(map(self.told.__getitem__, told.tolist()))[:-1]
        return len(a), len(b), len(last_a), groups, np.concatenate([links_a, links_b])


@lru_cache(maxsize=1)
def aligner(described: str, model: bytes) -> Aligner:
    return Aligner(ByteLevel(described), Pieces(model))


ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, pairs array<long>, times array<int>"


def aligned_texts(docs: DataFrame, described: str, model: bytes, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times): each text's alignment and its distinct id pairs.

    ``groups`` is `a1,a2|b1;a3|b2,b3`, or with ``digest`` its sha256; an empty string without tokens.
    """
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((described, model))
    kinds = [pa.int64()] * 5 + [pa.string(), pa.list_(pa.int64()), pa.list_(pa.int32())]
    names = [part.split()[0] for part in ALIGNED.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        align = aligner(*shared.value)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = align.document(text)
                if found is None:
                    rows.append((doc, 0, 0, 0, 0, "", [], []))
                    continue
                n_a, n_b, n_groups, groups, links = found
                pairs, times = np.unique(links, return_counts=True)
                told = hashlib.sha256(groups).hexdigest() if digest else groups.decode()
                rows.append((doc, n_a, n_b, n_groups, len(links), told, pairs, times.astype(np.int32)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col(id_col).cast("long"), F.col(text_col)).mapInArrow(run, ALIGNED)


def pair_counts(texts: DataFrame) -> DataFrame:
    """(pair, links, best): how many links of the corpus hold the pair, and whether its B id has none with more."""
    counts = texts.select(F.explode(F.arrays_zip("pairs", "times")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
    counts = materialize(counts.agg(F.sum("p.times").cast("long").alias("links")), "pairs")
    # a row for each id of B, of which a vocabulary has tens of thousands
    most = counts.groupBy(F.pmod("pair", F.lit(SHIFT)).alias("_b")).agg(F.max("links").alias("_most"))
    return counts.join(F.broadcast(most), F.pmod("pair", F.lit(SHIFT)) == F.col("_b")).select(
        "pair", "links", (F.col("links") == F.col("_most")).alias("best")
    )


def _heavy(texts: DataFrame, heavy: tuple[np.ndarray, np.ndarray, np.ndarray]) -> DataFrame:
    """``texts`` with n_best and count_sum of their heavy pairs in place of these: ``pairs`` and ``times`` keep the others."""
    shared = texts.sparkSession.sparkContext.broadcast(heavy)
    kept = [c for c in texts.columns if c not in ("pairs", "times")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, links, best = shared.value
        for batch in batches:
            pairs, times = batch.column(len(kept)), batch.column(len(kept) + 1)
            starts = pairs.offsets.to_numpy().astype(np.int64)
            flat = pairs.values.to_numpy(zero_copy_only=False)
            each = times.values.to_numpy(zero_copy_only=False).astype(np.int64)
            place = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
            hit = known[place] == flat if len(known) else np.zeros(len(flat), bool)
            weight = np.where(hit, each, 0)
            sums = [weight * best[place], weight * links[place]] if len(known) else [weight, weight]
            totals = [np.concatenate([[0], np.cumsum(s)]) for s in (*sums, ~hit)]
            parts = [t[starts[1:]] - t[starts[:-1]] for t in totals]
            edges = pa.array(totals[2][starts] - totals[2][starts[0]], pa.int32())
            inside = slice(starts[0], starts[-1])
            light = ~hit[inside]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[: len(kept)],
                    pa.array(parts[0]),
                    pa.array(parts[1]),
                    pa.ListArray.from_arrays(edges, pa.array(flat[inside][light])),
                    pa.ListArray.from_arrays(edges, pa.array(each[inside][light].astype(np.int32))),
                ],
                [*kept, "n_best", "count_sum", "pairs", "times"],
            )

    kinds = {f.name: f.dataType.simpleString() for f in texts.schema}
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", n_best long, count_sum long, pairs array<long>, times array<int>"
    return texts.select(*kept, "pairs", "times").mapInArrow(run, schema)


def align_corpus(
    docs: DataFrame,
    a_path: str | None = None,
    b_path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """One row for each of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and ``groups``.

    A (a byte-level BPE file) encodes a space and the text, B (a sentence-piece model) the text, to which it adds that
    space; both without special tokens. The places where tokens end are searched in those of the other side. A link is a pair of an A and a B token with bytes in common. Its
    count is how many links of the whole corpus have the same ids; ``n_best`` are the links whose count is the highest
    of their B id, ties included, ``count_sum`` adds up the counts.

    Null and empty texts, and texts whose tokens don't give the bytes back, have no tokens: zeros and ''. Repeated rows
    count each and give equal rows; rows without an id are rows like others. Other columns are not read.

    Counts reach the documents in two ways. Pairs with a 2^-18th of all links or more, at most 2^18 by that share, are
    broadcast. The others have few links each and so no hot key: they are joined by a shuffle on the pair.
    """
    import public_tokenizers

    described = Path(a_path or public_tokenizers.path("byte_bpe_50k.json")).read_text(encoding="utf-8")
    model = Path(b_path or public_tokenizers.path("piece_bpe_32k.model")).read_bytes()
    texts = materialize(aligned_texts(docs, described, model, id_col, text_col, digest), "aligned")
    counts = materialize(pair_counts(texts), "pair-counts")
    total = texts.agg(F.sum("n_links")).first()[0] or 0
    least = max(1, total * HEAVY_SHARE)
    heavy = counts.where(F.col("links") >= least).toArrow().sort_by("pair")
    known = tuple(heavy.column(c).to_numpy().astype(np.int64) for c in ("pair", "links", "best"))
    # a name for each row, fixed by writing it
    split = materialize(_heavy(texts, known).withColumn("_row", F.monotonically_increasing_id()), "aligned-light")
    light = split.select("_row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("_row", "p.pairs", "p.times")
    few = counts.where(F.col("links") < least)
    sums = (
        light.join(few.hint("shuffle_hash"), light.pairs == few.pair)
        .groupBy(F.col("_row").alias("_of"))
        .agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("_best"),
            F.sum(F.col("times") * F.col("links")).alias("_sum"),
        )
    )
    return split.join(sums, split._row == sums._of, "left").select(
        "doc_id",
        "n_a",
        "n_b",
        "n_groups",
        "n_links",
        (F.col("n_best") + F.coalesce("_best", F.lit(0))).alias("n_best"),
        (F.col("count_sum") + F.coalesce("_sum", F.lit(0))).alias("count_sum"),
        "groups",
    )


def op13_alignment(spark, sf_dir):
    return align_corpus(table(spark, sf_dir, "documents"), digest=True).withColumnRenamed("groups", "groups_sha256")
