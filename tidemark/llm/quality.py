"""Ordinal quality classifier: cumulative-link regression on graded ratings over hashed text."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import shielded, table

#: Ratings: 0 toxic, 1 low quality, 2 good and clean.
GRADES = 3
BITS = 18
#: Bound of the labelled rows that are fitted, the first ones by hash of their id.
FIT_ROWS = 8000
#: A document is kept when the chance of the best grade is at least this.
LEAST_TAIL = 0.3
#: A feature takes part when this many fitted documents have it and its z-score against some tail is at least so high.
LEAST_DOCS, LEAST_Z = 5, 5.0
#: Letters of the word beginnings that count as features beside whole words.
STEM = 4
MARKS = re.compile(rb"[^0-9a-zA-Z\x80-\xff]+")


@dataclass(frozen=True)
class OrdinalModel:
    """P(grade >= k) = sigmoid(weights of the text - threshold k); the thresholds ascend, the weights are shared."""

    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, margins: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(margins[:, None] - self.thresholds[None, :], -40, 40)))


def hashed(text: bytes | None, bits: int = BITS) -> np.ndarray:
    """Distinct feature numbers of a text: lower-cased words without marks, their first letters, the marks, and case."""
    mask = (1 << bits) - 1
    found = set()
    for word in set((text or b"").split()):
        bare = MARKS.sub(b"", word)
        lower = bare.lower()
        found.add(zlib.crc32(lower) & mask)
        stem = lower.decode("utf-8", "replace")[: STEM + 1]
        if len(stem) > STEM:
            found.add(zlib.crc32(b"\x02" + stem[:STEM].encode()) & mask)
        if len(bare) < len(word):
            found.update(zlib.crc32(b"\x00" + mark) & mask for mark in MARKS.findall(word))
        if len(bare) > 1 and bare.isupper():
            found.add(zlib.crc32(b"\x01upper") & mask)
    return np.fromiter(found, np.int64, len(found))


def rating(quality: Column, toxic: Column) -> Column:
    """Null where a label is missing or is none of 0 and 1. Toxic is the worst grade, whatever the quality."""
    return F.when((toxic == 1) & quality.isin(0, 1), 0).when((toxic == 0) & (quality == 0), 1).when((toxic == 0) & (quality == 1), 2)


def labelled_features(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(doc_id, rating, features) of at most ``fit_rows`` labelled documents, chosen by hash of the id."""
    rated = labels.select("doc_id", rating(F.col("quality"), F.col("toxic")).alias("rating")).where(
        "doc_id is not null and rating is not null"
    )
    chosen = rated.groupBy("doc_id").agg(F.min("rating").alias("rating")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # of an id given more than once the smallest text counts, so that no more rows than ids are fitted
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "rating").agg(F.min("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [hashed(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(found, pa.list_(pa.int32()))], ["doc_id", "rating", "features"]
            )

    return rows.select("doc_id", F.col("text").cast("binary").alias("text"), F.col("rating").cast("long")).mapInArrow(
        run, "doc_id long, rating long, features array<int>"
    )


def informative(features: list[np.ndarray], ratings: np.ndarray) -> np.ndarray:
    """Flags of the features that are often enough and go with a tail of the grades beyond chance."""
    flat = np.concatenate(features)
    lengths = [len(f) for f in features]
    docs = np.bincount(flat, minlength=1 << BITS)
    highest = np.zeros(1 << BITS)
    for grade in range(1, GRADES):
        tail = (ratings >= grade).astype(float)
        pull = np.bincount(flat, weights=np.repeat(tail - tail.mean(), lengths), minlength=1 << BITS)
        spread = np.sqrt(np.maximum(docs * (1 - docs / len(ratings)) * tail.var(), 1e-12))
        highest = np.maximum(highest, np.abs(pull) / spread)
    return (docs >= LEAST_DOCS) & (highest >= LEAST_Z)


def fit(features: list[np.ndarray], ratings: np.ndarray, rounds: int = 300, penalty: float = 1e-3, step: float = 0.05) -> OrdinalModel:
    """Maximum penalized likelihood of the informative features by Adam; rare grades weigh more."""
    telling = informative(features, ratings)
    features = [f[telling[f]] for f in features]
    lengths = np.array([len(f) for f in features])
    used, place = np.unique(np.concatenate(features), return_inverse=True)
    row = np.repeat(np.arange(len(features)), lengths)
    counts = np.bincount(ratings, minlength=GRADES)
    balance = (len(ratings) / (GRADES * np.maximum(counts, 1)))[ratings] ** 0.5
    theta = np.concatenate([np.zeros(len(used)), [-1.0, np.log(1.0)]])
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    for turn in range(1, rounds + 1):
        weights, first, gap = theta[:-2], theta[-2], np.exp(theta[-1])
        bounds = np.array([first, first + gap])
        margin = np.bincount(row, weights=weights[place], minlength=len(features))
        cumulated = 1 / (1 + np.exp(-np.clip(bounds[None, :] - margin[:, None], -30, 30)))  # P(grade <= k)
        edges = np.concatenate([np.zeros((len(features), 1)), cumulated, np.ones((len(features), 1))], axis=1)
        slopes = np.concatenate([np.zeros((len(features), 1)), cumulated * (1 - cumulated), np.zeros((len(features), 1))], axis=1)
        at = np.arange(len(features))
        chance = np.maximum(edges[at, ratings + 1] - edges[at, ratings], 1e-9)
        upper, lower = slopes[at, ratings + 1] / chance * balance, slopes[at, ratings] / chance * balance
        pull = (upper - lower) / len(features)  # of the negative log likelihood, by the margin
        grad = np.empty_like(theta)
        grad[:-2] = np.bincount(place, weights=pull[row], minlength=len(used)) + penalty * weights
        by_bound = [-(upper * (ratings == k) - lower * (ratings == k + 1)).sum() / len(features) for k in range(2)]
        grad[-2], grad[-1] = sum(by_bound), by_bound[1] * gap
        mean = 0.9 * mean + 0.1 * grad
        square = 0.999 * square + 0.001 * grad * grad
        theta -= step * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.999**turn)) + 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = theta[:-2]
    return OrdinalModel(weights, np.array([theta[-2], theta[-2] + np.exp(theta[-1])]))


def train(docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> OrdinalModel:
    """Fits on at most ``fit_rows`` labelled documents. Without any, every document gets the best grade."""
    rows = labelled_features(docs, labels, fit_rows).toArrow().sort_by([("doc_id", "ascending")])
    features = [np.array(f, np.int64) for f in rows.column("features").to_pylist()]
    ratings = np.array(rows.column("rating").to_pylist(), np.int64)
    if not len(ratings):
        return OrdinalModel(np.zeros(1 << BITS, np.float32), np.array([-40.0, -40.0]))
    return fit(features, ratings)


def score(docs: DataFrame, model: OrdinalModel, least_tail: float = LEAST_TAIL) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_at_least_1``, ``p_at_least_2`` (double) and ``selected`` added.

    A null or empty text has no features and so the grade of the thresholds alone; whole texts count; equal texts are
    graded alike. Existing columns of these names are replaced, all others kept whatever their names. One pass, no shuffle.
    """
    added = ["expected_grade", "p_at_least_1", "p_at_least_2", "selected"]
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in added])
    docs, named = shielded(docs, ("text",))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    where = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            texts = batch.column(where).cast(pa.binary() if pa.types.is_string(batch.column(where).type) else pa.large_binary())
            margins = np.array([fitted.weights[hashed(text)].sum(dtype=np.float64) for text in texts.to_pylist()], np.float64)
            tails = fitted.tails(margins)
            columns = [tails.sum(axis=1), tails[:, 0], tails[:, 1], tails[:, 1] >= least_tail]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(pa.array, columns)], [*batch.schema.names, *added])

    wide = docs.withColumns({name: F.lit(0.0) for name in added[:3]} | {added[3]: F.lit(True)})
    return docs.mapInArrow(run, wide.schema).select(*named, *added)


def op9_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.drop("text")
