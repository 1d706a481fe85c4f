"""Language identification by error-correcting output codes over hashed n-grams."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import order_of, table

#: Bound of the labelled rows that are fitted: as many of each language, chosen by hash.
FIT_ROWS = 1600
#: N-grams of one to three bytes of the lower-cased text are hashed to so many bits.
BITS, GRAMS = 15, 3
#: All codes of so many languages have every way to part them; for more, codewords are drawn.
EXHAUSTIVE, DRAWS = 5, 200
#: A prediction is ambiguous when the two nearest codewords' scores are closer than this.
LEAST_LEAD = 0.2
UNDETERMINED = "und"
#: N-gram shares are multiplied by this, so that a frequent one counts about one.
SCALE = 100.0
CHUNK = 1 << 18


@dataclass(frozen=True)
class LanguageModel:
    """Codewords (+1, -1; a row for each language), a binary classifier for each bit, and each bit's worth by language."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    worth: np.ndarray

    def margins(self, shares: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        grams, share = shares
        return self.bias + (self.weights[grams] * share[:, None]).sum(axis=0, dtype=np.float64)

    def scores(self, margins: np.ndarray) -> np.ndarray:
        """A share for each language, from its codeword's loss over the bits, each weighted by how well it knows the language."""
        loss = (self.worth * np.logaddexp(0.0, -self.code * margins)).sum(axis=1) * self.code.shape[1]
        near = np.exp(loss.min() - loss)
        return near / near.sum()


def codewords(count: int) -> np.ndarray:
    """(languages, bits) of +1 and -1: rows far apart, columns neither equal nor opposite nor constant where that can be."""
    if count < 2:
        return np.ones((count, 0))
    if count <= EXHAUSTIVE:
        columns = range(1, 1 << (count - 1))
        return np.array([[1.0 if row == 0 or not column >> (row - 1) & 1 else -1.0 for column in columns] for row in range(count)])
    draw, best, apart = np.random.default_rng(count), None, -1
    bits = math.ceil(10 * math.log2(count))
    for _ in range(DRAWS):
        code = draw.choice([-1.0, 1.0], (count, bits))
        code[0, np.abs(code.sum(axis=0)) == count] *= -1
        least = min(int((code[k] != code[k + 1 :]).sum(axis=1).min()) for k in range(count - 1))
        if least > apart:
            best, apart = code, least
    return best


def gram_shares(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashed n-grams, SCALE times the share of each): whole texts, lower-cased, white space as one space."""
    data = np.frombuffer(b" " + " ".join(text.lower().split()).encode() + b" ", np.uint8)
    counts, total = np.zeros(1 << BITS, np.int64), 0
    for at in range(0, len(data), CHUNK):
        part = data[at : at + CHUNK + GRAMS - 1].astype(np.uint32)
        code = np.ones(len(part), np.uint32)
        for n in range(GRAMS):
            code = code[: len(part) - n] * np.uint32(256) + part[n:]
            mixed = (code * np.uint32(2654435761)) >> np.uint32(32 - BITS)
            found = mixed[: min(CHUNK, len(mixed))]
            counts += np.bincount(found, minlength=1 << BITS)
            total += len(found)
    grams = np.flatnonzero(counts)
    return grams, counts[grams] * (SCALE / max(1, total))


def labelled_shares(rows: DataFrame, fit_rows: int = FIT_ROWS) -> DataFrame:
    """(lang, order, grams, shares) of at most ``fit_rows`` of ``rows`` (_id, text, lang), as many of each language.

    Rows are chosen by a hash of id and text below a mark that lets a few more pass than are wanted, so that only these
    are moved; the first ones by hash are taken.
    """
    counts = rows.groupBy("lang").agg(F.count("*").alias("_n"))
    each = F.greatest(F.floor(F.lit(fit_rows) / F.count("*").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing).orderBy(F.lit(1)))), F.lit(1))
    marks = counts.select(F.col("lang").alias("_lang"), each.alias("_each"), (each * 1.5 / F.col("_n") + 50 / F.col("_n")).alias("_mark"))
    order = F.xxhash64("_id", "text", F.lit("fit"))
    hashed = rows.withColumn("order", order).withColumn("_u", F.shiftrightunsigned("order", 11) / F.lit(float(1 << 53)))
    passed = hashed.join(F.broadcast(marks), F.col("lang") == F.col("_lang")).where("_u < _mark")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("order", "_id"))
    chosen = passed.select("lang", "order", "_id", "text", "_each").withColumn("_place", place).where("_place <= _each")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [gram_shares(text) for text in batch.column(2).to_pylist()]
            columns = [pa.array([f[0] for f in found], pa.list_(pa.int32())), pa.array([f[1] for f in found], pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *columns], ["lang", "order", "grams", "shares"])

    return chosen.select("lang", "order", "text").mapInArrow(run, "lang string, order long, grams array<int>, shares array<double>")


def fit(languages: list[str], known: np.ndarray, grams: list[np.ndarray], shares: list[np.ndarray], rounds: int = 30, step: float = 0.15) -> LanguageModel:
    """One logistic regression for each bit of the codewords, by Adam, over the n-grams of the fitted rows."""
    code = codewords(len(languages))
    bits = code.shape[1]
    if not bits:
        return LanguageModel(languages, code, np.zeros((1 << BITS, 0), np.float32), np.zeros(0), np.zeros((len(languages), 0)))
    starts = np.concatenate([[0], np.cumsum([len(g) for g in grams])[:-1]])
    used, place = np.unique(np.concatenate(grams), return_inverse=True)
    share = np.concatenate(shares)
    row = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
    wanted = code[known]  # rows x bits
    theta, bias = np.zeros((len(used), bits)), np.zeros(bits)
    mean, square = np.zeros((len(used) + 1, bits)), np.zeros((len(used) + 1, bits))
    for turn in range(1, rounds + 1):
        margin = bias + np.add.reduceat(theta[place] * share[:, None], starts, axis=0)
        pull = -wanted / (1 + np.exp(np.clip(wanted * margin, -30, 30))) / len(grams)
        grad = np.empty_like(mean)
        for bit in range(bits):
            grad[:-1, bit] = np.bincount(place, weights=share * pull[row, bit], minlength=len(used))
        grad[:-1] += 1e-4 * theta
        grad[-1] = pull.sum(axis=0)
        mean, square = 0.9 * mean + 0.1 * grad, 0.99 * square + 0.01 * grad * grad
        move = step * (mean / (1 - 0.9**turn)) / (np.sqrt(square / (1 - 0.99**turn)) + 1e-8)
        theta, bias = theta - move[:-1], bias - move[-1]
    weights = np.zeros((1 << BITS, bits), np.float32)
    weights[used] = theta
    right = wanted * (bias + np.add.reduceat(theta[place] * share[:, None], starts, axis=0)) > 0
    worth = np.array([right[known == k].mean(axis=0) for k in range(len(languages))])
    worth = np.maximum(worth, 1e-6)
    return LanguageModel(languages, code, weights, bias, worth / worth.sum(axis=1, keepdims=True))


def train(rows: DataFrame, fit_rows: int = FIT_ROWS) -> LanguageModel:
    """Fits on at most ``fit_rows`` of ``rows`` (_id, text, lang), or one of each language if there are more languages."""
    found = labelled_shares(rows.where("text is not null and lang is not null"), fit_rows).toArrow()
    found = found.sort_by([("lang", "ascending"), ("order", "ascending")])
    names = found.column("lang").to_pylist()
    languages = sorted(set(names))
    known = np.array([languages.index(name) for name in names], np.int64)
    grams = [np.array(g, np.int64) for g in found.column("grams").to_pylist()]
    shares = [np.array(s, np.float64) for s in found.column("shares").to_pylist()]
    return fit(languages, known, grams, shares)


def identify(docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, lang_pred, score, ambiguous) for each row, by its text alone: the language of the nearest codeword.

    Texts that are null or have no letter, and all texts where nothing was learned, are `und` with score 0. A single learned
    language is always the nearest. Repeated rows give equal rows. One pass over whole texts, no shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "lang_pred", "score", "ambiguous"]
    kinds = [pa.int64(), pa.string(), pa.float64(), pa.bool_()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = shared.value
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not fitted.languages or not any(map(str.isalpha, text or "")):
                    rows.append((doc, UNDETERMINED, 0.0, True))
                    continue
                scores = fitted.scores(fitted.margins(gram_shares(text)))
                best = int(scores.argmax())
                lead = scores[best] - (np.sort(scores)[-2] if len(scores) > 1 else 0.0)
                rows.append((doc, fitted.languages[best], float(scores[best]), bool(lead < LEAST_LEAD)))
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    typed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return typed.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(id_col: str = "doc_id"):
    """Whether crc32 of the id, as text, leaves 2 modulo 4; false without an id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def learned_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(_id, text, lang) that a model may learn from: not held out, with an id, a text and a language."""
    rows = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col))
    return rows.select(order_of(id_col).alias("_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))


def op11_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(learned_rows(docs)))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")
