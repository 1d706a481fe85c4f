"""TF-IDF over words and word pairs: document frequency >= 3, at most 50,000 terms, sublinear counts.

weight = (1 + ln tf) * (ln((1 + n) / (1 + df)) + 1), scaled to length 1 per document.

Documents are distributed by id once, over so many partitions that the terms of one are counted and sorted in memory;
counting per document and scaling per document then need no further shuffle, since the vocabulary is broadcast. Only the
term statistics are exchanged, after partial aggregation.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.text import unigrams_and_bigrams, words
from tidemark.session import scratch_path

# The counting function travels with the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# The published vectorizer settings.
MIN_DF = 3
MAX_TERMS = 50_000
# Characters of text in a partition: some 1.5 million words and pairs, a few hundred MB as rows.
PARTITION_CHARS = 1 << 22
# Words whose terms are counted at a time in a task, but for a longer document.
COUNTED_WORDS = 1 << 18


def term_counts(docs: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """(id, term, tf); a document without terms keeps one row with a NULL term."""
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    placed = texts.repartition(max(1, math.ceil(chars / PARTITION_CHARS)), "id")
    tokens = placed.select("id", words("text").alias("tokens"))
    terms = tokens.select("id", F.explode_outer(unigrams_and_bigrams(F.col("tokens"))).alias("term"))
    return terms.groupBy("id", "term").agg(F.count(F.lit(1)).alias("tf"))


def _term_sums(docs: pa.ListArray) -> pa.RecordBatch:
    """(term, df, total) over documents, given as their lists of words."""
    coded = docs.flatten().dictionary_encode()
    words, codes = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
    lengths = pc.fill_null(pc.list_value_length(docs), 0).to_numpy().astype(np.int64)
    lengths = lengths[lengths > 0]
    owner = np.repeat(np.arange(len(lengths)), lengths)
    inside = owner[1:] == owner[:-1]
    # words by their codes, pairs behind them
    keys = np.concatenate([codes, len(words) + codes[:-1][inside] * len(words) + codes[1:][inside]])
    own, used = max(len(lengths), 1), None
    if (len(words) + 1) ** 2 * own >= 1 << 63:
        used, keys = np.unique(keys, return_inverse=True)
    each = np.sort(keys * own + np.concatenate([owner, owner[:-1][inside]]))
    key = each // own
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    df = np.add.reduceat(np.diff(each, prepend=-1) != 0, starts, dtype=np.int64) if len(starts) else starts
    key = key[starts] if used is None else used[key[starts]]
    pair = key[np.searchsorted(key, len(words)) :] - len(words)
    size = max(len(words), 1)
    pairs = pc.binary_join_element_wise(words.take(pa.array(pair // size)), words.take(pa.array(pair % size)), " ")
    terms = pa.concat_arrays([words.take(pa.array(key[: len(key) - len(pair)])), pairs])
    total = np.diff(starts, append=len(each))
    return pa.RecordBatch.from_arrays([terms, pa.array(df), pa.array(total)], ["term", "df", "total"])


def _pieces(docs: pa.ListArray) -> Iterator[pa.ListArray]:
    """Documents of about COUNTED_WORDS words at a time."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(docs), 0).to_numpy().astype(np.int64))
    cuts = np.flatnonzero(np.diff(ends // COUNTED_WORDS)) + 1
    for start, end in zip([0, *cuts], [*cuts, len(docs)]):
        if end > start:
            yield docs.slice(start, end - start)


def _term_sums_of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for piece in _pieces(batch.column(0)):
            yield _term_sums(piece)


def term_df(docs: DataFrame, id_col: str = "id", text_col: str = "text", min_df: int = MIN_DF) -> DataFrame:
    """(term, df, total) of the terms in at least ``min_df`` documents; a row of ``docs`` is a document.

    One pass over the texts: words are found by expressions, the terms of a bounded number of words are numbered, sorted and
    added up in Arrow batches, and only those sums, added up again before the exchange, are shuffled.
    """
    sums = docs.select(words(text_col).alias("tokens")).mapInArrow(_term_sums_of_batches, "term string, df long, total long")
    stats = sums.groupBy("term")
    return stats.agg(F.sum("df").alias("df"), F.sum("total").alias("total")).filter(F.col("df") >= min_df)


class Lookup(NamedTuple):
    """The words in a list of terms, the place of each as a term (-1: none), and the pairs as numbers in order, with their places."""

    words: pa.Array
    place: np.ndarray
    pairs: np.ndarray
    pair_place: np.ndarray


def lookup(terms: Sequence[str]) -> Lookup:
    known = {term: place for place, term in enumerate(terms)}
    parts = {term: term.split(" ") for term in known}
    code = {word: n for n, word in enumerate(dict.fromkeys(word for part in parts.values() if len(part) < 3 for word in part))}
    place = np.full(len(code) + 1, -1, np.int64)
    pairs = []
    for term, part in parts.items():
        if len(part) == 1:
            place[code[term]] = known[term]
        elif len(part) == 2:
            pairs.append((code[part[0]] * len(code) + code[part[1]], known[term]))
    numbers = np.array(sorted(pairs), np.int64).reshape(-1, 2)
    return Lookup(pa.array(list(code), pa.string()), place, numbers[:, 0].copy(), numbers[:, 1].copy())


def _weighed(known: Lookup, idf: np.ndarray, docs: pa.ListArray, of: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(number of terms of each document, indices, values) of the weights of known terms in documents, given as their lists of words.

    With ``of`` lists are parts of documents, which are numbered from 0 on.
    """
    tokens = docs.flatten()
    found = pc.index_in(tokens, value_set=known.words.cast(tokens.type))
    # words that are in no term have the number -1, whose place is -1 too
    code = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    owner = np.repeat(np.arange(len(docs)), pc.fill_null(pc.list_value_length(docs), 0).to_numpy())
    inside = np.flatnonzero((owner[1:] == owner[:-1]) & (code[1:] >= 0) & (code[:-1] >= 0))
    place, pair_place = known.place[code], np.full(len(inside), -1, np.int64)
    if len(known.pairs):
        number = code[inside] * len(known.words) + code[inside + 1]
        at = np.minimum(np.searchsorted(known.pairs, number), len(known.pairs) - 1)
        pair_place = np.where(known.pairs[at] == number, known.pair_place[at], -1)
    size = max(len(idf), 1)
    count = len(docs) if of is None else int(of.max(initial=-1)) + 1
    owner = owner if of is None else of[owner]
    keys = np.concatenate([owner[place >= 0] * size + place[place >= 0], owner[inside[pair_place >= 0]] * size + pair_place[pair_place >= 0]])
    key, tf = np.unique(keys, return_counts=True)
    document, index = key // size, key % size
    times, which = np.unique(tf, return_inverse=True)
    raw = (np.array([math.log(n) for n in times])[which] + 1) * idf[index] if len(key) else np.empty(0)
    starts = np.flatnonzero(np.diff(document, prepend=-1))
    # added up with some digits more, so that a length hardly depends on the order of its terms
    length = np.sqrt(np.add.reduceat((raw * raw).astype(np.longdouble), starts).astype(np.float64)) if len(starts) else raw
    terms = np.bincount(document, minlength=count)
    return terms, index, raw / np.repeat(length, terms[terms > 0])


def weighed_vectors(known: Lookup, idf: np.ndarray, docs: pa.ListArray) -> pa.StructArray:
    """The weights of documents as stored vectors."""
    parts = [_weighed(known, idf, piece) for piece in _pieces(docs)]
    lengths, indices, values = (np.concatenate([part[k] for part in parts] or [np.empty(0, np.int64)]) for k in range(3))
    ends = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
    columns = {
        "type": pa.array(np.zeros(len(docs), np.int8)),
        "size": pa.array(np.full(len(docs), max(len(idf), 1), np.int32)),
        "indices": pa.ListArray.from_arrays(ends, pa.array(indices.astype(np.int32))),
        "values": pa.ListArray.from_arrays(ends, pa.array(values.astype(np.float64))),
    }
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def fit_vocabulary(
    docs: DataFrame, id_col: str = "id", text_col: str = "text", min_df: int = MIN_DF, max_terms: int = MAX_TERMS
) -> DataFrame:
    """(term, idx, df, idf): the ``max_terms`` most frequent terms, numbered alphabetically."""
    stats = term_df(docs, id_col, text_col, min_df)
    kept = stats.orderBy(F.desc("total"), "term").limit(max_terms)
    documents = docs.agg(F.count(F.lit(1)).alias("n")).scalar()
    # max_terms rows at most, so one ordering task is enough.
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("term")) - 1
    idf = F.log((F.lit(1.0) + documents) / (F.lit(1.0) + F.col("df"))) + 1
    return kept.select("term", number.alias("idx"), "df", idf.alias("idf"))


def tfidf_weights(
    docs: DataFrame, vocabulary: DataFrame, id_col: str = "id", text_col: str = "text"
) -> DataFrame:
    """(id, term, idx, weight). The vocabulary, ``MAX_TERMS`` rows or so, is broadcast; hand in a written one."""
    raw = term_counts(docs, id_col, text_col).join(F.broadcast(vocabulary), "term").withColumn("raw", _raw_weight())
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy("id")))
    return raw.select("id", "term", "idx", (F.col("raw") / length).alias("weight"))


def _raw_weight() -> Column:
    return (F.log("tf") + 1) * F.col("idf")


def _vectors(known: Lookup, idf: np.ndarray):
    """A task over (id, tokens) in order of ids: (id, indices, values) for each id; its rows are parts of one document."""

    def weighed(rows: pa.Table) -> pa.RecordBatch:
        ids, tokens = rows["id"].combine_chunks(), rows["tokens"].combine_chunks()
        code = ids.dictionary_encode(null_encoding="encode").indices.to_numpy()
        first = np.flatnonzero(np.diff(code, prepend=-1))
        of = np.cumsum(np.diff(code, prepend=-1) != 0) - 1
        terms, indices, values = _weighed(known, idf, tokens, of)
        ends = pa.array(np.concatenate([[0], np.cumsum(terms)]).astype(np.int32))
        lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in (indices.astype(np.int32), values.astype(np.float64))]
        return pa.RecordBatch.from_arrays([ids.take(pa.array(first)), *lists], ["id", "indices", "values"])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            # documents of about COUNTED_WORDS words at a time; the last one may go on
            starts = 0
            for piece in _pieces(batch.column(1)):
                rows = pa.Table.from_batches([batch.slice(starts, len(piece))])
                starts += len(piece)
                rows = rows if held is None else pa.concat_tables([held, rows])
                code = rows["id"].combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
                last = int(np.flatnonzero(np.diff(code, prepend=-1))[-1])
                if last:
                    yield weighed(rows.slice(0, last))
                held = rows.slice(last)
        if held is not None:
            yield weighed(held)

    return weigh


def tfidf_vectors(
    docs: DataFrame, vocabulary: DataFrame, id_col: str = "id", text_col: str = "text"
) -> DataFrame:
    """(id, indices, values): one sparse row per document, also for documents without known terms.

    Rows of one id are parts of one document. The vocabulary, ``MAX_TERMS`` rows or so, goes along with the tasks, which look
    terms up and weigh them on whole Arrow batches.
    """
    chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    placed = texts.repartition(max(1, math.ceil(chars / PARTITION_CHARS)), "id").sortWithinPartitions("id")
    rows = sorted(vocabulary.select("idx", "term", "idf").collect())
    known, idf = lookup([row["term"] for row in rows]), np.array([row["idf"] for row in rows], np.float64)
    schema = T.StructType([placed.schema["id"], *T.StructType.fromDDL("indices array<int>, values array<double>")])
    return placed.select("id", words("text").alias("tokens")).mapInArrow(_vectors(known, idf), schema)


def term_vectors(
    docs: DataFrame, vocabulary: DataFrame, id_col: str = "id", text_col: str = "text"
) -> DataFrame:
    """``tfidf_vectors`` by a row for each term.

    Slower, but a forest's random numbers go with the last bits and the layout of these rows, so that it is grown on them.
    """
    raw = term_counts(docs, id_col, text_col).join(F.broadcast(vocabulary), "term", "left").withColumn("raw", _raw_weight())
    entry = F.when(F.col("idx").isNotNull(), F.struct("idx", "raw"))
    rows = raw.groupBy("id").agg(
        F.sort_array(F.collect_list(entry)).alias("entries"), F.sqrt(F.sum(F.col("raw") * F.col("raw"))).alias("length")
    )
    return rows.select(
        "id",
        F.col("entries.idx").alias("indices"),
        F.transform("entries.raw", lambda weight: weight / F.col("length")).alias("values"),
    )


def as_features(vectors: DataFrame, size: int, *carried: str) -> DataFrame:
    """Sparse rows as ML vectors, written once: iterative training re-reads them instead of the texts.

    A vector column is stored as a plain struct, so it is written as one and read back as a vector.
    """
    stored = F.struct(
        F.lit(0).cast("tinyint").alias("type"),
        F.lit(size).alias("size"),
        "indices",
        "values",
    )
    plain = vectors.select("id", *carried, stored.alias("features"))
    spark = vectors.sparkSession
    folder = scratch_path(spark, "features")
    plain.write.parquet(folder)
    fields = [f for f in plain.schema.fields if f.name != "features"]
    return spark.read.schema(T.StructType([*fields, T.StructField("features", VectorUDT())])).parquet(folder)
