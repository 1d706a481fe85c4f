"""Exact top-k search by distributed histogram selection."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import table
from tidemark.session import materialize

#: Queries that are broadcast at a time: with 64 whole-number components as doubles, 4 MB.
QUERY_CHUNK = 8192
#: Candidates scored at a time in a task, bins of a histogram, and how many rows at the kth value's bin are few enough.
SCORE_ROWS = 512
BINS = 256
SCALE = 1024


def whole_vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, v: array<double> of floor(SCALE * x)); vectors that are null or hold null or non-finite components go."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    typed = rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return typed.where(F.col("id").isNotNull() & F.col("v").isNotNull() & F.forall("v", finite)).select(
        "id", F.transform("v", lambda x: F.floor(x * F.lit(float(SCALE))).cast("double")).alias("v")
    )


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _scored(shared, width: int, use) -> object:
    """A task over candidates: ``use(rows seen, ids, scores)`` for blocks of candidates against all broadcast queries.

    Scores are computed in the number type of the queries: whole numbers of a sum below 2^53 are exact in doubles.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, matrix, extra = shared.value
        state = use(len(ids), extra)
        for batch in batches:
            if not batch.num_rows:
                continue
            rows, vectors = batch.column(0).to_numpy(zero_copy_only=False), _matrix(batch.column(1), width).astype(matrix.dtype)
            for at in range(0, len(rows), SCORE_ROWS):
                block, own = vectors[at : at + SCORE_ROWS], rows[at : at + SCORE_ROWS]
                scores = (matrix @ block.T).astype(np.int64)
                yield from state.add(scores, own, ids[:, None] != own[None, :])
        yield from state.end()

    return run


def _batch(names: list[str], *columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, np.int64)) for c in columns], names)


class _Ranges:
    """Count, lowest and highest score of each query."""

    names = ["q", "n", "low", "high"]

    def __init__(self, queries: int, _):
        big = np.iinfo(np.int64)
        self.n, self.low, self.high = np.zeros(queries, np.int64), np.full(queries, big.max), np.full(queries, big.min)

    def add(self, scores, own, others):
        big = np.iinfo(np.int64)
        self.n += others.sum(axis=1)
        self.low = np.minimum(self.low, np.where(others, scores, big.max).min(axis=1))
        self.high = np.maximum(self.high, np.where(others, scores, big.min).max(axis=1))
        return ()

    def end(self):
        some = np.flatnonzero(self.n)
        yield _batch(self.names, some, self.n[some], self.low[some], self.high[some])


class _Histogram:
    """Counts of each query's scores from low to below low + span, in BINS equal bins; others lie outside."""

    names = ["q", "bin", "n"]

    def __init__(self, queries: int, extra):
        self.low, self.span = extra
        self.width = -(-self.span // BINS)
        self.counts = np.zeros(queries * BINS, np.int64)

    def add(self, scores, own, others):
        # the bins together may reach beyond the span, where scores are counted as above already
        past = scores - self.low[:, None]
        bins, inside = past // self.width[:, None], others & (past >= 0) & (past < self.span[:, None])
        flat = (bins + BINS * np.arange(len(scores))[:, None])[inside]
        self.counts += np.bincount(flat, minlength=len(self.counts))
        return ()

    def end(self):
        some = np.flatnonzero(self.counts)
        yield _batch(self.names, some // BINS, some % BINS, self.counts[some])


class _Winners:
    """Scores above each query's kth value, and of those equal to it the smallest ids, as many as are wanted."""

    names = ["q", "id", "score"]

    def __init__(self, queries: int, extra):
        self.kth, self.wanted = extra
        self.ties: list[np.ndarray] = [np.array([], np.int64)] * queries

    def add(self, scores, own, others):
        q, c = np.nonzero(others & (scores > self.kth[:, None]))
        if len(q):
            yield _batch(self.names, q, own[c], scores[q, c])
        q, c = np.nonzero(others & (scores == self.kth[:, None]))
        for query in np.unique(q):
            met = np.concatenate([self.ties[query], own[c[q == query]]])
            self.ties[query] = np.sort(met)[: self.wanted[query]]

    def end(self):
        for query, met in enumerate(self.ties):
            if len(met):
                yield _batch(self.names, np.full(len(met), query), met, np.full(len(met), self.kth[query]))


def _select(rows: DataFrame, queries: tuple[np.ndarray, np.ndarray], width: int, k: int) -> DataFrame:
    """(query_id, vec_id, score) of the k best candidates of one bounded chunk of queries."""
    context = rows.sparkSession.sparkContext
    ids, matrix = queries

    def over(use, extra, schema: str) -> DataFrame:
        shared = context.broadcast((ids, matrix, extra))
        return rows.mapInArrow(_scored(shared, width, use), schema)

    # what is gathered has a row for each query of the chunk, or for each query and bin, whatever the candidates
    gathered = over(_Ranges, None, "q long, n long, low long, high long").groupBy("q").agg(
        F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    count, low, high = (np.zeros(len(ids), np.int64) for _ in range(3))
    for row in gathered.collect():
        count[row["q"]], low[row["q"]], high[row["q"]] = row["n"], row["low"], row["high"]
    # of each query: [low, low + span) holds the kth value, and ``above`` candidates lie beyond it
    wanted, above = np.minimum(k, count), np.zeros(len(ids), np.int64)
    span = high - low + 1
    while (span[wanted > 0] > 1).any():
        size = -(-span // BINS)
        bins = over(_Histogram, (low, span), "q long, bin long, n long").groupBy("q", "bin").agg(F.sum("n").alias("n"))
        # the highest bin down to which the counts reach the wanted rank
        down = Window.partitionBy("q").orderBy(F.desc("bin"))
        beyond = bins.withColumn("upto", F.sum("n").over(down))
        for row in (
            beyond.join(
                F.broadcast(
                    rows.sparkSession.createDataFrame(
                        [(q, int(wanted[q] - above[q])) for q in range(len(ids))], "q long, need long"
                    )
                ),
                "q",
            )
            .where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("n") < F.col("need")))
            .select("q", "bin", (F.col("upto") - F.col("n")).alias("above"))
            .collect()
        ):
            q = row["q"]
            low[q] += row["bin"] * size[q]
            above[q] += row["above"]
            span[q] = min(size[q], span[q] - row["bin"] * size[q])
        span[wanted == 0] = 1
    found = over(_Winners, (low, wanted - above), "q long, id long, score long")
    names = rows.sparkSession.createDataFrame([(n, int(i)) for n, i in enumerate(ids)], "q long, query_id long")
    return found.join(F.broadcast(names), "q").select("query_id", F.col("id").alias("vec_id"), "score")


def top_k(
    rows: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", chunk: int = QUERY_CHUNK
) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k highest inner products of whole-number vectors, exactly.

    Every candidate is scored against the queries, a bounded chunk of them at a time, which is broadcast; candidates
    stay where they are read. Each pass adds up a histogram of the scores for each query and narrows the range that
    holds its kth value, until that is one number; a last pass keeps the scores above it and, of the ties, the
    smallest ids. A query isn't its own candidate. Vectors that are null or hold a null or non-finite component, and
    rows without an id, take no part, nor do those of another length than most vectors have (the shorter of two
    equally frequent lengths counts) and empty ones. Repeated rows are candidates each; a query given twice is answered once. Scores from
    2^53 on are computed in whole numbers; those that could reach 2^62 raise an error.
    """
    spark = rows.sparkSession
    asked = materialize(whole_vectors(queries, id_col, vector_col).distinct(), "queries")
    written = materialize(whole_vectors(rows, id_col, vector_col), "vectors")
    longest = F.max(F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)))
    lengths = written.where(F.size("v") > 0).groupBy(F.size("v").alias("n")).agg(F.count("*").alias("rows"), longest.alias("norm"))
    head = lengths.orderBy(F.desc("rows"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if head is None:
        return empty
    width = int(head["n"])
    if head["norm"] ** 2 >= 2.0**62:
        raise ValueError("scores would not be exact")
    number_type = np.float64 if head["norm"] ** 2 < 2.0**53 else np.int64
    fits = F.size("v") == width
    chunks = -(-asked.count() // chunk)
    results = None
    for number in range(chunks):
        some = asked.where(fits & (F.pmod(F.xxhash64("id"), F.lit(chunks)) == number)).toArrow().sort_by("id")
        if not some.num_rows:
            continue
        ids = some.column("id").to_numpy()
        matrix = _matrix(some.column("v").combine_chunks(), width)
        found = _select(written.where(fits), (ids, np.ascontiguousarray(matrix, dtype=number_type)), width, k)
        results = found if results is None else results.unionByName(found)
    if results is None:
        return empty
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = results.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op4_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return top_k(rows, rows.where(F.col("vec_id") % 100 == 0), k=10)


OP4_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
), r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
         vec_id, score FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
