"""k nearest neighbours by cosine from hashed buckets: random hyperplanes, several tables, several probes a table.

A vector's code in a table holds the sides of hyperplanes on which it lies. Candidates are indexed by their code in every
table; a query visits its own bucket and those that differ on the planes it lies nearest to. The number of tables, planes
and probes is fitted on a bounded sample: the cheapest setting that finds ``recall`` of the sample's true neighbours. A
sample's neighbours lie farther off than those among all rows, so that the whole table is no harder.

Candidates stay where they are read, with the codes of their buckets beside them, and meet the queries as in the exact
operator. Equal vectors count once, with the k smallest ids they have, so copies fill no bucket. Queries that meet fewer
than k candidates are answered exactly.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.neighbors import BLOCK_ROWS, CHUNK_ROWS, _ddl, _flat, _products, _unit_rows, best_met, nearest
from tidemark.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows of the sample that the index is fitted on, candidates and queries.
SAMPLE_ROWS, SAMPLE_QUERIES = 1024, 128
TABLES = (1, 2, 4, 8)
MIN_PLANES, MAX_PLANES = 4, 16
MAX_PROBES = 128
#: Buckets hold about so many rows at the largest number of planes.
BUCKET_ROWS = 256
#: Only the nearest planes are crossed, in all combinations.
CROSSED = 10
HASHED_ROWS = 1024


def _sides(indices: np.ndarray, planes: int) -> np.ndarray:
    """+1 or -1 for every index and plane: bits of a hash, so that planes need no known number of dimensions."""
    out = []
    for word in range(-(-planes // 64)):
        with np.errstate(over="ignore"):
            x = indices.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(word + 1)
            x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            x ^= x >> np.uint64(31)
        out.append((x[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1))
    return np.hstack(out)[:, :planes].astype(np.float64) * 2 - 1


def _projected(rows: pd.DataFrame, planes: int) -> np.ndarray:
    """Signed distances of the rows to the planes, up to the rows' lengths."""
    if "indices" not in rows.columns:
        values = np.vstack([np.asarray(v, dtype=np.float64) for v in rows["values"]])
        return values @ _sides(np.arange(values.shape[1]), planes)
    out = np.zeros((len(rows), planes))
    for at, (indices, values) in enumerate(zip(rows["indices"], rows["values"])):
        if len(indices):
            out[at] = np.asarray(values, dtype=np.float64) @ _sides(np.asarray(indices, dtype=np.int64), planes)
    return out


def _codes(projected: np.ndarray) -> np.ndarray:
    return (projected > 0) @ (1 << np.arange(projected.shape[1], dtype=np.int64))


def _crossings(projected: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row the codes it may probe as differences from its own, nearest first, and the summed distances behind them."""
    crossed = min(projected.shape[1], CROSSED)
    nearest_planes = np.argsort(np.abs(projected), axis=1, kind="stable")[:, :crossed]
    distances = np.take_along_axis(np.abs(projected), nearest_planes, axis=1)
    chosen = (np.arange(1 << crossed)[:, None] >> np.arange(crossed)) & 1
    cost = distances @ chosen.T
    order = np.argsort(cost, axis=1, kind="stable")
    differences = (1 << nearest_planes.astype(np.int64)) @ chosen.T
    return np.take_along_axis(differences, order, axis=1), order


@dataclass(frozen=True)
class Index:
    """``tables`` of ``planes`` hyperplanes each; a query visits ``probes`` buckets of every table."""

    tables: int
    planes: int
    probes: int

    def per_table(self, rows: pd.DataFrame) -> list[np.ndarray]:
        every = _projected(rows, self.tables * self.planes)
        return [every[:, t * self.planes : (t + 1) * self.planes] for t in range(self.tables)]

    def homes(self, rows: pd.DataFrame) -> np.ndarray:
        """(rows, tables, 1): the codes under which candidates are kept."""
        return np.stack([_codes(p)[:, None] for p in self.per_table(rows)], axis=1)

    def visits(self, rows: pd.DataFrame) -> np.ndarray:
        """(rows, tables, probes): the codes that queries look up."""
        return np.stack([_codes(p)[:, None] ^ _crossings(p)[0][:, : self.probes] for p in self.per_table(rows)], axis=1)


def _probes_needed(index: Index, queries: pd.DataFrame, candidates: pd.DataFrame, true: np.ndarray) -> np.ndarray:
    """For each query and true neighbour the number of probes after which some table has met it."""
    best = np.full(true.shape, np.iinfo(np.int64).max)
    for asked, known in zip(index.per_table(queries), index.per_table(candidates)):
        apart = _codes(asked)[:, None] ^ _codes(known)[true]
        differences, _ = _crossings(asked)
        for row in range(len(true)):
            order = np.argsort(differences[row], kind="stable")
            at = np.minimum(np.searchsorted(differences[row], apart[row], sorter=order), len(order) - 1)
            met = differences[row][order[at]] == apart[row]
            best[row] = np.where(met, np.minimum(best[row], order[at] + 1), best[row])
    return best


def fit_index(queries: DataFrame, candidates: DataFrame, k: int, recall: float = 0.95) -> Index:
    """The cheapest index that finds ``recall`` of the true neighbours in a sample of both sides."""
    order = F.md5(F.col("id").cast("string"))
    known = candidates.orderBy(order).limit(SAMPLE_ROWS).toPandas()
    asked = queries.orderBy(order).limit(SAMPLE_QUERIES).toPandas()
    everything = Index(1, MIN_PLANES, 1 << MIN_PLANES)
    if not len(known) or not len(asked):
        return everything
    left, right = ((_flat(side) if "indices" in side.columns else _unit_rows(side["values"])[0]) for side in (asked, known))
    true = np.argsort(-_products(left, right, (len(asked), len(known))), axis=1, kind="stable")[:, :k]
    planes_for_all = int(np.clip(np.log2(max(candidates.count() / BUCKET_ROWS, 1)), MIN_PLANES, MAX_PLANES))
    best, cheapest = everything, 1.0
    for planes in range(MIN_PLANES, planes_for_all + 1):
        for tables in TABLES:
            needed = np.sort(_probes_needed(Index(tables, planes, 0), asked, known, true).ravel())
            probes = int(needed[int(np.ceil(recall * len(needed))) - 1])
            cost = tables * probes / (1 << planes)
            if probes <= MAX_PROBES and cost < cheapest:
                best, cheapest = Index(tables, planes, probes), cost
    return best


def _hashed(rows: DataFrame, index: Index, codes_of: str, name: str) -> DataFrame:
    """Rows with the list of their tables and codes, each pair as one number."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), HASHED_ROWS):
                part = batch.iloc[start : start + HASHED_ROWS]
                codes = getattr(index, codes_of)(part)
                table = np.broadcast_to(np.arange(index.tables)[:, None], codes.shape[1:])
                places = (table.ravel() << index.planes) + codes.reshape(len(part), -1)
                yield part.assign(**{name: list(places)})

    return rows.mapInPandas(add, f"{_ddl(rows)}, {name} array<bigint>")


def _usable(rows: DataFrame, vector: list[str]) -> DataFrame:
    """Rows with an id and a vector of finite numbers."""
    bad = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf")))
    known = F.col("id").isNotNull()
    for name in vector:
        known &= F.col(name).isNotNull()
    return rows.select("id", *vector).filter(known & ~F.coalesce(F.exists("values", bad), F.lit(True)))


def nearest_approximate(
    queries: DataFrame,
    candidates: DataFrame,
    k: int,
    recall: float = 0.95,
    index: Index | None = None,
    block_rows: int = BLOCK_ROWS,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """(query_id, id, similarity, rank) of the k most similar candidates met; equal similarity goes by id.

    Inputs as for ``neighbors.nearest``; ids of queries are unique. Every query gets k rows, or all candidates if there
    are fewer. Rows without an id or with a null, missing or non-finite vector take no part; zero vectors have
    similarity 0. Vectors of one call have one length.
    """
    vector = ["indices", "values"] if "indices" in candidates.columns else ["values"]
    known = _usable(candidates, vector)
    alike = Window.partitionBy(*vector).orderBy("id")
    again = F.coalesce(F.lag("id").over(alike) == F.col("id"), F.lit(False))
    numbered = known.withColumns({"_copy": F.row_number().over(alike), "_again": again})
    known = materialize(numbered.filter(F.col("_copy") <= k).drop("_copy"), "candidates")
    asked = materialize(_usable(queries, vector), "queries")
    index = index or fit_index(asked, known.drop("_again"), k, recall)

    # a candidate given several times is met once
    homes = _hashed(known.filter(~F.col("_again")).drop("_again"), index, "homes", "_homes")
    visits = _hashed(asked, index, "visits", "_visits").withColumnRenamed("id", "query_id")
    met = (
        best_met(visits, materialize(homes, "homes"), k, block_rows, chunk_rows)
        .groupBy("query_id", "id")
        .agg(F.max("similarity").alias("similarity"))
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("similarity"), "id")
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    found = materialize(ranked, "met")
    full = found.filter(F.col("rank") == min(k, known.limit(k).count())).select(F.col("query_id").alias("id"))
    short = materialize(asked.join(full, "id", "left_anti"), "short")
    if short.isEmpty():
        return found
    rest = nearest(short, known, k, block_rows=block_rows, chunk_rows=chunk_rows)
    return found.join(short.select(F.col("id").alias("query_id")), "query_id", "left_anti").unionByName(rest)


def recall_rows(found: DataFrame, exact: DataFrame) -> DataFrame:
    """(query_id, neighbours, hits, recall) per query of ``exact``: how many of its true neighbours were found."""
    hits = found.select("query_id", "id", F.lit(1).alias("_hit"))
    joined = exact.select("query_id", "id").join(hits, ["query_id", "id"], "left")
    counted = joined.groupBy("query_id").agg(F.count(F.lit(1)).alias("neighbours"), F.count("_hit").alias("hits"))
    return counted.withColumn("recall", F.col("hits") / F.col("neighbours"))
