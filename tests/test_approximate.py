from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tests.test_neighbors import brute_force, found, frame
from tidemark.operators.approximate import Index, _codes, _crossings, _sides, fit_index, nearest_approximate, recall_rows
from tidemark.operators.neighbors import TASKS_PER_CORE, _flat, _products, best_met, nearest


@pytest.fixture(scope="module")
def clustered():
    """Sixty clusters in 24 dimensions, and a third of the candidates copies of one vector."""
    rng = np.random.default_rng(5)
    centers = rng.normal(size=(60, 24))
    candidates = [(i, centers[i % 60] + 0.4 * rng.normal(size=24)) for i in range(1200)]
    candidates += [(5000 + i, centers[0]) for i in range(600)]
    return [(i, centers[i % 60] + 0.4 * rng.normal(size=24)) for i in range(60)], candidates


def test_probes_come_by_distance():
    projected = np.array([[0.5, -0.1, 2.0]])
    assert _codes(projected).tolist() == [0b101]
    assert _crossings(projected)[0][0].tolist()[:4] == [0, 0b010, 0b001, 0b011]
    assert set(_crossings(projected)[0][0].tolist()) == set(range(8))
    assert abs(_sides(np.arange(4000), 100).mean()) < 0.01


@pytest.mark.parametrize("block, chunk", [(1024, 1024), (40, 7)])
def test_recall_against_the_exact_operator(spark, clustered, block, chunk):
    asked, known = (frame(spark, rows) for rows in clustered)
    got = nearest_approximate(asked, known, 7, block_rows=block, chunk_rows=chunk)
    assert {r["n"] for r in got.groupBy("query_id").agg(F.count("*").alias("n")).collect()} == {7}
    rows = recall_rows(got, nearest(asked, known, 7)).collect()
    assert len(rows) == 60 and sum(r["hits"] for r in rows) >= 0.9 * sum(r["neighbours"] for r in rows)
    exact = {(q, i): s for q, near in brute_force(*clustered, 1900).items() for i, s in near}
    for query, near in found(got).items():
        assert [s for _, s in near] == sorted((s for _, s in near), reverse=True)
        assert all(s == pytest.approx(exact[query, i]) for i, s in near)


def test_a_fitted_index_prunes(spark, clustered):
    asked, known = (frame(spark, rows) for rows in clustered)
    index = fit_index(asked, known, 7)
    assert index.tables * index.probes / (1 << index.planes) < 0.8


def test_sparse_rows_equal_dense_ones(spark, clustered):
    def sparse(rows):
        packed = [(i, [int(n) for n in np.flatnonzero(v > 0)], [float(x) for x in v[v > 0]]) for i, v in rows]
        return spark.createDataFrame(packed, "id int, indices array<int>, values array<double>")

    asked, known = ([(i, np.where(v > 0, v, 0)) for i, v in rows] for rows in clustered)
    index = Index(2, 5, 6)
    one = found(nearest_approximate(sparse(asked), sparse(known), 5, index=index))
    two = found(nearest_approximate(frame(spark, asked), frame(spark, known), 5, index=index))
    assert {q: [i for i, _ in near] for q, near in one.items()} == {q: [i for i, _ in near] for q, near in two.items()}


def test_buckets_that_hold_too_little_are_made_up_for(spark, clustered):
    asked, known = clustered
    got = found(nearest_approximate(frame(spark, asked[:9]), frame(spark, known[:40]), 7, index=Index(1, 12, 1)))
    assert all(len(near) == 7 for near in got.values()) and len(got) == 9


def test_nulls_empties_repeats_and_zero_vectors(spark):
    schema = "id int, values array<double>, extra string"
    known = [(1, [1.0, 0.0], "a"), (2, [1.0, 0.0], "b"), (3, [0.0, 0.0], None), (4, None, "c"), (None, [1.0, 0.0], "d")]
    known += [(5, [float("nan"), 1.0], "e"), (6, [1.0, None], "f")]
    asked = spark.createDataFrame([(10, [2.0, 0.0], "x"), (11, [0.0, 0.0], "y"), (12, None, "z")], schema)
    got = found(nearest_approximate(asked, spark.createDataFrame(known, schema), 2))
    assert got[10] == [(1, 1.0), (2, 1.0)] and set(got) == {10, 11}
    assert len(got[11]) == 2 and all(s == 0.0 for _, s in got[11])
    nothing = spark.createDataFrame([], schema)
    assert nearest_approximate(asked, nothing, 2).count() == 0 and nearest_approximate(nothing, asked, 2).count() == 0


def test_no_vector_is_sent_to_the_blocks_and_chunks_it_meets(spark, clustered):
    asked, known = (frame(spark, rows) for rows in clustered)
    for got in (nearest(asked, known, 7, block_rows=40, chunk_rows=7), nearest_approximate(asked, known, 7, block_rows=40, chunk_rows=7)):
        plan = got._jdf.queryExecution().optimizedPlan().toString()
        assert "CoGroup" not in plan and "Join" not in plan
    tasks = TASKS_PER_CORE * spark.sparkContext.defaultParallelism
    met = best_met(asked.withColumnRenamed("id", "query_id"), known.repartition(3 * tasks), 7, block_rows=40, chunk_rows=7)
    assert met.count() <= tasks * 60 * 7


def test_queries_come_in_chunks_of_bounded_size(spark, clustered, monkeypatch):
    asked, known = (frame(spark, rows) for rows in clustered)
    whole = found(nearest(asked, known, 7))
    monkeypatch.setattr("tidemark.operators.neighbors.QUERY_ROWS", 13)
    assert found(nearest(asked, known, 7)) == whole


def test_products_of_frequent_and_rare_terms(monkeypatch):
    rng = np.random.default_rng(2)
    dense = [np.where(rng.random((n, 50)) < np.linspace(0.01, 0.6, 50), rng.random((n, 50)), 0) for n in (30, 40)]
    sides = [pd.DataFrame({"indices": [np.flatnonzero(r) for r in rows], "values": [r[r > 0] for r in rows]}) for rows in dense]
    units = [rows / np.where(n := np.linalg.norm(rows, axis=1, keepdims=True), n, 1) for rows in dense]
    for share in (0.0, 0.05, 1.0):
        monkeypatch.setattr("tidemark.operators.neighbors.DENSE_SHARE", share)
        monkeypatch.setattr("tidemark.operators.neighbors.PRODUCTS", 50)
        assert _products(_flat(sides[0]), _flat(sides[1]), (30, 40)) == pytest.approx(units[0] @ units[1].T)
