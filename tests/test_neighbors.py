from __future__ import annotations

import numpy as np
import pandas as pd
import pytest

from tidemark.operators import neighbors
from tidemark.operators.neighbors import knn_vote, nearest


def brute_force(queries, candidates, k):
    out = {}
    for q, v in queries:
        scored = []
        for c, w in candidates:
            length = np.linalg.norm(v) * np.linalg.norm(w)
            scored.append((-round(float(np.dot(v, w) / length) if length else 0.0, 10) + 0.0, c))
        out[q] = [(c, -s) for s, c in sorted(scored)[:k]]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["id"], r["similarity"]))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in rows], "id int, values array<double>")


@pytest.fixture(scope="module")
def vectors():
    """A third of the candidates are copies of one vector; some are zero, some queries equal candidates."""
    rng = np.random.default_rng(3)
    centers = rng.normal(size=(5, 6))
    candidates = [(i, centers[i % 5] + 0.1 * rng.normal(size=6)) for i in range(200)]
    candidates += [(200 + i, centers[0]) for i in range(110)] + [(400, np.zeros(6)), (401, np.zeros(6))]
    queries = [(i, centers[i % 5] + 0.3 * rng.normal(size=6)) for i in range(40)]
    return queries + [(50, centers[0]), (51, np.zeros(6)), (52, candidates[7][1])], candidates


@pytest.mark.parametrize("pivots, block, chunk", [(8, 1024, 1024), (8, 16, 10), (0, 32, 16), (3, 1, 1000), (400, 64, 64)])
def test_exact_with_hot_groups_and_small_blocks(spark, vectors, pivots, block, chunk):
    queries, candidates = vectors
    got = found(nearest(frame(spark, queries), frame(spark, candidates), 7, pivots, block, chunk))
    want = brute_force(queries, candidates, 7)
    assert {q: [c for c, _ in rows] for q, rows in got.items()} == {q: [c for c, _ in rows] for q, rows in want.items()}
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]])


def test_fewer_candidates_than_k(spark, vectors):
    queries, candidates = vectors
    got = found(nearest(frame(spark, queries[:3]), frame(spark, candidates[:2]), 5))
    assert all(len(rows) == 2 for rows in got.values()) and len(got) == 3


def test_no_candidates(spark, vectors):
    assert nearest(frame(spark, vectors[0]), frame(spark, vectors[1]).filter("false"), 3).count() == 0


def test_sparse_equals_dense(spark, vectors):
    queries, candidates = vectors

    def sparse(rows):
        packed = [(i, [int(n) for n in np.flatnonzero(v > 0)], [float(x) for x in v[v > 0]]) for i, v in rows]
        return spark.createDataFrame(packed, "id int, indices array<int>, values array<double>")

    positive = [[(i, np.where(v > 0, v, 0)) for i, v in rows] for rows in (queries, candidates)]
    got = found(nearest(sparse(queries), sparse(candidates), 7, block_rows=50, chunk_rows=20))
    want = brute_force(*positive, 7)
    for q in want:
        assert [s for _, s in got[q]] == pytest.approx([s for _, s in want[q]], abs=1e-9)
        assert [c for c, _ in got[q]] == [c for c, _ in want[q]]


def test_candidates_are_placed_few_at_a_time(spark, monkeypatch):
    seen, measure = [], neighbors._pivot_distances

    def measured(units, pivots):
        seen.append(len(units))
        return measure(units, pivots)

    class Local:
        schema = ()

        def mapInPandas(self, function, ddl):
            return pd.concat(function(iter([pd.DataFrame({"values": list(rng.normal(size=(3 * neighbors.ROUTED_ROWS + 5, 4)))})])))

    rng = np.random.default_rng(1)
    monkeypatch.setattr(neighbors, "_pivot_distances", measured)
    centers = np.eye(4)
    placed = neighbors._placed(Local(), centers)
    assert max(seen) <= neighbors.ROUTED_ROWS and sum(seen) == len(placed)
    apart = measure(neighbors._unit_rows(placed["values"])[0], centers)
    assert placed["_group"].tolist() == apart.argmin(axis=1).tolist() and placed["_radius"].to_numpy() == pytest.approx(apart.min(axis=1))


def test_votes(spark):
    near = spark.createDataFrame(
        [(1, 10, 0.5, 1), (1, 11, 0.75, 2), (1, 12, 0.5, 3), (2, 10, 1.0, 1), (2, 11, 0.9, 2), (3, 12, 0.5, 1), (3, 10, 0.5, 2)],
        "query_id int, id int, similarity double, rank int",
    )
    labels = spark.createDataFrame([(10, 0), (11, 1), (12, 0)], "id int, label int")
    rows = {(r["query_id"], r["label"]): r for r in knn_vote(near, labels).collect()}
    assert rows[1, 0]["vote"] == 4.0 and rows[1, 1]["vote"] == 4.0 and rows[1, 1]["predicted"] == 0
    assert rows[2, 0]["proba"] == 1.0 and rows[2, 1]["proba"] == 0.0 and rows[2, 1]["predicted"] == 0
    assert {r["label"] for r in knn_vote(near, labels, k=1).collect() if r["query_id"] == 1} == {0}


@pytest.mark.parametrize("block, chunk, columns", [(4096, 1024, 2048), (16, 7, 3), (5, 40, 0)])
def test_sparse_blocks_against_brute_force(spark, monkeypatch, block, chunk, columns):
    """Frequent, rare and unknown terms, equal vectors, empty ones; queries that have k and meet further blocks."""
    rng = np.random.default_rng(9)
    monkeypatch.setattr(neighbors, "MAX_COLUMNS", columns)

    def rows(first, count):
        out = []
        for i in range(first, first + count):
            chosen = sorted({*(int(t) for t in rng.integers(0, 6, 3)), *(int(t) for t in rng.integers(6, 400, 5))}) if i % 11 else []
            out.append((i, chosen, [float(x) for x in rng.choice([0.5, 1.0, 2.0], len(chosen))]))
        return out

    known, asked = rows(0, 150), rows(1000, 25)
    known += [(500 + i, *known[3][1:]) for i in range(20)]
    wide = lambda some: [(i, np.bincount(t, v, 400) if t else np.zeros(400)) for i, t, v in some]
    frame = lambda some: spark.createDataFrame(some, "id int, indices array<int>, values array<double>")
    got = found(nearest(frame(asked), frame(known), 7, block_rows=block, chunk_rows=chunk))
    want = brute_force(wide(asked), wide(known), 7)
    assert {q: [c for c, _ in r] for q, r in got.items()} == {q: [c for c, _ in r] for q, r in want.items()}
    assert all([s for _, s in got[q]] == pytest.approx([s for _, s in want[q]]) for q in want)


def test_what_falls_short_of_the_kth_best_is_not_ranked(monkeypatch):
    best, found = np.array([[0.9, 0.8], [0.5, 0.4]]), np.array([[4, 9], [7, 8]])
    monkeypatch.setattr(neighbors, "_best", None)
    neighbors._merged(best, found, np.array([0, 1]), np.array([[0.8, 0.1, 0.79], [0.1, 0.3, 0.6]]), np.array([5, 6, 10]), 2)
    assert found.tolist() == [[4, 5], [10, 7]] and best.tolist() == [[0.9, 0.8], [0.6, 0.5]]
