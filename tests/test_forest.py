from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector, SparseVector
from pyspark.sql import functions as F

from tidemark.operators import forest
from tidemark.operators.forest import Bins, ForestModel, Level, bag_weights, draw_level, grow_forest
from tidemark.operators.models import fit_forest


def dense_or_sparse(rng, row):
    if rng.random() < 0.5:
        return DenseVector(row)
    stored = {i: x for i, x in enumerate(row) if x or rng.random() < 0.2}
    return SparseVector(len(row), stored)


def walked(nodes, trees, row):
    total = np.zeros(nodes.share.shape[1])
    for at in range(trees):
        while nodes.feature[at] >= 0:
            at = (nodes.left if row.get(nodes.feature[at], 0.0) <= nodes.threshold[at] else nodes.right)[at]
        total += nodes.share[at]
    return total


@pytest.mark.parametrize("held, batch_rows", [(1 << 20, 7), (1, 10_000), (1, 1)])
def test_splits_against_brute_force(monkeypatch, held, batch_rows):
    rng, trees, seed, size, classes = random.Random(3), 3, 11, 13, 3
    rows = [{f: rng.choice([-2.0, -1.0, 0.0, 0.5, 1.0, 3.0]) for f in range(size) if rng.random() < 0.6} for _ in range(70)]
    labels = [rng.randrange(classes) for _ in rows]
    bounds = np.array([[-1.5, -0.5, 0.25, 2.0]] * size)
    bounds[4, 2:] = np.inf
    bins = Bins(bounds, (bounds < np.inf).sum(axis=1).astype(np.int32), (bounds < 0).sum(axis=1).astype(np.int32))
    columns = [list(range(100, 170)), labels, [sorted(r) for r in rows], [[r[f] for f in sorted(r)] for r in rows]]
    types = [pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.float64())]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["row", "label", "idx", "values"])
    weight = bag_weights(np.arange(100, 170), trees, seed)
    assert abs(bag_weights(np.arange(20_000), 2, seed).mean() - 1) < 0.02
    binned = [b for half in (batch.slice(0, 33), batch.slice(33)) for b in forest._binned(bins, iter([half]))]
    # the roots are split by the first feature at zero, and their children are looked at; the second tree's root is a leaf
    level = Level(np.array([0, -1, 2], np.int32), np.array([1, 0, 1], np.int32), np.array([0, -1, 2], np.int32), np.array([1, -1, 3], np.int32))
    node, draw = np.arange(9, 13).astype(np.uint32) * np.uint32(2654435761), draw_level(size, seed, 1)
    roots = np.arange(trees, dtype=np.int32)
    monkeypatch.setattr(forest, "HELD", held)
    # each half is a task's
    counted = [b for half in binned for b in forest._counted((size, roots, seed, bins.zero, [level]), draw, node, 5, classes, iter([half]))]
    given = pa.Table.from_batches(counted).sort_by("slot").combine_chunks().to_batches()[0]
    cut = [given.slice(at, batch_rows) for at in range(0, len(given), batch_rows)]
    total = np.zeros((4, classes), np.int64)

    def gini(counts):
        return 1 - sum((c / sum(counts)) ** 2 for c in counts) if sum(counts) else 0.0

    def bin_of(row, f):
        return sum(b < row.get(f, 0.0) for b in bounds[f])

    members = {}
    for slot, tree, feature, right in ((0, 0, 0, False), (1, 0, 0, True), (2, 2, 2, False), (3, 2, 2, True)):
        members[slot] = tree, [k for k, r in enumerate(rows) if weight[k, tree] and (bin_of(r, feature) > 1) == right]
        np.add.at(total[slot], [labels[k] for k in members[slot][1]], weight[members[slot][1], tree])
    found = {r["slot"]: r for b in forest._best_splits((draw, node, total, bins, 5, 2), iter(cut)) for r in b.to_pylist()}
    for slot, (tree, inside) in members.items():
        chosen = draw.order[draw.start + forest._chosen(np.repeat(node[slot], len(draw.size)), draw.odd, draw.size)]
        assert len(set(chosen.tolist())) == 4
        gains = {}
        for f in chosen.tolist():
            for last in range(int(bins.count[f])):
                sides = [[0] * classes, [0] * classes]
                for k in inside:
                    sides[int(bin_of(rows[k], f) > last)][labels[k]] += int(weight[k, tree])
                n = [sum(s) for s in sides]
                if min(n) >= 2:
                    gains[f, last] = gini([a + b for a, b in zip(*sides)]) - sum(m * gini(s) for m, s in zip(n, sides)) / sum(n), sides[0]
        best = max(g for g, _ in gains.values())
        got = found[slot]
        assert gains[got["feature"], got["bin"]][0] == pytest.approx(best) and gains[got["feature"], got["bin"]][1] == got["left"]


def test_forest_learns_and_its_stored_model_votes_alike(spark, tmp_path):
    rng = random.Random(5)
    rows = []
    for _ in range(200):
        row = [rng.choice([0.0, 0.0, -1.0, 2.0, rng.random()]) for _ in range(9)]
        rows.append((2 if row[3] > 1 else int(row[5] < 0), dense_or_sparse(rng, row)))
    data = spark.createDataFrame(rows, ["label", "features"])
    model = fit_forest(data, trees=15, depth=9)
    assert len(model.nodes.feature) == len(model.nodes.left) and (model.nodes.feature[model.nodes.left < 0] == -1).all()
    model.write().save(str(tmp_path / "forest"))
    first, again = (m.transform(data).collect() for m in (model, ForestModel.load(str(tmp_path / "forest"))))
    assert first == again and len(first) == 200
    assert sum(r.prediction == r.label for r in first) > 190
    for r in first:
        total = walked(model.nodes, 15, dict(enumerate(r.features.toArray())))
        assert list(r.rawPrediction) == pytest.approx(list(total)) and list(r.probability) == pytest.approx(list(total / total.sum()))
        assert r.prediction == int(np.argmax(np.array(r.rawPrediction)))


def test_rows_are_not_widened_to_all_features(spark):
    """As dense rows these would be 8 MB each."""
    size, rng = 1 << 21, random.Random(6)
    rows = [(i % 2, SparseVector(size, sorted({i % 2, *(rng.randrange(2, size) for _ in range(5))}), [1.0] * 6)) for i in range(400)]
    data = spark.createDataFrame(rows, ["label", "features"])
    narrow = forest.sparse_parts("features")[0]
    assert data.select(narrow.alias("i")).first()["i"][0] == 0
    nodes = grow_forest(data, 2, 2, 42)
    assert nodes.share.shape[1] == 2 and nodes.share[:2].min() > 0.3


def test_depth_nought_least_rows_and_unfit_labels(spark):
    rows = [(i % 2, DenseVector([float(i), float(i % 2)])) for i in range(60)]
    data = spark.createDataFrame(rows, ["label", "features"])
    assert (grow_forest(data, 3, 0, 1).feature == -1).all()
    assert len(grow_forest(data, 3, 5, 1, least=40).feature) == 3
    for bad in (None, -1):
        with pytest.raises(ValueError, match="labels"):
            grow_forest(data.unionByName(spark.createDataFrame([(bad, DenseVector([0.0, 1.0]))], data.schema)), 2, 2, 1)
    with pytest.raises(ValueError, match="rows"):
        grow_forest(data.limit(0), 2, 2, 1)


def test_leaves_go_down_to_one_row_however_many_rows(spark, tmp_path):
    """As many rows as had leaves of two at least before."""
    numbers = array_to_vector(F.array(*(F.rand(n) for n in range(4)))).alias("features")
    spark.range(140_000).select((F.rand(9) < 0.5).cast("int").alias("label"), numbers).write.parquet(str(tmp_path / "rows"))
    data = spark.read.parquet(str(tmp_path / "rows"))
    fitted, whole = fit_forest(data, trees=1, depth=13).nodes, grow_forest(data, 1, 13, 42, least=1)
    assert all(np.array_equal(a, b) for a, b in zip(fitted, whole))
    assert len(grow_forest(data, 1, 13, 42, least=2).feature) < len(fitted.feature)


def test_counts_travel_as_ranges_of_nodes_and_not_as_rows():
    """Each count is there once, its node's range with it, and a range is split as its counts in order would be."""
    rng, slots, groups, size, classes = np.random.default_rng(7), 40, 6, 64, 2
    draw, node = draw_level(size, 3, 0), np.arange(slots).astype(np.uint32) * np.uint32(2654435761)
    parts, width = len(draw.size), 4
    code = rng.integers(0, parts * width * classes, 3000)
    batches = []
    for half in np.array_split(np.arange(3000), 3):
        slot = np.sort(rng.integers(0, slots, len(half)))
        batches.append(pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(code[half].astype(np.int32)), pa.array(rng.integers(1, 9, len(half)))], ["slot", "code", "n"]))
    sent = [b for batch in batches for b in forest._dealt(lambda given: given, slots, groups, iter([batch]))]
    assert all(len(b) <= groups for b in sent)
    bins = Bins(np.tile([1.0, 2.0, 3.0], (size, 1)), np.full(size, 3, np.int32), np.zeros(size, np.int32))
    context = (draw, node, np.full((slots, classes), 5000), bins, width, 1)
    got = [r for b in forest._best_of_groups(context, iter(sent)) for r in b.to_pylist()]
    want = [r for b in forest._best_splits(context, iter(pa.Table.from_batches(batches).sort_by("slot").combine_chunks().to_batches())) for r in b.to_pylist()]
    assert len(want) == slots and sorted(got, key=lambda r: r["slot"]) == want


def test_products_by_which_a_feature_is_chosen():
    for size in (1, 2, 13, 3000):
        draw, node = draw_level(size, 5, 2), np.random.default_rng(size).integers(0, 1 << 32, 300, dtype=np.uint32)
        odd, low, span = forest._spans(draw)
        chosen = forest._chosen(node[:, None], draw.odd[draw.part], draw.size[draw.part]) == draw.place
        assert np.array_equal(node[:, None] * odd - low <= span, chosen)
