"""Random forest on sparse rows, grown level by level.

A row is kept as its stored numbers, each by its feature's bin, and never as one number for every feature. For each level
the rows' tasks count the classes by (node, feature, bin) for the stored numbers alone, of the features that the node may
choose from; what a feature does not store falls into the bin of zero, as the node's total, known from its parent's split,
less the rest. Counts are brought together by node in one shuffle, nodes are split in its tasks, and only the splits reach
the driver.

Rules are those of Spark's classifier: a Poisson(1) weight for each row and tree, ceil(sqrt) of the features for each node,
32 bins by the values of some 10,000 rows, Gini, leaves with shares of the classes. A node draws its features one from each
of as many equal parts of a permutation of all; so a task knows them from the node's number.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import delete_path, scratch_path, write_and_read

# Tasks get these functions by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Those of Spark's classifier.
BINS = 32
BIN_ROWS = 10_000
# Rows worked on at a time in a task; levels after which the rows' nodes are written.
CHUNK = 2_000
STORED_EVERY = 4
MAX_FEATURES = 1 << 24
LEAST_GAIN = 1e-12
# Counts added up in a task before they are sent, and about as many as are brought together in a task and split at a time.
HELD = 1 << 20
BROUGHT = 1 << 21
ROWS = "row long, label int, idx array<int>, bins array<int>"
SPLITS = "slot int, feature int, bin int, left array<long>"


def sparse_parts(vector: str) -> tuple[Column, Column]:
    """(indices, values) of a vector column."""
    parts = F.unwrap_udt(vector)
    every = F.when(F.size(parts["values"]) > 0, F.sequence(F.lit(0), F.size(parts["values"]) - 1))
    return F.when(parts["type"] == 0, parts["indices"]).otherwise(every), parts["values"]


class Bins(NamedTuple):
    """Of each feature: the upper bounds of its bins but the last (padded by infinity), their number, and the bin of zero."""

    bounds: np.ndarray
    count: np.ndarray
    zero: np.ndarray


class Draw(NamedTuple):
    """A level's features in equal parts: a feature's part and place in it, each part's start, size and multiplier."""

    order: np.ndarray
    part: np.ndarray
    place: np.ndarray
    start: np.ndarray
    size: np.ndarray
    odd: np.ndarray


class Level(NamedTuple):
    """Of each node that is split or not: the feature (-1: a leaf) and the last bin that goes left, and its children (-1: a leaf)."""

    feature: np.ndarray
    bin: np.ndarray
    left: np.ndarray
    right: np.ndarray


class Nodes(NamedTuple):
    """Of each node, the roots first: feature (-1: a leaf), threshold, children, and the classes' shares."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray


def _mix(x: np.ndarray) -> np.ndarray:
    x = np.asarray(x).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashed(numbers: np.ndarray, seed: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return _mix(np.asarray(numbers).astype(np.uint64) + _mix(np.array([seed & (2**64 - 1)], dtype=np.uint64) + np.uint64(0x9E3779B97F4A7C15)))


def bag_weights(rows: np.ndarray, trees: int, seed: int) -> np.ndarray:
    """How often each tree has each row: Poisson(1), by the row's number."""
    below = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
    own = _hashed(rows, seed)
    u = (_mix(own[:, None] + np.arange(1, trees + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(11)) * 2.0**-53
    return np.searchsorted(below, u.ravel(), side="right").reshape(u.shape)


def draw_level(size: int, seed: int, level: int) -> Draw:
    rng = np.random.default_rng([seed & (2**64 - 1), level])
    parts = math.ceil(math.sqrt(size))
    order = rng.permutation(size).astype(np.int32)
    start = np.arange(parts + 1, dtype=np.int64) * size // parts
    sizes = np.diff(start)
    part, place = np.empty(size, np.int32), np.empty(size, np.uint32)
    part[order] = np.repeat(np.arange(parts), sizes)
    place[order] = np.arange(size) - np.repeat(start[:-1], sizes)
    odd = rng.integers(0, 1 << 31, parts, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    return Draw(order, part, place, start[:-1], sizes.astype(np.uint32), odd)


def _chosen(node: np.ndarray, odd: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The place in a part that a node (by its hash) draws."""
    return ((node * odd >> np.uint32(12)) * size) >> np.uint32(20)


def _bounds(values: list[float], counts: list[int], zeros: float, bins: int) -> list[float]:
    """Spark's candidates: halfway between all neighbouring values, or where the next stride of rows is nearest."""
    if zeros > 0.5:
        at = int(np.searchsorted(values, 0.0))
        values, counts = [*values[:at], 0.0, *values[at:]], [*counts[:at], zeros, *counts[at:]]
    halfway = [(a + b) / 2 for a, b in zip(values, values[1:])]
    if len(halfway) < bins:
        return halfway
    stride = sum(counts) / bins
    out, passed, target = [], counts[0], stride
    for k in range(1, len(values)):
        before, passed = passed, passed + counts[k]
        if abs(before - target) < abs(passed - target):
            out.append(halfway[k - 1])
            target += stride
    return out


def _fit_bins(rows: DataFrame, size: int, count: int, seed: int) -> Bins:
    share = min(1.0, max(BINS * BINS, BIN_ROWS) / count)
    used = rows if share == 1 else rows.sample(share, seed)
    bins = min(BINS, count)
    entries = used.select(F.explode(F.arrays_zip("idx", "values")).alias("e")).select("e.*").filter("values <> 0")
    distinct = entries.groupBy("idx", "values").agg(F.count(F.lit(1)).alias("n")).groupBy("idx")
    listed = distinct.agg(F.sort_array(F.collect_list(F.struct("values", "n"))).alias("found"))

    def bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for found in batch.column(1):
                values, counts = [e["values"].as_py() for e in found.values], [e["n"].as_py() for e in found.values]
                out.append(_bounds(values, counts, share * count - sum(counts), bins))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.float64()))], ["idx", "bounds"])

    fitted = listed.mapInArrow(bounds, "idx int, bounds array<double>").toArrow().combine_chunks()
    number = np.zeros(size, np.int64)
    idx, lists = fitted.column(0).to_numpy(), fitted.column(1).combine_chunks()
    if len(idx):
        number[idx] = lists.value_lengths().to_numpy()
    table = np.full((size, max(1, int(number.max()))), np.inf)
    if len(idx):
        lengths = lists.value_lengths().to_numpy()
        inside = np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        table[np.repeat(idx, lengths), inside] = lists.flatten().to_numpy()
    return Bins(table, number.astype(np.int32), (table < 0).sum(axis=1).astype(np.int32))


def _binned(bins: Bins, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, label, idx, values) with each value's bin in its place; indices ascend."""
    for batch in batches:
        for start in range(0, len(batch), CHUNK):
            piece = batch.slice(start, CHUNK)
            idx, values = piece.column("idx"), piece.column("values")
            features, numbers = idx.flatten().to_numpy(), values.flatten().to_numpy()
            found = np.empty(len(features), np.int32)
            for at in range(0, len(features), 1 << 16):
                part = slice(at, at + (1 << 16))
                found[part] = (bins.bounds[features[part]] < numbers[part][:, None]).sum(axis=1)
            ends = np.concatenate([[0], np.cumsum(idx.value_lengths().to_numpy())]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.astype(np.int32))) for x in (features, found)]
            yield pa.RecordBatch.from_arrays([piece.column("row"), piece.column("label"), *lists], ["row", "label", "idx", "bins"])


class _Chunk:
    """Some rows: their entries, and their node in each tree."""

    def __init__(self, piece: pa.RecordBatch, size: int, roots: np.ndarray, seed: int, zero: np.ndarray, levels: list[Level]):
        self.row, self.label = (piece.column(n).to_numpy() for n in ("row", "label"))
        self.lengths = piece.column("idx").value_lengths().to_numpy()
        self.idx, self.bins = (piece.column(n).flatten().to_numpy() for n in ("idx", "bins"))
        trees = len(roots)
        self.weight = bag_weights(self.row, trees, seed)
        if "at" in piece.schema.names:
            self.at = piece.column("at").flatten().to_numpy().reshape(-1, trees).copy()
        else:
            self.at = np.where(self.weight > 0, roots, np.int32(-1))
        keys = np.repeat(np.arange(len(self.row), dtype=np.int64), self.lengths) * size + self.idx
        for level in levels:
            which, tree = np.nonzero(self.at >= 0)
            slot = self.at[which, tree]
            feature = level.feature[slot]
            inner = feature >= 0
            slot_in, feature_in = slot[inner], feature[inner]
            found = zero[feature_in]
            if len(keys):
                wanted = which[inner] * size + feature_in
                at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                found = np.where(keys[at] == wanted, self.bins[at], found)
            to = np.full(len(slot), -1, np.int32)
            to[inner] = np.where(found <= level.bin[slot_in], level.left[slot_in], level.right[slot_in])
            self.at[which, tree] = to


def _chunks(batches, *context) -> Iterator[tuple[pa.RecordBatch, _Chunk]]:
    for batch in batches:
        for start in range(0, len(batch), CHUNK):
            piece = batch.slice(start, CHUNK)
            yield piece, _Chunk(piece, *context)


def _moved(context: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows with their nodes written down."""
    for piece, chunk in _chunks(batches, *context):
        rows, trees = chunk.at.shape
        at = pa.ListArray.from_arrays(pa.array(np.arange(rows + 1, dtype=np.int32) * trees), pa.array(chunk.at.ravel().astype(np.int32)))
        yield pa.RecordBatch.from_arrays([*(piece.column(n) for n in ("row", "label", "idx", "bins")), at], ["row", "label", "idx", "bins", "at"])


def _bagged(trees: int, seed: int, classes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(tree, label, n): the weights of all rows."""
    counts = np.zeros((classes, trees), np.int64)
    for batch in batches:
        for start in range(0, len(batch), CHUNK):
            row, label = (batch.column(k).slice(start, CHUNK).to_numpy() for k in range(2))
            np.add.at(counts, label, bag_weights(row, trees, seed))
    label, tree = np.nonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(label), pa.array(counts[label, tree])], ["tree", "label", "n"])


def _summed(keys: list[np.ndarray], weights: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, weight = np.concatenate(keys).astype(np.int64), np.concatenate(weights).astype(np.int64)
    if key.max(initial=0) < 1 << 57 and weight.max(initial=0) < 1 << 6:
        both = np.sort(key << 6 | weight)
        key, weight = both >> 6, both & 63
    else:
        order = np.argsort(key, kind="stable")
        key, weight = key[order], weight[order]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    return key[starts], np.add.reduceat(weight, starts) if len(starts) else weight


def _spans(draw: Draw) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each feature its part's multiplier and the least and the number (less one) of the products by which it is chosen."""
    size, place = draw.size[draw.part].astype(np.int64), draw.place.astype(np.int64)
    low, high = -(-(place << 20) // size), -(-(place + 1 << 20) // size)
    return draw.odd[draw.part], (low << 12).astype(np.uint32), ((high - low << 12) - 1).astype(np.uint32)


def _counted(context: tuple, draw: Draw, node: np.ndarray, width: int, classes: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(slot, code, n): weights by node, and by part, bin and class as one number; added up as far as ``HELD`` allows."""
    each = len(draw.size) * width * classes

    def sent(key: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array((key // each).astype(np.int32)), pa.array((key % each).astype(np.int32)), pa.array(n)], ["slot", "code", "n"])

    keys, weights, held = [np.empty(0, np.int64)], [np.empty(0, np.int64)], 0
    spans, product, chosen = _spans(draw), np.empty(0, np.uint32), np.empty(0, bool)
    for _, chunk in _chunks(batches, *context):
        odd, low, span = (by[chunk.idx] for by in spans)
        code = (draw.part[chunk.idx].astype(np.int64) * width + chunk.bins) * classes + np.repeat(chunk.label, chunk.lengths)
        ends = np.cumsum(chunk.lengths)
        # all stored numbers of a row meet all its nodes: these few thousand tests stay in the cache
        for row, (start, end) in enumerate(zip(ends - chunk.lengths, ends)):
            trees = np.flatnonzero(chunk.at[row] >= 0)
            if start == end or not len(trees):
                continue
            slot, count = chunk.at[row, trees], len(trees) * (end - start)
            if count > len(product):
                product, chosen = np.empty(2 * count, np.uint32), np.zeros(2 * count + 8 & -8, bool)
            tests, passed = (x[:count].reshape(len(trees), -1) for x in (product, chosen))
            np.multiply(node[slot][:, None], odd[start:end], out=tests)
            np.subtract(tests, low[start:end], out=tests)
            np.less_equal(tests, span[start:end], out=passed)
            # few pass, so eight at a time are looked at first
            chosen[count : count + 8] = False
            eight = np.flatnonzero(chosen[: count + 7 & -8].view(np.uint64))
            at, place = np.nonzero(chosen.reshape(-1, 8)[eight])
            hit = eight[at] * 8 + place
            by = hit // (end - start)
            keys.append(slot[by] * np.int64(each) + code[start + hit - by * (end - start)])
            weights.append(chunk.weight[row, trees[by]])
            held += len(hit)
        if held > HELD:
            key, n = _summed(keys, weights)
            keys, weights, held = [key], [n], len(key)
            if held > HELD // 2:
                yield sent(key, n)
                keys, weights, held = [key[:0]], [n[:0]], 0
    yield sent(*_summed(keys, weights))


def _gini(counts: np.ndarray, total: np.ndarray) -> np.ndarray:
    return 1 - ((counts / np.maximum(total, 1)[..., None]) ** 2).sum(axis=-1)


def _split(slot, code, n, draw: Draw, node: np.ndarray, total: np.ndarray, bins: Bins, width: int, least: int) -> pa.RecordBatch:
    """The best splits of some nodes, where there are any, given all their counts; a count may come in portions.

    Only bins that hold anything are looked at: behind an empty one a split is the one before it.
    """
    parts, classes = len(draw.size), total.shape[1]
    key, n = _summed([slot.astype(np.int64) * (parts * width * classes) + code], [n])
    cell = key // classes
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    stored = np.zeros((len(first), classes))
    stored[np.cumsum(np.diff(cell, prepend=-1) != 0) - 1, key % classes] = n
    cell = cell[first]
    pair = cell // width
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    of, pairs = np.cumsum(np.diff(pair, prepend=-1) != 0) - 1, pair[first]
    by, p = pairs // parts, pairs % parts
    asked, whole = draw.order[draw.start[p] + _chosen(node[by], draw.odd[p], draw.size[p])], total[by]
    # what isn't stored is in the bin of zero
    cell = np.concatenate([of * width + cell % width, np.arange(len(pairs)) * width + bins.zero[asked]])
    counts = np.concatenate([stored, whole - np.add.reduceat(stored, first, axis=0)])
    order = np.argsort(cell, kind="stable")
    cell, counts = cell[order], counts[order]
    first = np.flatnonzero(np.diff(cell, prepend=-1))
    counts, of, at = np.add.reduceat(counts, first, axis=0), cell[first] // width, cell[first] % width
    lower = counts.cumsum(axis=0)
    start = np.flatnonzero(np.diff(of, prepend=-1))
    lower -= (lower[start] - counts[start])[of]
    upper = whole[of] - lower
    below, above, every = lower.sum(axis=1), upper.sum(axis=1), whole.sum(axis=1)
    gain = _gini(whole, every)[of] - (below * _gini(lower, below) + above * _gini(upper, above)) / every[of]
    gain[(below < least) | (above < least) | (at >= np.minimum(bins.count[asked], width - 1)[of])] = -1.0
    # cells are in order of nodes, parts and bins: of equal gains the first
    owner = by[of]
    start = np.flatnonzero(np.diff(owner, prepend=-1))
    best = np.maximum.reduceat(gain, start)
    equal = np.flatnonzero(gain == best[np.cumsum(np.diff(owner, prepend=-1) != 0) - 1])
    first = equal[np.diff(owner[equal], prepend=-1) != 0]
    first = first[gain[first] > LEAST_GAIN]
    left = pa.ListArray.from_arrays(pa.array(np.arange(len(first) + 1, dtype=np.int32) * classes), pa.array(lower[first].astype(np.int64).ravel()))
    columns = [pa.array(x.astype(np.int32)) for x in (owner[first], asked[of[first]], at[first])]
    return pa.RecordBatch.from_arrays([*columns, left], ["slot", "feature", "bin", "left"])


def _best_splits(context: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches in order of nodes; the last node of one may go on in the next."""
    kept: list[list[np.ndarray]] = []
    for batch in batches:
        if not len(batch):
            continue
        arrays = [batch.column(k).to_numpy() for k in range(3)]
        cut = int(np.searchsorted(arrays[0], arrays[0][-1]))
        if cut or (kept and kept[-1][0][-1] != arrays[0][0]):
            yield _split(*(np.concatenate(column) for column in zip(*kept, [a[:cut] for a in arrays])), *context)
            kept = []
        kept.append([a[cut:] for a in arrays])
    if kept:
        yield _split(*(np.concatenate(column) for column in zip(*kept)), *context)


def _dealt(count, slots: int, groups: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(group, counts): the counts of ranges of nodes, each as one value and not as a row for every count."""
    for counted in count(batches):
        slot, code, n = (counted.column(k).to_numpy().astype(np.int32) for k in range(3))
        group = slot.astype(np.int64) * groups // slots
        starts = np.flatnonzero(np.diff(group, prepend=-1))
        packed = [np.stack([slot[a:b], code[a:b], n[a:b]]).tobytes() for a, b in zip(starts, [*starts[1:], len(slot)])]
        yield pa.RecordBatch.from_arrays([pa.array(group[starts].astype(np.int32)), pa.array(packed, pa.binary())], ["group", "counts"])


def _best_of_groups(context: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    brought: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for group, packed in zip(batch.column(0).to_pylist(), batch.column(1)):
            brought.setdefault(group, []).append(np.frombuffer(packed.as_buffer(), np.int32).reshape(3, -1))
    while brought:
        slot, code, n = np.concatenate(brought.popitem()[1], axis=1)
        order = np.argsort(slot, kind="stable")
        pieces = [order[a : a + HELD] for a in range(0, len(order), HELD)]
        ordered = ([pa.array(x[piece]) for x in (slot, code, n)] for piece in pieces)
        yield from _best_splits(context, (pa.RecordBatch.from_arrays(columns, ["slot", "code", "n"]) for columns in ordered))


def grow_forest(features: DataFrame, trees: int, depth: int, seed: int, label_col: str = "label", least: int = 1) -> Nodes:
    """The nodes of ``trees`` trees over (label, features); nodes keep ``least`` rows at least."""
    spark = features.sparkSession
    label, (indices, values) = F.col(label_col), sparse_parts("features")
    unfit = label.isNull() | (label < 0) | (label != label.cast("int"))
    rows = features.select(label.cast("int").alias("label"), indices.alias("idx"), values.alias("values"))
    seen = features.agg(
        F.count(F.lit(1)).alias("n"), F.max(label.cast("int")).alias("last"), F.count(F.when(unfit, 1)).alias("unfit"),
        F.max(F.coalesce(F.unwrap_udt("features")["size"], F.size(values))).alias("size"), F.sum(F.size(values).cast("long")).alias("stored"),
    ).first()
    if seen["unfit"] or not seen["n"] or not 0 < (seen["size"] or 0) <= MAX_FEATURES:
        raise ValueError(f"needs rows with features and labels from 0: {seen['n']} rows, {seen['unfit']} without such a label, {seen['size']} features")
    size, classes = seen["size"], seen["last"] + 1
    bins = _fit_bins(rows, size, seen["n"], seed)
    width = bins.bounds.shape[1] + 1
    cores, shuffles = spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))
    if rows.rdd.getNumPartitions() < cores:
        rows = rows.repartition(cores)
    numbered = rows.withColumn("row", F.monotonically_increasing_id()).select("row", "label", "idx", "values")
    path = scratch_path(spark, "forest")
    data = write_and_read(numbered.mapInArrow(partial(_binned, bins), ROWS), path)

    bagged = data.select("row", "label").mapInArrow(partial(_bagged, trees, seed, classes), "tree long, label long, n long")
    counts = np.zeros((trees, classes), np.int64)
    for tree, of, n in bagged.groupBy("tree", "label").agg(F.sum("n")).collect():
        counts[tree, of] = n

    def slots(counts: np.ndarray, level: int) -> np.ndarray:
        """The numbers of the nodes that are to be split if they can, -1 for the others."""
        held = counts.sum(axis=1)
        going = (counts.max(axis=1) < held) & (held >= 2 * least) & (level < depth)
        return np.where(going, np.cumsum(going) - 1, -1).astype(np.int32)

    # nodes are numbered level by level
    grown: list[Nodes] = []
    nodes, known = np.arange(trees), trees
    slot_of = roots = slots(counts, 0)
    pending: list[Level] = []
    for level in range(depth + 1):
        asked = np.flatnonzero(slot_of >= 0)
        feature, last = np.full(len(asked), -1, np.int32), np.zeros(len(asked), np.int32)
        lower = np.zeros((len(asked), classes), np.int64)
        if len(asked):
            if len(pending) == STORED_EVERY:
                moved = scratch_path(spark, "forest")
                steps = partial(_moved, (size, roots, seed, bins.zero, pending))
                data = write_and_read(data.mapInArrow(steps, f"{ROWS}, at array<int>"), moved)
                delete_path(spark, path)
                path, pending = moved, []
            draw, own = draw_level(size, seed, level), (_hashed(nodes[asked], seed + 1) >> np.uint64(32)).astype(np.uint32)
            count = partial(_counted, (size, roots, seed, bins.zero, list(pending)), draw, own, width, classes)
            split = partial(_best_of_groups, (draw, own, counts[asked], bins, width, least))
            # a row's numbers are chosen by one node in as many as there are parts
            groups = max(cores, math.ceil(int(counts[asked].sum()) * (seen["stored"] or 0) / seen["n"] / len(draw.size) / BROUGHT))
            by_group = data.mapInArrow(partial(_dealt, count, len(asked), groups), "group int, counts binary")
            by_group = by_group.repartition(*[groups][: groups > shuffles], "group")
            found = by_group.mapInArrow(split, SPLITS).toArrow().combine_chunks()
            if len(found):
                at = found.column("slot").to_numpy()
                feature[at], last[at] = found.column("feature").to_numpy(), found.column("bin").to_numpy()
                lower[at] = found.column("left").combine_chunks().flatten().to_numpy().reshape(-1, classes)
        inner = np.flatnonzero(feature >= 0)
        children = known + np.arange(2 * len(inner))
        full = {name: np.full(len(nodes), -1, np.int32) for name in ("feature", "left", "right")}
        threshold = np.zeros(len(nodes))
        full["feature"][asked[inner]], threshold[asked[inner]] = feature[inner], bins.bounds[feature[inner], last[inner]]
        full["left"][asked[inner]], full["right"][asked[inner]] = children[0::2], children[1::2]
        grown.append(Nodes(full["feature"], threshold, full["left"], full["right"], counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)))
        if not len(inner):
            break
        below = np.empty((2 * len(inner), classes), np.int64)
        below[0::2], below[1::2] = lower[inner], counts[asked[inner]] - lower[inner]
        slot_of = slots(below, level + 1)
        to = [np.full(len(asked), -1, np.int32) for _ in range(2)]
        to[0][inner], to[1][inner] = slot_of[0::2], slot_of[1::2]
        pending.append(Level(feature, last, *to))
        nodes, known, counts = children, known + len(children), below
    delete_path(spark, path)
    return Nodes(*(np.concatenate(column) for column in zip(*grown)))


def _votes(nodes: Nodes, trees: int, idx: pa.ListArray, values: pa.ListArray) -> pa.Array:
    """The classes' shares, added up over the trees, of each row."""
    out = np.zeros((len(idx), nodes.share.shape[1]))
    for start in range(0, len(idx), CHUNK):
        some = idx.slice(start, CHUNK)
        features, numbers = some.flatten().to_numpy().astype(np.int64), values.slice(start, CHUNK).flatten().to_numpy()
        size = max(int(features.max(initial=0)), int(nodes.feature.max(initial=0))) + 1
        keys = np.repeat(np.arange(len(some), dtype=np.int64), some.value_lengths().to_numpy()) * size + features
        at = np.tile(np.arange(trees), len(some))
        row = np.repeat(np.arange(len(some), dtype=np.int64), trees)
        going = np.flatnonzero(nodes.feature[at] >= 0)
        while len(going):
            node = at[going]
            wanted = row[going] * size + nodes.feature[node]
            number = np.zeros(len(going))
            if len(keys):
                place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
                number = np.where(keys[place] == wanted, numbers[place], 0.0)
            node = np.where(number <= nodes.threshold[node], nodes.left[node], nodes.right[node])
            at[going] = node
            going = going[nodes.feature[node] >= 0]
        out[start : start + len(some)] = nodes.share[at].reshape(len(some), trees, -1).sum(axis=1)
    ends = pa.array(np.arange(len(idx) + 1, dtype=np.int32) * out.shape[1])
    return pa.ListArray.from_arrays(ends, pa.array(out.ravel()))


class ForestModel(Model, HasFeaturesCol, HasPredictionCol, HasProbabilityCol, HasRawPredictionCol, MLWritable, MLReadable):
    """Adds votes, probabilities and the class with most votes (the first of equals), as Spark's own model does."""

    trees = Param(Params._dummy(), "trees", "number of trees", TypeConverters.toInt)

    def __init__(self, nodes: Nodes | None = None, trees: int | None = None):
        super().__init__()
        self.nodes = nodes
        if trees is not None:
            self._set(trees=trees)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        nodes, trees = self.nodes, self.getOrDefault(self.trees)

        @F.arrow_udf("array<double>")
        def votes(idx: pa.Array, values: pa.Array) -> pa.Array:
            return _votes(nodes, trees, idx, values)

        raw, whole = F.col("_votes"), F.aggregate("_votes", F.lit(0.0), lambda a, x: a + x)
        share = F.transform(raw, lambda x: F.when(whole > 0, x / whole).otherwise(0.0))
        first = (F.array_position(raw, F.array_max(raw)) - 1).cast("double")
        voted = dataset.withColumn("_votes", votes(*sparse_parts(self.getFeaturesCol())))
        return voted.withColumns(
            {self.getRawPredictionCol(): array_to_vector(raw), self.getProbabilityCol(): array_to_vector(share), self.getPredictionCol(): first}
        ).drop("_votes")

    def write(self) -> MLWriter:
        return _ForestWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _ForestReader(cls)


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        nodes = self.model.nodes
        ends = pa.array(np.arange(len(nodes.share) + 1, dtype=np.int32) * nodes.share.shape[1])
        share = pa.ListArray.from_arrays(ends, pa.array(nodes.share.ravel()))
        columns = {"node": np.arange(len(nodes.feature)), **dict(zip(Nodes._fields[:-1], nodes)), "share": share}
        self.sparkSession.createDataFrame(pa.table(columns)).write.parquet(f"{path}/nodes")


class _ForestReader(MLReader):
    def __init__(self, cls: type[ForestModel]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ForestModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        read = self.sparkSession.read.parquet(f"{path}/nodes").orderBy("node").toArrow().combine_chunks()
        share = read.column("share").combine_chunks()
        plain = [read.column(name).to_numpy() for name in Nodes._fields[:-1]]
        model = self.cls(Nodes(*plain, share.flatten().to_numpy().reshape(len(share), -1)))
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
