"""Gradient-boosted regression trees: Spark's GBTRegressor with its passes over the rows done on arrays of bins.

Trees, splits, leaf values, weights and importances are those of Spark's algorithm for squared error: bins from the same
quantiles of a sample of max(maxBins², 10,000) rows, levels grown by variance gain, categories ordered by their mean, the
first tree on the target and each further one on twice the residual, weighted by the step. A fit gives Spark's own model
class, so scoring, saving and loading are Spark's. Only the variance of a node is not kept (its count and sum are).

A row is a byte per feature (two beyond 256 bins) in blocks of BLOCK_ROWS. A level counts the rows and adds up the residuals of each
bin of the smaller child of every split; its sibling is the parent less it. Up to LOCAL_ROWS rows are trained in one task, so that many fits run side
by side; more stay in their partitions, a level is one job, and the sums of its counted nodes come to the driver.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel, cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_ROWS = 1 << 16
#: Most rows that one task trains on alone.
LOCAL_ROWS = 1_000_000
#: Sums that are added up in one place at most, about.
SUM_BYTES = 64 << 20
#: Gains are equal if they differ by rounding only; the first feature and bin count, whatever the order of the rows.
TIE = 1 - 1e-10


class Settings(NamedTuple):
    trees: int
    depth: int
    step: float
    rate: float
    least: int
    gain: float
    seed: int


class Bins(NamedTuple):
    """Upper ends of the bins of each number, None for a category, and the number of bins of each feature."""

    cuts: list[np.ndarray | None]
    sizes: list[int]

    @property
    def kind(self) -> str:
        return next(t for t in ("uint8", "uint16", "uint32") if max(self.sizes) - 1 <= np.iinfo(t).max)

    def twice(self) -> Bins:
        return Bins(self.cuts * 2, self.sizes * 2)


class Tree:
    """Nodes in heap order; a node without feature is a leaf."""

    def __init__(self, depth: int, width: int):
        n = 2 ** (depth + 1) - 1
        self.feature, self.left = np.full(n, -1), np.zeros((2 ** depth - 1, width), dtype=bool)
        self.count, self.sum, self.gain = np.zeros(n), np.zeros(n), np.zeros(n)

    def value(self) -> np.ndarray:
        return self.sum / np.maximum(self.count, 1)

    def moved(self, bins: np.ndarray, node: np.ndarray) -> np.ndarray:
        """The nodes of the rows, one level further down where theirs is split."""
        f = self.feature[node]
        at = np.maximum(f, 0) * bins.shape[1]
        at += np.arange(bins.shape[1])
        inner = np.minimum(node, len(self.left) - 1)
        goes = self.left.ravel().take(inner * self.left.shape[1] + bins.ravel().take(at))
        return np.where(f >= 0, 2 * node + 2 - goes, node)


# -- bins --------------------------------------------------------------------

def cuts_of(values: np.ndarray, counts: np.ndarray, bins: int) -> np.ndarray:
    """Ends between bins of about equally many of the sampled values; between all values if they are few."""
    middle = (values[1:] + values[:-1]) / 2
    if len(middle) <= bins - 1:
        return middle
    stride, out = counts.sum() / bins, []
    below, goal = np.cumsum(counts), counts.sum() / bins
    for i in range(1, len(values)):
        if abs(below[i - 1] - goal) < abs(below[i] - goal):
            out.append(middle[i - 1])
            goal += stride
    return np.array(out)


def to_bins(x: np.ndarray, bins: Bins) -> np.ndarray:
    """Bins of a matrix of rows, a line per feature."""
    out = np.empty((x.shape[1], len(x)), dtype=bins.kind)
    for f, cuts in enumerate(bins.cuts):
        out[f] = x[:, f] if cuts is None else np.searchsorted(cuts, x[:, f])
    return out


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow column of equally long lists of doubles."""
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1)


def find_bins(df: DataFrame, vector: str, arity: dict[int, int], most: int, rows: int, seed: int) -> Bins:
    """Bins of the vectors of df; values of a sample meet by feature, only the ends of the bins come to the driver."""
    share = max(most * most, 10_000) / max(rows, 1)
    known = df if share >= 1 else df.sample(False, share, seed)
    most = min(most, rows)

    def values(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> Iterator[pa.RecordBatch]:
            x = np.concatenate(held)
            for f in range(x.shape[1]):
                v, n = np.unique(x[:, f], return_counts=True) if f not in arity else (np.zeros(1), np.ones(1, int))
                yield pa.RecordBatch.from_pydict({"f": pa.array([f], pa.int32()), "v": [v.tobytes()], "n": [n.astype("int64").tobytes()]})

        for batch in batches:
            if batch.num_rows:
                held.append(matrix(batch.column(0)))
            if sum(map(len, held)) >= BLOCK_ROWS:
                yield from counted()
                held = []
        if held:
            yield from counted()

    def cut(item: tuple[int, Iterable]) -> tuple[int, np.ndarray | None]:
        f, parts = item
        if f in arity:
            return f, None
        pairs = list(parts)
        v, place = np.unique(np.concatenate([np.frombuffer(v) for v, _ in pairs]), return_inverse=True)
        n = np.bincount(place, weights=np.concatenate([np.frombuffer(n, dtype="int64") for _, n in pairs]))
        return f, cuts_of(v, n, most)

    seen = known.select(vector_to_array(vector).alias("x")).mapInArrow(values, "f int, v binary, n binary")
    cuts = dict(seen.rdd.map(lambda r: (r[0], (bytes(r[1]), bytes(r[2])))).groupByKey().map(cut).collect())
    ends = [cuts[f] for f in range(len(cuts))]
    return Bins(ends, [arity[f] if c is None else len(c) + 1 for f, c in enumerate(ends)])


def with_bins(df: DataFrame, vector: str, bins: Bins, out: str = "bins") -> DataFrame:
    """The rows with the bins of their vector as bytes in place of it."""
    kept = [c for c in df.columns if c != vector]
    schema = df.select(*kept, F.lit(b"").alias(out)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lines = np.ascontiguousarray(to_bins(matrix(batch.column(len(kept))), bins).T)
                size = lines.shape[1] * lines.itemsize
                ends = pa.py_buffer(np.arange(0, (len(lines) + 1) * size, size, dtype="int32"))
                made = pa.Array.from_buffers(pa.binary(), len(lines), [None, ends, pa.py_buffer(lines)])
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(kept)], made], names=[*kept, out])

    return df.select(*kept, vector_to_array(vector).alias(vector)).mapInArrow(run, schema)


# -- one level ---------------------------------------------------------------

def level_sums(bins: np.ndarray, residual: np.ndarray, slot: np.ndarray, slots: int, width: int) -> np.ndarray:
    """Rows and sums of residuals (feature, slot, bin, 2) of the rows whose slot is not negative."""
    out = np.empty((len(bins), slots * width, 2))
    at = np.flatnonzero(slot >= 0)
    whole = len(at) == len(slot)
    base, own = (slot, residual) if whole else (slot[at], residual[at])
    base = base * width
    for f, line in enumerate(bins):
        place = base + (line if whole else line[at])
        out[f, :, 0] = np.bincount(place, minlength=slots * width)
        out[f, :, 1] = np.bincount(place, weights=own, minlength=slots * width)
    return out.reshape(len(bins), slots, width, 2)


def best_splits(sums: np.ndarray, category: bool, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Best split of each node by one feature: gain (0 for none), bins that go left, their rows and sum."""
    count, total = sums[..., 0], sums[..., 1]
    n = np.maximum(count.sum(axis=1, keepdims=True), 1)
    mean = total.sum(axis=1, keepdims=True) / n
    order = np.broadcast_to(np.arange(count.shape[1]), count.shape)
    if category:
        order = np.argsort(np.where(count > 0, total / np.maximum(count, 1), np.inf), axis=1, kind="stable")
    left = np.cumsum(np.take_along_axis(count, order, 1), axis=1)[:, :-1]
    sums_left = np.cumsum(np.take_along_axis(total, order, 1), axis=1)[:, :-1]
    right, off = n - left, sums_left - left * mean
    ok = (left >= max(least, 1)) & (right >= max(least, 1))
    gain = np.where(ok, off * off * (1 / np.maximum(left, 1) + 1 / np.maximum(right, 1)) / n, 0)
    gain[gain <= 1e-18 * mean * mean] = 0  # equal residuals, but for rounding
    if not gain.shape[1]:
        none = np.zeros(len(count))
        return none, np.zeros(count.shape, dtype=bool), none, none
    at = (gain >= gain.max(axis=1, keepdims=True) * TIE).argmax(axis=1)
    place = np.empty(order.shape, dtype=int)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(order.shape[1]), order.shape), 1)
    each = np.arange(len(at))
    return gain[each, at], place <= at[:, None], left[each, at], sums_left[each, at]


def siblings(small: np.ndarray, parents: np.ndarray | None, take: list[tuple[int, bool]]) -> np.ndarray:
    """Sums of all nodes of a level (slot, bin, 2): those counted, and beside each its parent's less them. `take` has the slot of
    the parent, and whether the left child was counted."""
    if parents is None:
        return small
    rest = parents[[p for p, _ in take]] - small
    rest[..., 1][rest[..., 0] == 0] = 0
    first = np.array([a for _, a in take])[:, None, None]
    return np.stack([np.where(first, small, rest), np.where(first, rest, small)], axis=1).reshape(-1, *small.shape[1:])


class Level:
    """What a level of a tree measures, and what its best splits make of the tree."""

    def __init__(self, tree: Tree, settings: Settings, scale: float):
        self.tree, self.settings, self.scale = tree, settings, scale
        self.nodes, self.counted, self.take = [0], [0], []

    def slots(self) -> np.ndarray:
        """The slot of each node of the tree that is counted, -1 for the others."""
        out = np.full(len(self.tree.feature), -1)
        out[self.counted] = np.arange(len(self.counted))
        return out

    def grow(self, found: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], deepest: bool) -> bool:
        """Split the nodes by the best of all features; false if none is."""
        tree, gains = self.tree, np.array([g for g, *_ in found])
        nodes, counted, take = [], [], []
        for slot, node in enumerate(self.nodes):
            f = int((gains[:, slot] >= gains[:, slot].max() * TIE).argmax())
            gain = gains[f, slot] * self.scale * self.scale
            if gain <= 0 or gain < self.settings.gain:
                continue
            _, left, count, total = (x[slot] for x in found[f])
            tree.feature[node], tree.gain[node] = f, gain
            tree.left[node, : len(left)] = left
            a, b = 2 * node + 1, 2 * node + 2
            tree.count[a], tree.sum[a] = count, total * self.scale
            tree.count[b], tree.sum[b] = tree.count[node] - count, tree.sum[node] - total * self.scale
            nodes += [a, b]
            take.append((slot, count <= tree.count[b]))
            counted.append(a if take[-1][1] else b)
        self.nodes, self.counted, self.take = nodes, counted, take
        return bool(nodes) and not deepest


def sampled(settings: Settings, tree: int, block: object, rows: int) -> np.ndarray | None:
    """Rows of a block that a tree is grown on; None for all."""
    if settings.rate >= 1:
        return None
    return np.random.default_rng([settings.seed & 0x7FFFFFFF, tree, *block]).random(rows) < settings.rate


def _slots(slot: np.ndarray, node: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
    return slot[node] if mask is None else np.where(mask, slot[node], -1)


# -- trees -------------------------------------------------------------------

def grow_tree(tree: Tree, scale: float, kinds: Bins, settings: Settings, measure: Callable[[np.ndarray, int, int], list[np.ndarray]]) -> None:
    """Grow a tree level by level. `measure` (slot of each node or -1, slots, depth) gives the sums (slot, bin, 2) of each feature."""
    level = Level(tree, settings, scale)
    parents = None
    for depth in range(settings.depth):
        small = measure(level.slots(), len(level.counted), depth)
        every = [siblings(s, None if parents is None else parents[f], level.take) for f, s in enumerate(small)]
        if not depth:
            tree.count[0], tree.sum[0] = every[0][0].sum(axis=0) * (1, scale)
        parents = every
        if not level.grow([best_splits(s, kinds.cuts[f] is None, settings.least) for f, s in enumerate(every)], depth + 1 == settings.depth):
            return


def grow_here(bins: np.ndarray, y: np.ndarray, kinds: Bins, settings: Settings) -> list[Tree]:
    """Trees of the rows of one task."""
    width = max(kinds.sizes)
    cut = range(0, len(y), BLOCK_ROWS)
    blocks = [np.ascontiguousarray(bins[:, a:a + BLOCK_ROWS]) for a in cut]
    residual = [y[a:a + BLOCK_ROWS].copy() for a in cut]
    trees = []
    for t in range(settings.trees):
        tree = Tree(settings.depth, width)
        mask = [sampled(settings, t, (0, i), len(r)) for i, r in enumerate(residual)]
        node = [np.zeros(len(r), dtype=np.int64) for r in residual]

        def measure(slot: np.ndarray, slots: int, depth: int) -> list[np.ndarray]:
            if depth:
                node[:] = [tree.moved(b, n) for b, n in zip(blocks, node)]
            total = sum(level_sums(b, r, _slots(slot, n, m), slots, width) for b, r, n, m in zip(blocks, residual, node, mask))
            return [total[f, :, :size] for f, size in enumerate(kinds.sizes)]

        grow_tree(tree, 2.0 if t else 1.0, kinds, settings, measure)
        weight = (settings.step if t else 1.0) * tree.value()
        for b, r, n in zip(blocks, residual, node):
            r -= weight[tree.moved(b, n)] if tree.feature[0] >= 0 else weight[0]
        trees.append(tree)
    return trees


def grow_apart(blocks: RDD, kinds: Bins, settings: Settings) -> list[Tree]:
    """The same of blocks (number, bins, target) that stay in their partitions. The sums of a level come to the driver: a pair of numbers for
    each bin of each feature and counted node, from every task up to SUM_BYTES, else added up before by groups of features."""
    width, features = max(kinds.sizes), len(kinds.sizes)
    keep = StorageLevel.MEMORY_AND_DISK
    held, before, trees, tasks = blocks.persist(keep), None, [], blocks.getNumPartitions()

    def placed(tree: Tree, bins: np.ndarray, depth: int) -> np.ndarray:
        node = np.zeros(bins.shape[1], dtype=np.int64)
        for _ in range(depth):
            node = tree.moved(bins, node)
        return node

    for t in range(settings.trees):
        tree = Tree(settings.depth, width)

        def measure(slot: np.ndarray, slots: int, depth: int) -> list[np.ndarray]:
            nonlocal before
            groups = min(features, 1 + 16 * tasks * slots * sum(kinds.sizes) // SUM_BYTES)

            def count(part: int, own: Iterator) -> Iterator[tuple[int, tuple]]:
                total = 0
                for number, bins, residual in own:
                    mask = sampled(settings, t, number, len(residual))
                    total = total + level_sums(bins, residual, _slots(slot, placed(tree, bins, depth), mask), slots, width)
                if not np.isscalar(total):
                    for g in range(groups):
                        yield g, (part, [total[f, :, : kinds.sizes[f]].copy() for f in range(g, features, groups)])

            def meet(item: tuple[int, Iterable]) -> tuple[int, list[np.ndarray]]:
                parts = sorted(item[1], key=lambda x: x[0])  # sums in the same order in every run
                return item[0], [sum(x) for x in zip(*[own for _, own in parts])]

            sums = held.mapPartitionsWithIndex(count)
            found = dict([meet((0, [own for _, own in sums.collect()]))] if groups == 1 else sums.groupByKey(groups).map(meet).collect())
            if before is not None:
                before.unpersist()
                before = None
            return [found[f % groups][f // groups] for f in range(features)]

        grow_tree(tree, 2.0 if t else 1.0, kinds, settings, measure)
        trees.append(tree)
        if t + 1 < settings.trees:
            weight = (settings.step if t else 1.0) * tree.value()

            def less(block: tuple, tree: Tree = tree, weight: np.ndarray = weight) -> tuple:
                number, bins, residual = block
                return number, bins, residual - weight[placed(tree, bins, settings.depth)]

            before, held = held, held.map(less).persist(keep)
    held.unpersist()
    return trees


# -- from and to Spark -------------------------------------------------------

def _batches(batches: Iterator[pa.RecordBatch], kinds: Bins) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Target and bins of each batch of rows (target, bytes of bins, more bytes of bins)."""
    for batch in batches:
        if batch.num_rows:
            lines = []
            for column in batch.columns[1:]:
                size = np.frombuffer(column.buffers()[1], dtype="int32")[column.offset: column.offset + len(column) + 1]
                data = np.frombuffer(column.buffers()[2], dtype="uint8")[size[0]: size[-1]]
                lines.append(data.view(kinds.kind).reshape(len(column), -1).T)
            yield batch.column(0).to_numpy(zero_copy_only=False), np.concatenate(lines)


def grown(df: DataFrame, target: str, columns: list[str], kinds: Bins, settings: Settings, rows: int) -> list[Tree]:
    """Trees of about `rows` rows of df; `columns` hold bytes of bins, those of one row one after another."""
    data = df.select(F.col(target).cast("double").alias("y"), *columns)
    if rows <= LOCAL_ROWS:
        def here(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            parts = list(_batches(batches, kinds))
            if parts:
                y, bins = np.concatenate([y for y, _ in parts]), np.concatenate([b for _, b in parts], axis=1)
                del parts
                yield pa.RecordBatch.from_pydict({"trees": [pickle.dumps([vars(t) for t in grow_here(bins, y, kinds, settings)])]})

        made = data.coalesce(1).mapInArrow(here, "trees binary").collect()
        if not made:
            raise ValueError("no rows to train on")
        trees = []
        for held in pickle.loads(bytes(made[0][0])):
            trees.append(Tree(0, 1))
            vars(trees[-1]).update(held)
        return trees

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ys, bs = [], []
        for y, bins in _batches(batches, kinds):
            ys.append(y)
            bs.append(bins)
            if sum(map(len, ys)) >= BLOCK_ROWS:
                yield _block(ys, bs)
                ys, bs = [], []
        if ys:
            yield _block(ys, bs)

    def opened(part: int, own: Iterator) -> Iterator[tuple]:
        for i, r in enumerate(own):
            y = np.frombuffer(bytes(r[0]))
            yield (part, i), np.frombuffer(bytes(r[1]), dtype=kinds.kind).reshape(-1, len(y)), y

    blocks = data.mapInArrow(packed, "y binary, bins binary").rdd.mapPartitionsWithIndex(opened)
    return grow_apart(blocks, kinds, settings)


def _block(ys: list[np.ndarray], bs: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"y": [np.concatenate(ys).tobytes()], "bins": [np.ascontiguousarray(np.concatenate(bs, axis=1)).tobytes()]})


def importances(trees: list[Tree], features: int) -> np.ndarray:
    """Gain of each feature over all trees, weighted by rows; adds up to 1."""
    out = np.zeros(features)
    for t in trees:
        inner = t.feature >= 0
        np.add.at(out, t.feature[inner], (t.gain * t.count)[inner])
    return out / out.sum() if out.sum() > 0 else out


class BinnedGBTRegressor(GBTRegressor):
    """GBTRegressor that trains as told above; settings beyond those of Settings are left to Spark's own training."""

    def settings(self) -> Settings | None:
        """None where Spark trains."""
        plain = self.getLossType() == "squared" and self.getFeatureSubsetStrategy() == "all" and self.getImpurity() == "variance"
        more = any(self.isDefined(p) and self.getOrDefault(p) for p in (self.validationIndicatorCol, self.weightCol, self.leafCol))
        if not plain or more or self.getMinWeightFractionPerNode() > 0 or not self.getMaxDepth():
            return None
        return Settings(self.getMaxIter(), self.getMaxDepth(), self.getStepSize(), self.getSubsamplingRate(), self.getMinInstancesPerNode(),
                        self.getMinInfoGain(), self.getSeed())

    def bins(self, df: DataFrame, rows: int) -> Bins:
        vector = self.getFeaturesCol()
        nominal = df.schema[vector].metadata.get("ml_attr", {}).get("attrs", {}).get("nominal", [])
        arity = {a["idx"]: a.get("num_vals", len(a.get("vals", []))) for a in nominal}
        arity = {f: n for f, n in arity.items() if n}
        if max(arity.values(), default=0) > self.getMaxBins():
            raise ValueError(f"maxBins {self.getMaxBins()} is less than the {max(arity.values())} categories of a feature")
        return find_bins(df, vector, arity, self.getMaxBins(), rows, self.getSeed() & 0x7FFFFFFF)

    def _fit(self, dataset: DataFrame) -> GBTRegressionModel:
        settings = self.settings()
        if settings is None:
            return super()._fit(dataset)
        label, vector = self.getLabelCol(), self.getFeaturesCol()
        data = dataset.select(label, vector)
        rows = data.count()
        if not rows:
            raise ValueError("no rows to train on")
        kinds = self.bins(data, rows)
        trees = grown(with_bins(data, vector, kinds), label, ["bins"], kinds, settings, rows)
        return self._copyValues(self._create_model(_model(data, trees, kinds, settings)))


def _model(df: DataFrame, trees: list[Tree], kinds: Bins, settings: Settings):
    """Spark's model of the trees, in the JVM."""
    jvm, gateway = df.sparkSession._jvm, df.sparkSession.sparkContext._gateway
    ml, n = jvm.org.apache.spark.ml, len(kinds.sizes)
    # classes are looked up once: every name on the way to one is a call
    leaf, inner, number, category = ml.tree.LeafNode, ml.tree.InternalNode, ml.tree.ContinuousSplit, ml.tree.CategoricalSplit
    tree_model, variance = ml.regression.DecisionTreeRegressionModel, jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator
    part, wrap = jvm.java.util.Arrays.copyOfRange, jvm.java.nio.ByteBuffer.wrap
    none = float("nan")

    def doubles(values: Iterable[float]):
        data = np.asarray(values, dtype=">f8")
        out = gateway.new_array(jvm.double, len(data))
        wrap(bytearray(data.tobytes())).asDoubleBuffer().get(out)
        return out

    def root(t: Tree):
        value, counts = t.value(), t.count.astype(int)
        stats = doubles(np.stack([t.count, t.sum, np.full(len(t.count), none)], axis=1).ravel())
        sets = [np.flatnonzero(t.left[i]) if t.feature[i] >= 0 and kinds.cuts[t.feature[i]] is None else np.zeros(0, int) for i in range(len(t.left))]
        ends = np.r_[0, np.cumsum([len(x) for x in sets])].tolist()
        held = doubles(np.concatenate(sets))

        def node(i: int):
            own, f = variance(part(stats, 3 * i, 3 * i + 3), int(counts[i])), int(t.feature[i])
            if f < 0:
                return leaf(float(value[i]), none, own)
            if kinds.cuts[f] is None:
                split = category(f, part(held, ends[i], ends[i + 1]), kinds.sizes[f])
            else:
                split = number(f, float(kinds.cuts[f][np.flatnonzero(t.left[i, : kinds.sizes[f]])[-1]]))
            return inner(float(value[i]), none, float(t.gain[i]), node(2 * i + 1), node(2 * i + 2), split, own)

        return node(0)

    made = gateway.new_array(tree_model, len(trees))
    for i, t in enumerate(trees):
        made[i] = tree_model(f"dtr_{i}", root(t), n)
    weights = doubles([1.0] + [settings.step] * (len(trees) - 1))
    return ml.regression.GBTRegressionModel(f"GBTRegressionModel_{settings.seed}", made, weights, n)
