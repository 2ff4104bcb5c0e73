"""Forests and boosted trees over many rows, grown level by level from counts of binned rows.

They are the trees of Spark's ``RandomForestClassifier`` and ``GBTClassifier``: the same bounds of bins, gains, stopping
rules and pruning, and the result is a model of Spark. What differs is how a level is counted. A row is one small number
per column of bins, all one-hot columns of a category being one of them, and a task counts its rows column by column in
arrays. All rows count on every level. A forest draws the rows of its trees and the columns of its nodes by other seeds.
"""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, cloudpickle
from pyspark.ml import Estimator, Transformer
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch.session import fresh_path, staged

# Executors need not have this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows from which Spark takes the bounds of bins, if the square of their number is not more.
ROWS_FOR_BOUNDS = 10_000
#: Rows counted at a time, so that they stay in the processor's cache.
BLOCK = 1 << 16
#: Trees whose rows are counted in one pass, boosted trees between two written states.
TREES_PER_PASS, TREES_PER_STATE = 100, 10
#: Impurity that counts as none.
EPSILON = 2.0 ** -52
#: Bounds of 32 random bits for 1, 2, ... draws of a row, as many as such bits can tell apart.
DRAWS = np.array([int(c * 2.0 ** 32) for c in np.cumsum([np.exp(-1.0) / float(np.prod(np.arange(1, k + 1))) for k in range(12)])
                  if int(c * 2.0 ** 32) < 2 ** 32], np.uint32)
NODES = ("treeID int, nodeData struct<id: int, prediction: double, impurity: double, impurityStats: array<double>, rawCount: bigint, "
         "gain: double, leftChild: int, rightChild: int, split: struct<featureIndex: int, leftCategoriesOrThreshold: array<double>, "
         "numCategories: int>>")


def can_grow(classifier: Estimator) -> bool:
    """Whether this module knows all settings of the classifier."""
    if isinstance(classifier, RandomForestClassifier):
        known = classifier.getImpurity() == "gini" and classifier.getFeatureSubsetStrategy() in ("auto", "all", "sqrt")
    elif isinstance(classifier, GBTClassifier):
        known = classifier.getFeatureSubsetStrategy() == "all" and not classifier.isDefined(classifier.validationIndicatorCol)
    else:
        return False
    return (known and classifier.getSubsamplingRate() == 1.0 and classifier.getMinWeightFractionPerNode() == 0.0
            and not classifier.isDefined(classifier.weightCol) and not classifier.isDefined(classifier.thresholds))


class Bins:
    """Columns of bins: the one-hot columns of a category together, then each number by its bounds.

    Candidates are all ways to part the rows, in the order of the features: a one-hot column, or a bound of a number.
    """

    def __init__(self, groups: Sequence[int], bounds: Sequence[np.ndarray]):
        self.groups, self.bounds = list(groups), [np.asarray(b, float) for b in bounds]
        self.widths = [*(g + 1 for g in self.groups), *(len(b) + 1 for b in self.bounds)]
        self.starts = np.cumsum([0, *self.widths])
        self.features = sum(self.groups) + len(self.bounds)
        self.code = np.uint8 if max(self.widths) <= 256 else np.uint16 if max(self.widths) <= 65536 else np.uint32
        sizes = [w - 1 for w in self.widths]
        self.column = np.repeat(np.arange(len(sizes)), sizes)
        self.value = np.concatenate([np.arange(s) for s in sizes] or [np.zeros(0, int)])
        first = np.cumsum([0, *self.groups])
        self.feature = np.concatenate([np.arange(first[-1]), np.repeat(first[-1] + np.arange(len(self.bounds)), sizes[len(self.groups):])])

    def codes(self, rows: np.ndarray) -> np.ndarray:
        """The bin of each row in each column, a line per column."""
        out, at = np.empty((len(self.widths), len(rows)), self.code), 0
        for c, size in enumerate(self.groups):
            part = rows[:, at:at + size] > 0.5
            out[c] = np.where(part.any(1), part.argmax(1), size) if size else 0
            at += size
        for c, bounds in enumerate(self.bounds):
            out[len(self.groups) + c] = np.searchsorted(bounds, rows[:, at + c])
        return out

    def of(self, finer: Bins) -> list[np.ndarray]:
        """For each number, the bin of each bin of one that has all these bounds and more."""
        return [np.searchsorted(own, [*more, np.inf]).astype(self.code) for own, more in zip(self.bounds, finer.bounds)]

    def coarse(self, of: list[np.ndarray], codes: np.ndarray) -> np.ndarray:
        """Codes of these bins from codes of finer ones."""
        out = np.empty(codes.shape, self.code)
        for c, line in enumerate(codes):
            out[c] = line if c < len(self.groups) else of[c - len(self.groups)][line]
        return out

    def left(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """From counts (nodes, bins, figures): figures of each node, and of the rows that each candidate sends left."""
        total = counts[:, :self.widths[0]].sum(1)
        parts = []
        for c, width in enumerate(self.widths):
            here = counts[:, self.starts[c]:self.starts[c] + width - 1]
            parts.append(total[:, None] - here if c < len(self.groups) else here.cumsum(1))
        return total, np.concatenate(parts, 1)


def gini(figures: np.ndarray) -> np.ndarray:
    n = figures.sum(-1, keepdims=True)
    share = figures / np.where(n > 0, n, 1)
    return 1.0 - share[..., 0] * share[..., 0] - share[..., 1] * share[..., 1]


def variance(figures: np.ndarray) -> np.ndarray:
    n, s, q = figures[..., 0], figures[..., 1], figures[..., 2]
    n = np.where(n > 0, n, 1)
    return (q - s * s / n) / n


def best(bins: Bins, counts: np.ndarray, boosted: bool, least: int, gain: float, allowed: np.ndarray | None = None) -> tuple:
    """Of each node: its figures, the first candidate of most gain (-1: none gains), that gain, and figures on its left."""
    total, left = bins.left(counts.astype(float))
    right = total[:, None] - left
    impurity, weight = (variance, lambda f: f[..., 0]) if boosted else (gini, lambda f: f.sum(-1))
    n, n_left, n_right = weight(total), weight(left), weight(right)
    gains = impurity(total)[:, None] - n_left / n[:, None] * impurity(left) - n_right / n[:, None] * impurity(right)
    valid = (n_left >= least) & (n_right >= least) & (gains >= gain) & (gains > 0)
    if allowed is not None:
        valid &= allowed[:, bins.feature]
    gains = np.where(valid, gains, -1.0)
    if not gains.shape[1]:
        return total, np.full(len(total), -1), np.zeros(len(total)), total
    pick, at = gains.argmax(1), np.arange(len(total))
    return total, np.where(gains[at, pick] > 0, pick, -1), gains[at, pick], left[at, pick]


class Tree:
    """A tree under growth. Children have higher numbers than their parent, the right one follows the left."""

    def __init__(self):
        self.split, self.child, self.gain, self.figures, self.active = [-1], [0], [0.0], [None], [0]

    def grow(self, total: np.ndarray, split: np.ndarray, gain: np.ndarray, left: np.ndarray, boosted: bool, last: bool) -> None:
        """Parts the nodes of this level as found; unless the children are the last, those that are not pure go on."""
        active = []
        right = total - left
        pure = [np.abs((variance if boosted else gini)(f)) < EPSILON for f in (left, right)]
        for i, node in enumerate(self.active):
            self.figures[node] = total[i]
            if split[i] < 0:
                continue
            self.split[node], self.gain[node], self.child[node] = int(split[i]), float(gain[i]), len(self.split)
            for side, figures in enumerate((left[i], right[i])):
                if not last and not pure[side][i]:
                    active.append(len(self.split))
                self.split.append(-1)
                self.child.append(len(self.child))
                self.gain.append(0.0)
                self.figures.append(figures)
        self.active = active

    def way(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What tasks need to follow it: splits, children (a leaf is its own) and the nodes to count."""
        return np.array(self.split, np.int32), np.array(self.child, np.int32), np.array(self.active, np.int32)

    def means(self) -> np.ndarray:
        return np.array([f[1] / f[0] if f[0] else 0.0 for f in self.figures])

    def nodes(self, bins: Bins, boosted: bool) -> list[tuple]:
        """Its nodes as Spark stores them. Two leaves that predict the same become one, as they do in Spark."""
        predicted = self.means() if boosted else np.array([float(np.argmax(f)) for f in self.figures])
        inner = [s >= 0 for s in self.split]
        for node in range(len(inner) - 1, -1, -1):
            a = self.child[node]
            if inner[node] and not inner[a] and not inner[a + 1] and predicted[a] == predicted[a + 1]:
                inner[node] = False
        kept, place = [0], {}
        for node in kept:
            place[node] = len(place)
            if inner[node]:
                kept += [self.child[node], self.child[node] + 1]
        rows = []
        impurity = (variance if boosted else gini)(np.array([self.figures[n] for n in kept], float))
        for node, unlike in zip(kept, impurity.tolist()):
            figures = [float(x) for x in self.figures[node]]
            gain, a, b, part = -1.0, -1, -1, (-1, [], -1)
            if inner[node]:
                at, a, b = self.split[node], place[self.child[node]], place[self.child[node] + 1]
                number = int(bins.column[at]) - len(bins.groups)
                gain, feature = self.gain[node], int(bins.feature[at])
                part = (feature, [0.0], 2) if number < 0 else (feature, [float(bins.bounds[number][bins.value[at]])], -1)
            rows.append((place[node], float(predicted[node]), unlike, figures, int(figures[0] if boosted else sum(figures)),
                         gain, a, b, part))
        return rows


def follow(bins: Bins, way: tuple, codes: np.ndarray, steps: int) -> np.ndarray:
    """The node of each row after that many steps from the root."""
    split, child, _ = way
    bin_of = np.arange(max(bins.widths))
    column = np.where(split >= 0, bins.column[split], 0) if len(bins.column) else np.zeros(len(split), int)
    value = bins.value[split] if len(bins.value) else np.zeros(len(split), int)
    group = (column < len(bins.groups))[:, None]
    right = np.where(group, bin_of == value[:, None], bin_of > value[:, None]) & (split >= 0)[:, None]
    width, n = len(bin_of), codes.shape[1]
    to = (child[:, None] + right).astype(np.int32).ravel()
    flat, line = codes.ravel(), (column * n).astype(np.int64)
    node, row = np.zeros(n, np.int32), np.arange(n)
    for _ in range(steps):
        at = line[node]
        at += row
        key = node * width
        key += flat[at]
        node = to[key]
    return node


def drawn(seed: int, tree: int, part: int, block: int, rows: int) -> np.ndarray:
    """How often a tree's sample has each row, by Poisson with mean 1; the same whenever the level is counted."""
    bits = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, tree, part, block])).integers(0, 1 << 32, rows, np.uint32)
    times = np.zeros(rows, np.uint8)
    for bound in DRAWS:
        times += bits >= bound
    return times


def places(way: tuple) -> np.ndarray:
    """The number of each node among those to count, -1 for others."""
    place = np.full(len(way[0]), -1, np.int32)
    place[way[2]] = np.arange(len(way[2]))
    return place


def numbers(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    """Features of each batch as a matrix, and labels."""
    for batch in batches:
        if batch.num_rows:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            yield values.reshape(batch.num_rows, -1), batch.column(1).to_numpy(zero_copy_only=False)


def bounds_of(values: np.ndarray, weights: np.ndarray, expected: float, most: int) -> np.ndarray:
    """At most ``most`` bounds between sorted distinct values, as Spark places them."""
    between = (values[:-1] + values[1:]) / 2.0
    if len(between) <= most:
        return between
    upto, stride, found = np.cumsum(weights), expected / (most + 1), []
    target = stride
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            found.append(between[i - 1])
            target += stride
    return np.array(found)


def find_bounds(rows: DataFrame, count: int, first: int, most: int, seed: int) -> list[np.ndarray]:
    """Bounds of all numbers, the features from ``first`` on, from the rows that Spark's trees of this seed take them from.

    Rows are as many as they are expected to be, those that are fewer counting as zeros; this is Spark's way.
    """
    most = min(most, count)
    spark, share = rows.sparkSession, min(1.0, max(most * most, ROWS_FOR_BOUNDS) / count)
    taken = rows.select("features")
    if share < 1:
        bits = spark._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        taken = DataFrame(spark._jsparkSession.createDataFrame(taken._jdf.rdd().sample(False, share, bits), taken._jdf.schema()), spark)
    found = [r.x for r in taken.select(vector_to_array("features").alias("x")).collect()]
    bounds, expected = [], share * count
    for column in np.array(found, float).reshape(len(found), -1)[:, first:].T:
        values, weights = np.unique(column[(column != 0) & ~np.isnan(column)], return_counts=True)
        if expected - weights.sum() > 1e-9 * count:
            at = np.searchsorted(values, 0.0)
            values, weights = np.insert(values, at, 0.0), np.insert(weights.astype(float), at, expected - weights.sum())
        bounds.append(bounds_of(values, weights, expected, most - 1))
    return bounds


def find_codes(rows: DataFrame, bins: Bins) -> DataFrame:
    """A row per task: the bins of all its rows, a line per column, their labels (0, 1) and margins (none yet)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        parts = [(bins.codes(x), (y == 1).astype(np.uint8)) for x, y in numbers(batches)]
        if parts:
            codes, labels = np.concatenate([c for c, _ in parts], 1), np.concatenate([y for _, y in parts])
            yield state(TaskContext.get().partitionId(), codes, labels, np.zeros(0))

    return rows.select(vector_to_array("features"), F.col("label").cast("double")).mapInArrow(encode, STATE)


STATE = "part int, codes binary, labels binary, margins binary"


def state(part: int, codes: np.ndarray, labels: np.ndarray, margins: np.ndarray) -> pa.RecordBatch:
    blobs = [pa.array([x.tobytes()], pa.binary()) for x in (codes, labels, margins)]
    return pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *blobs], ["part", "codes", "labels", "margins"])


def states(bins: Bins, batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    for batch in batches:
        for i in range(batch.num_rows):
            codes, labels, margins = (np.frombuffer(batch.column(k)[i].as_buffer(), kind)
                                      for k, kind in ((1, bins.code), (2, np.uint8), (3, np.float64)))
            yield batch.column(0)[i].as_py(), codes.reshape(-1, len(labels)), labels, margins


def blocks(rows: int) -> Iterator[tuple[int, slice]]:
    return ((i, slice(at, min(at + BLOCK, rows))) for i, at in enumerate(range(0, rows, BLOCK)))


def grow_all(rows: DataFrame, count: int, classifiers: dict[str, Estimator], groups: Sequence[int],
             shares: Callable[[RandomForestClassifier], list[tuple[int, int]]]) -> dict[str, Transformer]:
    """Models of the classifiers, trained on so many rows of (features, label) as they are dealt out to tasks.

    The first features are one-hot columns, as many for each category as ``groups`` says, and all others are numbers.
    ``shares`` gives the trees and seeds that a forest is made of; each has bounds of its own.
    """
    if not classifiers:
        return {}
    seeds = {name: shares(c) if isinstance(c, RandomForestClassifier) else [(1, c.getSeed())] for name, c in classifiers.items()}
    most = {name: c.getMaxBins() for name, c in classifiers.items()}
    bounds = {key: find_bounds(rows, count, sum(groups), *key) for key in dict.fromkeys((most[n], s) for n in seeds for _, s in seeds[n])}
    finest = Bins(groups, [np.unique(np.concatenate(every)) for every in zip(*bounds.values())])
    codes = find_codes(rows, finest).persist(StorageLevel.DISK_ONLY)
    try:
        found = {}
        for name, classifier in classifiers.items():
            bins = [Bins(groups, bounds[most[name], seed]) for _, seed in seeds[name]]
            found[name] = (forest(finest, bins, codes, classifier, [n for n, _ in seeds[name]]) if isinstance(classifier, RandomForestClassifier)
                           else boosted(finest, bins[0], codes, classifier))
        return found
    finally:
        codes.unpersist()


def forest(finest: Bins, bins: Sequence[Bins], codes: DataFrame, classifier: RandomForestClassifier, shares: Sequence[int]) -> Transformer:
    """Trees that each draw their own sample of all rows; the first ``shares[0]`` of them have the first bins, and so on."""
    number, depth, seed = classifier.getNumTrees(), classifier.getMaxDepth(), classifier.getSeed()
    every = classifier.getFeatureSubsetStrategy() == "all" or (number == 1 and classifier.getFeatureSubsetStrategy() == "auto")
    features, of, owner = bins[0].features, [b.of(finest) for b in bins], np.repeat(np.arange(len(shares)), shares)
    subset = features if every else int(np.ceil(np.sqrt(features)))
    least, gain, bootstrap = classifier.getMinInstancesPerNode(), classifier.getMinInfoGain(), classifier.getBootstrap()
    grown = [Tree() for _ in range(number)]

    def counted(level: int, ways: dict[int, tuple]) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, fine, labels, _ in states(finest, batches):
                now = -1
                for tree, way in ways.items():
                    if owner[tree] != now:
                        now = owner[tree]
                        codes = bins[now].coarse(of[now], fine)
                    place, size, own = places(way), 2 * len(way[2]), bins[now]
                    counts = [np.zeros(size * width) for width in own.widths]
                    for i, block in blocks(len(labels)):
                        here, truth, times = codes[:, block], labels[block], None
                        if bootstrap:
                            times = drawn(seed, tree, part, i, len(truth))
                            at = np.flatnonzero(times)
                            here, truth, times = here[:, at], truth[at], times[at]
                        else:
                            here = np.ascontiguousarray(here)
                        if level:
                            node = place[follow(own, way, here, level)]
                            at = np.flatnonzero(node >= 0)
                            here, truth, node = here[:, at], truth[at], node[at].astype(np.int64)
                            times = None if times is None else times[at]
                        else:
                            node = np.zeros(len(truth), np.int64)
                        node = 2 * node + truth
                        times = None if times is None else times.astype(float)
                        for c, width in enumerate(own.widths):
                            key = node * width
                            key += here[c]
                            counts[c] += np.bincount(key, times, size * width)
                    blob = np.concatenate(counts).astype(np.uint32).tobytes()
                    yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), pa.array([blob], pa.binary())], ["tree", "counts"])
        return run

    def chosen(level: int) -> Callable:
        def run(parts: pd.DataFrame) -> pd.DataFrame:
            tree = int(parts["tree"].iloc[0])
            own = bins[owner[tree]]
            total = sum(np.frombuffer(x, np.uint32).astype(np.int64) for x in parts["counts"])
            nodes = len(total) // (2 * int(own.starts[-1]))
            lines, at = [], 0
            for width in own.widths:
                lines.append(total[at:at + 2 * nodes * width].reshape(nodes, 2, width))
                at += 2 * nodes * width
            allowed = None
            if subset < features:
                order = np.random.Generator(np.random.SFC64([seed & 0xFFFFFFFF, tree, level, 1 << 31])).random((nodes, features)).argsort(1)
                allowed = np.zeros((nodes, features), bool)
                np.put_along_axis(allowed, order[:, :subset], True, 1)
            result = best(own, np.concatenate(lines, 2).transpose(0, 2, 1), False, least, gain, allowed)
            return pd.DataFrame({"tree": [tree], "found": [cloudpickle.dumps(result)]})
        return run

    for level in range(depth):
        ways = {i: tree.way() for i, tree in enumerate(grown) if tree.active}
        for at in range(0, len(ways), TREES_PER_PASS):
            some = dict(list(ways.items())[at:at + TREES_PER_PASS])
            counts = codes.mapInArrow(counted(level, some), "tree int, counts binary")
            even = counts.repartition(codes.sparkSession.sparkContext.defaultParallelism, "tree")
            for row in even.groupBy("tree").applyInPandas(chosen(level), "tree int, found binary").collect():
                grown[row.tree].grow(*cloudpickle.loads(row.found), False, level + 1 == depth)
    return stored(codes.sparkSession, classifier, RandomForestClassificationModel, [bins[i] for i in owner], grown, [1.0] * number)


def boosted(finest: Bins, bins: Bins, codes: DataFrame, classifier: GBTClassifier) -> Transformer:
    """Each tree is grown to what the margins so far leave of the labels (-1, 1), by logistic loss; all rows count."""
    depth, least, gain = classifier.getMaxDepth(), classifier.getMinInstancesPerNode(), classifier.getMinInfoGain()
    of, weights = bins.of(finest), [1.0] + [classifier.getStepSize()] * (classifier.getMaxIter() - 1)

    def counted(level: int, way: tuple) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            place, size = places(way), len(way[2])
            for part, fine, labels, margins in states(finest, batches):
                codes = bins.coarse(of, fine)
                counts = [np.zeros((3, size * width)) for width in bins.widths]
                for _, block in blocks(len(labels)):
                    here, sign = np.ascontiguousarray(codes[:, block]), 2.0 * labels[block] - 1.0
                    rest = 4.0 * sign / (1.0 + np.exp(2.0 * sign * margins[block])) if len(margins) else sign
                    if level:
                        node = place[follow(bins, way, here, level)]
                        if (node < 0).any():
                            at = np.flatnonzero(node >= 0)
                            here, rest, node = here[:, at], rest[at], node[at]
                        node = node.astype(np.int64)
                    else:
                        node = np.zeros(len(rest), np.int64)
                    square = rest * rest
                    for c, width in enumerate(bins.widths):
                        key = node * width
                        key += here[c]
                        for k, figure in enumerate((None, rest, square)):
                            counts[c][k] += np.bincount(key, figure, size * width)
                blob = np.concatenate([x.reshape(3, size, -1) for x in counts], 2).tobytes()
                yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([blob], pa.binary())], ["part", "counts"])
        return run

    def moved(way: tuple, steps: np.ndarray) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for part, fine, labels, margins in states(finest, batches):
                codes = bins.coarse(of, fine)
                after = np.array(margins) if len(margins) else np.zeros(len(labels))
                for _, block in blocks(len(labels)):
                    after[block] += steps[follow(bins, way, np.ascontiguousarray(codes[:, block]), depth)]
                yield state(part, fine, labels, after)
        return run

    grown, now, before = [], codes, codes
    try:
        for turn, weight in enumerate(weights):
            tree = Tree()
            for level in range(depth):
                if not tree.active:
                    break
                parts = now.mapInArrow(counted(level, tree.way()), "part int, counts binary").collect()
                # in the order of the tasks, so that sums of doubles are the same each time
                total = sum(np.frombuffer(p.counts).reshape(3, len(tree.active), -1) for p in sorted(parts, key=lambda p: p.part))
                if before is not codes:  # the state after it is kept by now
                    before.unpersist()
                    before = codes
                tree.grow(*best(bins, total.transpose(1, 2, 0), True, least, gain), True, level + 1 == depth)
            grown.append(tree)
            if turn + 1 < len(weights):
                before, now = now, now.mapInArrow(moved(tree.way(), weight * tree.means()), STATE)
                # written from time to time, so that a lost executor does not lead back through all trees
                now = staged(codes.sparkSession, now, "margins") if (turn + 1) % TREES_PER_STATE == 0 else now.persist(StorageLevel.DISK_ONLY)
    finally:
        for one in (before, now):
            if one is not codes:
                one.unpersist()
    return stored(codes.sparkSession, classifier, GBTClassificationModel, [bins] * len(grown), grown, weights)


def stored(spark: SparkSession, classifier: Estimator, kind: type, bins: Sequence[Bins], grown: Sequence[Tree],
           weights: Sequence[float]) -> Transformer:
    """The trees as a model of Spark, by way of its file format."""
    boosted = kind is GBTClassificationModel
    path = fresh_path(spark, "trees")

    def about(name: str, uid: str, **more) -> str:
        given, default = ({p.name: v for p, v in values.items()} for values in (classifier._paramMap, classifier._defaultParamMap))
        if uid != classifier.uid:  # a single tree
            given, default = {"maxDepth": classifier.getMaxDepth(), "seed": classifier.getSeed()}, {}
        return json.dumps({"class": f"org.apache.spark.ml.{name}", "timestamp": int(time.time() * 1000), "sparkVersion": spark.version,
                           "uid": uid, "paramMap": given, "defaultParamMap": default, **more})

    more = {"numFeatures": bins[0].features, "numTrees": len(grown), **({} if boosted else {"numClasses": 2})}
    spark.createDataFrame([(about(f"classification.{kind.__name__}", classifier.uid, **more),)], "value string").coalesce(1).write.text(
        f"{path}/metadata")
    one = "regression.DecisionTreeRegressionModel" if boosted else "classification.DecisionTreeClassificationModel"
    singles = [(i, about(one, f"{classifier.uid}_{i}"), float(w)) for i, w in enumerate(weights)]
    spark.createDataFrame(singles, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(i, node) for i, tree in enumerate(grown) for node in tree.nodes(bins[i], boosted)]
    spark.createDataFrame(nodes, NODES, verifySchema=False).write.parquet(f"{path}/data")
    return kind.load(path)
