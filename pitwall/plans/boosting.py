"""M2-M4: boosted trees and forests of bounded depth, whose statistics do not grow with the rows.

Spark ML keeps every training row as objects (bins, bag counts of all trees, prediction, error)
in the executors; what does not fit goes to disk and is read again for every level of every tree.
Here rows are binned once and packed (see :mod:`pitwall.plans.forest`); a block of some thousand rows
is one element of an RDD.  A level is one job: each task adds up histograms of its blocks, they
are summed by tree, and the best cuts of a tree are chosen where its sums meet.  Boosting carries
one residual a row, which the next tree's first job brings up to date.

The rules are Spark ML's: quantile bins, Poisson(1) bags or Bernoulli samples, the same minimum of
bagged rows and gain above zero.  For the squared error the first tree has weight 1, and the others,
fitted to twice the residual, ``stepSize``.
"""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.plans.forest import BINS, BLOCK_ROWS, CLOSED, POISSON, best_cut, cuts_of, packed, subsets

#: Rows of a partition, at most about, and of a block; bytes of the histograms that a task holds at a time.
PART_ROWS, MERGED_ROWS, HISTOGRAM_BYTES = 1 << 22, 1 << 17, 64 << 20
#: The sums of a tree's level come to the driver from so many partitions; from more they are added up before.
COLLECTED = 64
#: After so many trees the residuals are computed from the packed rows again, which bounds the lineage.
REPLAY = 25


class TreeParams(Params):
    """Spark ML's names, as far as they are used here."""

    maxDepth = Param(Params._dummy(), "maxDepth", "levels below a root")
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "bagged rows of a node, at least")
    seed = Param(Params._dummy(), "seed", "seed of bags and feature subsets")
    numTrees = Param(Params._dummy(), "numTrees", "trees of a forest")
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "features tried at a node: all or sqrt")
    maxIter = Param(Params._dummy(), "maxIter", "boosted trees")
    stepSize = Param(Params._dummy(), "stepSize", "weight of every boosted tree but the first")
    subsamplingRate = Param(Params._dummy(), "subsamplingRate", "share of the rows that a boosted tree is fitted on")

    def _of(self, param: str):
        return self.getOrDefault(param)

    def getNumTrees(self) -> int:
        return self._of("numTrees")


# --- trees as heaps -----------------------------------------------------------------------

class Trees:
    """Trees of one depth: node k of level l is entry 2^l - 1 + k; each has 2^depth leaves."""

    def __init__(self, number: int, depth: int) -> None:
        self.depth = depth
        self.feature = np.zeros((number, (1 << depth) - 1), np.int16)
        # the rows of a closed node go left, down to one leaf
        self.cut = np.full((number, (1 << depth) - 1), CLOSED, np.uint8)
        self.value = np.zeros((number, 1 << depth))

    def nodes(self, tree: int, x: np.ndarray, rows: np.ndarray, depth: int) -> np.ndarray:
        """Where rows are on a level; ``x``: bins by feature and row."""
        at, flat, n = np.zeros(len(rows), np.int64), x.ravel(), x.shape[1]
        for level in range(depth):
            here = slice((1 << level) - 1, (2 << level) - 1)
            start = (self.feature[tree, here].astype(np.int64) * n).take(at)
            start += rows
            right = flat.take(start) > self.cut[tree, here].take(at)
            at += at
            at += right
        return at

    def scores(self, tree: int, x: np.ndarray) -> np.ndarray:
        return self.value[tree].take(self.nodes(tree, x, np.arange(x.shape[1]), self.depth))


# --- helpers of a task ------------------------------------------------------------------

Block = tuple[int, np.ndarray, np.ndarray]


def poisson_bag(seed: int, tree: int, block: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a block that are in the tree's bag, and how often."""
    c = POISSON.take(np.random.default_rng([seed, tree, block]).integers(0, 1 << 16, n, np.uint16))
    rows = np.flatnonzero(c)
    return rows, c[rows].astype(np.float64)


def sample_bag(rate: float, seed: int, tree: int, block: int, n: int) -> tuple[np.ndarray, None]:
    """Rows of a block that the tree is fitted on, each once."""
    return np.flatnonzero(np.random.default_rng([seed, tree, block]).random(n, np.float32) < rate), None


def tried_at(seed: int, tree: int, level: int, nodes: np.ndarray, features: int, tried: int) -> np.ndarray:
    """The features tried at the nodes of a tree's level."""
    if tried == features:
        return subsets(None, len(nodes), features, tried)
    return subsets(np.random.default_rng([seed, 2, tree, level]), 1 << level, features, tried)[nodes]


def level_sums(blocks: Iterator[Block], trees: Trees, level: int, live: dict[int, np.ndarray], tries: dict[int, np.ndarray],
               bag) -> Iterator[tuple[int, np.ndarray]]:
    """(tree, rows and labels by live node, feature tried and bin) of some blocks."""
    sums = {t: np.zeros((2, *tries[t].shape, BINS)) for t in live}
    slots = {t: np.full(1 << level, len(nodes)) for t, nodes in live.items()}
    for t, nodes in live.items():
        slots[t][nodes] = np.arange(len(nodes))
    for block, x, y in blocks:
        n, flat = x.shape[1], x.ravel()
        for t, nodes in live.items():
            rows, c = bag(t, block, n)
            slot = slots[t].take(trees.nodes(t, x, rows, level))
            if len(nodes) < 1 << level:
                use = np.flatnonzero(slot < len(nodes))
                rows, slot, c = rows[use], slot[use], None if c is None else c[use]
            label = y.take(rows) if c is None else y.take(rows) * c
            base, size, tried = slot * BINS, len(nodes) * BINS, tries[t].shape[1]
            for j in range(tried):
                # all features: a column as it is; else each node's own
                key = (x[j].take(rows) if tried == len(x) else flat.take((tries[t][:, j] * n).take(slot) + rows)) + base
                sums[t][0, :, j] += np.bincount(key, c, size).reshape(-1, BINS)
                sums[t][1, :, j] += np.bincount(key, label, size).reshape(-1, BINS)
    yield from sums.items()


def chosen(sums: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Per node: gain (-inf: none), which of the features tried, bin, and (rows, label) left of it and in all."""
    c, y = sums
    parts = [best_cut(np.stack([c[:, j], c[:, j], y[:, j]], axis=-1), least) for j in range(c.shape[1])]
    gain = np.stack([p[0] for p in parts], axis=1)
    which, row = gain.argmax(axis=1), np.arange(len(gain))
    cut, left = (np.stack([p[i] for p in parts], axis=1)[row, which] for i in (1, 2))
    return gain[row, which], which, cut, left[:, [0, 2]], np.stack([c[row, which].sum(axis=1), y[row, which].sum(axis=1)], axis=1)


def grow(state: RDD, trees: Trees, which: list[int], features: int, tried: int, least: int, seed: int, bag) -> np.ndarray:
    """Grow some trees level by level; the gains by tree and feature."""
    gains = np.zeros((len(trees.value), features))
    live = {t: np.zeros(1, np.int64) for t in which}
    for level in range(trees.depth):
        following = {}
        at_once = max(1, HISTOGRAM_BYTES // max(1, max((len(n) for n in live.values()), default=1) * tried * BINS * 16))
        order = list(live)
        for i in range(0, len(order), at_once):
            part = {t: live[t] for t in order[i:i + at_once]}
            tries = {t: tried_at(seed, t, level, n, features, tried) for t, n in part.items()}
            count = partial(level_sums, trees=trees, level=level, live=part, tries=tries, bag=bag)
            tasks = min(len(part), state.ctx.defaultParallelism)
            found = state.mapPartitions(count).reduceByKey(np.add, tasks).mapValues(partial(chosen, least=least)).collect()
            for t, best in found:
                below, counts = take(trees, gains, t, level, part[t], tries[t], best)
                if (counts >= 2 * least).any():
                    following[t] = below[counts >= 2 * least]
        live = dict(sorted(following.items()))
    return gains


def take(trees: Trees, gains: np.ndarray, t: int, level: int, nodes: np.ndarray, tries: np.ndarray,
         best: tuple[np.ndarray, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Put the best cuts of a level's nodes into a tree; the nodes below those that split, and their rows."""
    gain, j, cut, left, total = best
    split, size = np.isfinite(gain), 1 << level
    trees.value[t, nodes << (trees.depth - level)] = total[:, 1] / np.maximum(total[:, 0], 1)
    nodes, j, cut, left, right = nodes[split], j[split], cut[split], left[split], (total - left)[split]
    feature = tries[split, j]
    trees.feature[t, size - 1 + nodes], trees.cut[t, size - 1 + nodes] = feature, cut
    gains[t] += np.bincount(feature, gain[split], gains.shape[1])
    below = np.stack([2 * nodes, 2 * nodes + 1], axis=1).ravel()
    stats = np.stack([left, right], axis=1).reshape(-1, 2)
    trees.value[t, below << (trees.depth - level - 1)] = stats[:, 1] / np.maximum(stats[:, 0], 1)
    return below, stats[:, 0]


def grow_one(state: RDD, trees: Trees, t: int, features: int, least: int, seed: int, bag) -> np.ndarray:
    """Grow one tree that tries all features: of two sides only the smaller one is counted, the other is what
    is left of the node above."""
    gains = np.zeros((len(trees.value), features))
    live, counted, above = np.zeros(1, np.int64), np.zeros(1, np.int64), {}
    for level in range(trees.depth):
        tries = {t: tried_at(seed, t, level, counted, features, features)}
        count = partial(level_sums, trees=trees, level=level, live={t: counted}, tries=tries, bag=bag)
        found = state.mapPartitions(count)
        if found.getNumPartitions() > COLLECTED:
            found = found.reduceByKey(np.add, 1)
        sums = sum(s for _, s in found.collect())
        own = {int(n): sums[:, i] for i, n in enumerate(counted)}
        for n in live.tolist():
            if n not in own:
                c, y = above[n >> 1] - own[n ^ 1]
                own[n] = np.stack([c, np.where(c > 0, y, 0.0)])
        best = chosen(np.stack([own[n] for n in live.tolist()], axis=1), least)
        below, rows = take(trees, gains, t, level, live, tried_at(seed, t, level, live, features, features), best)
        pairs, big = rows.reshape(-1, 2), (rows >= 2 * least).reshape(-1, 2)
        live, above = below[rows >= 2 * least], own
        counted = (below[::2] + (pairs[:, 1] < pairs[:, 0]))[big.any(axis=1)]
        if not len(live):
            break
    return gains


# --- Spark steps --------------------------------------------------------------------------

class Packed:
    """Training rows as an RDD of blocks (number, bins by feature and row, label less the mean)."""

    def __init__(self, df: DataFrame) -> None:
        rows = df.select(vector_to_array("features").alias("x"), F.col("label").cast("double").alias("y"), F.lit(1.0).alias("w"))
        self.cuts, known = cuts_of(rows, F.avg("y").alias("mean"), F.count("y").alias("n"))
        self.features, self.mean, n = len(self.cuts), known["mean"], known["n"]
        blocks = packed(rows.withColumn("y", F.col("y") - F.lit(self.mean)), self.cuts)
        parts = max(min(2 * df.sparkSession.sparkContext.defaultParallelism, 1 + n // BLOCK_ROWS), 1 + n // PART_ROWS)
        # in order, so that a lost partition is the same again
        dealt = blocks.select("block", "n", "x", "y").repartition(parts).sortWithinPartitions("block")
        self.blocks = dealt.rdd.mapPartitions(partial(unpacked, features=self.features))


def unpacked(rows: Iterator, features: int) -> Iterator[Block]:
    """The blocks of a partition, those that follow one another as one of up to MERGED_ROWS."""
    held = []
    for row in rows:
        if held and sum(r["n"] for r in held) + row["n"] > MERGED_ROWS:
            yield merged(held, features)
            held = []
        held.append(row)
    if held:
        yield merged(held, features)


def merged(rows: list, features: int) -> Block:
    x = np.concatenate([np.frombuffer(r["x"], np.uint8) for r in rows]).reshape(-1, features)
    return rows[0]["block"], np.ascontiguousarray(x.T), np.concatenate([np.frombuffer(r["y"], np.float64) for r in rows])


def kept(state: RDD) -> RDD:
    return state.persist(StorageLevel.MEMORY_AND_DISK)


def less(block: Block, trees: Trees, which: range, weights: np.ndarray) -> Block:
    """A block whose labels are less by what some trees say."""
    number, x, y = block
    return number, x, y - sum(weights[t] * trees.scores(t, x) for t in which)


class LevelForest(Estimator, TreeParams):
    """A forest of bounded depth on ``features`` and ``label``, all trees at once."""

    @keyword_only
    def __init__(self, *, numTrees=20, maxDepth=5, minInstancesPerNode=1, featureSubsetStrategy="sqrt", seed=0) -> None:
        super().__init__()
        self._setDefault(numTrees=20, maxDepth=5, minInstancesPerNode=1, featureSubsetStrategy="sqrt", seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TreesModel:
        return self.fit_on(Packed(df))

    def fit_on(self, data: Packed) -> TreesModel:
        seed, number = self._of("seed"), self._of("numTrees")
        tried = data.features if self._of("featureSubsetStrategy") == "all" else math.ceil(math.sqrt(data.features))
        trees, state = Trees(number, self._of("maxDepth")), kept(data.blocks)
        gains = grow(state, trees, list(range(number)), data.features, tried, self._of("minInstancesPerNode"), seed,
                     partial(poisson_bag, seed))
        state.unpersist()
        gains /= np.maximum(gains.sum(axis=1, keepdims=True), 1e-300)
        return self._copyValues(TreesModel.of(data, trees, np.full(number, 1.0 / number), gains))


class BoostedTrees(Estimator, TreeParams):
    """Gradient boosting of the squared error on ``features`` and ``label``."""

    @keyword_only
    def __init__(self, *, maxIter=20, stepSize=0.1, maxDepth=5, subsamplingRate=1.0, minInstancesPerNode=1, seed=0) -> None:
        super().__init__()
        self._setDefault(maxIter=20, stepSize=0.1, maxDepth=5, subsamplingRate=1.0, minInstancesPerNode=1, seed=0)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> TreesModel:
        return self.fit_on(Packed(df))

    def fit_on(self, data: Packed) -> TreesModel:
        seed, number = self._of("seed"), self._of("maxIter")
        trees, gains = Trees(number, self._of("maxDepth")), np.zeros((number, data.features))
        # a leaf's value is its mean residual: the tree fitted to twice the residual says twice as much
        weights = np.array([1.0] + [2 * self._of("stepSize")] * (number - 1))
        bag = partial(sample_bag, self._of("subsamplingRate"), seed)
        state, before = kept(data.blocks), None
        for t in range(number):
            if t:
                source, which = (state, range(t - 1, t)) if t % REPLAY else (data.blocks, range(t))
                before, state = state, kept(source.map(partial(less, trees=trees, which=which, weights=weights)))
            gains += grow_one(state, trees, t, data.features, self._of("minInstancesPerNode"), seed, bag)
            if before is not None:
                before.unpersist()
        state.unpersist()
        return self._copyValues(TreesModel.of(data, trees, weights, gains * weights[:, None]))


class TreesModel(Model, TreeParams, MLWritable, MLReadable):
    """Fitted trees: a weighted sum above the mean."""

    FACTS = ("cuts array<array<double>>, mean double, depth int, feature array<array<int>>, cut array<array<int>>, "
             "value array<array<double>>, weights array<double>, importances array<double>")

    def __init__(self, facts: dict | None = None) -> None:
        super().__init__()
        self.facts = facts or {}

    @classmethod
    def of(cls, data: Packed, trees: Trees, weights: np.ndarray, gains: np.ndarray) -> TreesModel:
        total = gains.sum(axis=0)
        return cls({"cuts": data.cuts, "mean": float(data.mean), "depth": trees.depth, "weights": weights.tolist(),
                    "importances": (total / max(total.sum(), 1e-300)).tolist(),
                    **{k: getattr(trees, k).tolist() for k in ("feature", "cut", "value")}})

    @property
    def featureImportances(self) -> DenseVector:
        return DenseVector(self.facts["importances"])

    def _transform(self, df: DataFrame) -> DataFrame:
        facts, ends = self.facts, [np.array(c) for c in self.facts["cuts"]]
        trees = Trees(len(facts["weights"]), facts["depth"])
        for k in ("feature", "cut", "value"):
            setattr(trees, k, np.array(facts[k], getattr(trees, k).dtype).reshape(getattr(trees, k).shape))

        @F.pandas_udf("double")
        def score(*columns: pd.Series) -> pd.Series:
            x = np.stack([e.searchsorted(c.to_numpy()) for e, c in zip(ends, columns, strict=True)]).astype(np.uint8)
            return pd.Series(facts["mean"] + sum(w * trees.scores(t, x) for t, w in enumerate(facts["weights"])))

        x = vector_to_array("features")
        return df.withColumn("prediction", score(*[x[i] for i in range(len(ends))]))

    def write(self) -> MLWriter:
        return _TreesWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _TreesReader(cls)


class _TreesWriter(MLWriter):
    def __init__(self, model: TreesModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark)
        names = [f.split()[0] for f in TreesModel.FACTS.split(", ")]
        one = spark.createDataFrame([tuple(self.model.facts[k] for k in names)], TreesModel.FACTS)
        one.coalesce(1).write.parquet(os.path.join(path, "facts"))


class _TreesReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> TreesModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.cls(self.sparkSession.read.schema(TreesModel.FACTS).parquet(os.path.join(path, "facts")).first().asDict())
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model
