"""Boosted trees and level forests: one tree equals plain recursion, and they are as good as Spark ML's."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor
from pyspark.sql import functions as F

from pitwall.plans import boosting as bo
from pitwall.plans import models as md


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(6000).select(*[(F.xxhash64(F.lit(i), "id") % 1000 / 100.0).alias(f"a{i}") for i in range(4)], (F.col("id") % 2).alias("a4"))
    df = df.withColumn("label", 5 + F.sin("a0") * 3 + F.col("a1") * F.col("a4"))
    return md.cut_lineage(VectorAssembler(inputCols=[f"a{i}" for i in range(5)], outputCol="features").transform(df))


def plain(x, y, depth, least):
    """(value of each row) by recursion over all bins; ``x``: bins by feature and row."""
    out = np.full(len(y), y.mean())
    best = (1e-9, None, None)
    for f in range(len(x)):
        for b in range(bo.BINS - 1):
            left = x[f] <= b
            if depth and left.sum() >= least and (~left).sum() >= least:
                gain = sum(y[s].sum() ** 2 / s.sum() for s in (left, ~left)) - y.sum() ** 2 / len(y)
                if gain > best[0] + 1e-9:
                    best = (gain, f, b)
    if best[1] is not None:
        left = x[best[1]] <= best[2]
        for s in (left, ~left):
            out[s] = plain(x[:, s], y[s], depth - 1, least)
    return out


def error(model, df):
    return model.transform(df).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0]


def test_a_tree_over_blocks_is_what_recursion_gives(spark):
    rng = np.random.default_rng(3)
    x, y = rng.integers(0, 9, (3, 400)).astype(np.uint8), rng.normal(size=400)
    blocks = spark.sparkContext.parallelize([(i, x[:, p], y[p]) for i, p in enumerate(np.array_split(np.arange(400), 7))], 3)
    trees = bo.Trees(1, 6)
    bo.grow(blocks, trees, [0], 3, 3, 4, 1, lambda t, block, n: (np.arange(n), None))
    assert np.allclose(trees.scores(0, x), plain(x, y, 6, 4))


def test_boosting_is_plain_boosting(rows, monkeypatch):
    """Residuals carried along, or computed from the packed rows again, are those of the trees so far."""
    monkeypatch.setattr(bo, "REPLAY", 3)
    model = bo.BoostedTrees(maxIter=8, stepSize=0.1, maxDepth=3, minInstancesPerNode=5, seed=1).fit(rows)
    got = model.transform(rows).select("features", "label", "prediction").collect()
    raw, y = np.array([r["features"].toArray() for r in got]), np.array([r["label"] for r in got])
    x = np.stack([np.searchsorted(c, raw[:, i]) for i, c in enumerate(model.facts["cuts"])]).astype(np.uint8)
    said = np.full(len(y), y.mean())
    for t in range(8):
        said += (1.0 if t == 0 else 0.1) * plain(x, (y - said) * (1 if t == 0 else 2), 3, 5)
    assert np.allclose(said, [r["prediction"] for r in got])


def test_they_are_as_good_as_sparks(rows):
    train, test = rows.filter("a3 >= 2.5"), rows.filter("a3 < 2.5")
    # no sampling: with few rows the sample of the first tree decides more than the method
    settings = dict(maxIter=10, stepSize=0.1, maxDepth=4, subsamplingRate=1.0, minInstancesPerNode=5, seed=1)
    assert error(bo.BoostedTrees(**settings).fit(train), test) < 1.05 * error(GBTRegressor(**settings).fit(train), test)
    settings = dict(numTrees=20, maxDepth=8, minInstancesPerNode=3, featureSubsetStrategy="sqrt", seed=1)
    assert error(bo.LevelForest(**settings).fit(train), test) < 1.1 * error(RandomForestRegressor(**settings).fit(train), test)


def test_few_trees_at_once_make_the_same_forest(rows, monkeypatch):
    forest = bo.LevelForest(numTrees=4, maxDepth=6, minInstancesPerNode=3, seed=2)
    whole = forest.fit(rows)
    monkeypatch.setattr(bo, "HISTOGRAM_BYTES", 1)
    again = forest.fit(rows)
    assert whole.facts["cut"] == again.facts["cut"] and np.allclose(whole.facts["value"], again.facts["value"])


def test_what_an_executor_keeps_is_bytes_a_row(rows):
    """No objects a row: bins and one residual, whatever the number of trees."""
    data = bo.Packed(rows)
    block = max(data.blocks.collect(), key=lambda b: len(b[2]))
    assert block[1].nbytes + block[2].nbytes == len(block[2]) * (5 + 8)
    assert isinstance(md.nb_estimators(["a"])["nb_gbt"].getStages()[-1], bo.BoostedTrees)
    assert isinstance(md.lap_estimators(["a"])["lap_gbt"].getStages()[-1], bo.BoostedTrees)
    assert isinstance(md.nb_estimators(["a"])["nb_forest"].getStages()[-1], bo.LevelForest)
    assert isinstance(md.lap_estimators(["a"])["lap_forest"].getStages()[-1], bo.LevelForest)


def test_saved_trees_say_the_same(rows, tmp_path):
    model = bo.BoostedTrees(maxIter=3, maxDepth=2, seed=1).fit(rows)
    model.write().save(str(tmp_path / "m"))
    again = bo.TreesModel.load(str(tmp_path / "m"))
    assert again.facts == model.facts and error(again, rows) == error(model, rows)
    assert abs(model.featureImportances.toArray().sum() - 1) < 1e-9 and model.transform(rows.limit(0)).count() == 0


def test_constant_labels_and_few_rows(spark, rows):
    flat = rows.withColumn("label", F.lit(2.5))
    for est in (bo.BoostedTrees(maxIter=2, maxDepth=2), bo.LevelForest(numTrees=2, maxDepth=2)):
        assert {r[0] for r in est.fit(flat).transform(flat).select("prediction").distinct().collect()} == {2.5}
        assert est.fit(rows.limit(1)).transform(rows).count() == 6000


def test_one_tree_from_its_smaller_sides(spark, monkeypatch):
    """What is left of the node above is what counting both sides gives; rows are counted about half as often."""
    rng = np.random.default_rng(4)
    x, y = rng.integers(0, 9, (3, 900)).astype(np.uint8), rng.normal(size=900)
    parts = [(i, x[:, p], y[p]) for i, p in enumerate(np.array_split(np.arange(900), 5))]
    every = lambda t, block, n: (np.arange(n), None)
    for limit in (64, 1):
        monkeypatch.setattr(bo, "COLLECTED", limit)
        trees = bo.Trees(1, 5)
        bo.grow_one(spark.sparkContext.parallelize(parts, 3), trees, 0, 3, 4, 1, every)
        assert np.allclose(trees.scores(0, x), plain(x, y, 5, 4))


def test_models_of_packed_rows_share_them(rows, monkeypatch):
    made = []
    monkeypatch.setattr(md, "Packed", lambda df: made.append(1) or bo.Packed(df))
    train = rows.drop("features")
    pipelines = {k: md.Pipeline(stages=[VectorAssembler(inputCols=[f"a{i}" for i in range(5)], outputCol="features"), e]) for k, e in (
        ("linear", md.LinearRegression()), ("forest", bo.LevelForest(numTrees=2, maxDepth=3)), ("gbt", bo.BoostedTrees(maxIter=2, maxDepth=2)))}
    fitted = md.fit_all(pipelines, train)
    assert len(made) == 1
    for name, pipeline in pipelines.items():
        assert abs(error(fitted[name], train) - error(pipeline.fit(train), train)) < 1e-9
