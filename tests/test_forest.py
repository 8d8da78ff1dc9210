"""The deep forest: one tree equals plain recursion, its parts meet, and no node table of all trees is in the driver."""

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from pitwall.plans import forest as fo
from pitwall.plans import models as md
from pitwall.plans.search import Search


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(6000).select(*[(F.xxhash64(F.lit(i), "id") % 1000 / 100.0).alias(f"a{i}") for i in range(4)], (F.col("id") % 2).alias("a4"))
    df = df.withColumn("label", F.sin("a0") * 3 + F.col("a1") * F.col("a4")).withColumn("weight", F.lit(1.0) + F.col("a4"))
    return md.cut_lineage(VectorAssembler(inputCols=[f"a{i}" for i in range(5)], outputCol="features").transform(df))


def plain(x, c, y, depth, least):
    """(value of each row) by recursion over all bins."""
    out = np.full(len(x), (c * y).sum() / c.sum())
    best = (1e-9, None, None)
    for f in range(x.shape[1]):
        for b in range(fo.BINS - 1):
            left = x[:, f] <= b
            if depth and c[left].sum() >= least and c[~left].sum() >= least:
                gain = sum((c[s] * y[s]).sum() ** 2 / c[s].sum() for s in (left, ~left)) - (c * y).sum() ** 2 / c.sum()
                if gain > best[0] + 1e-9:
                    best = (gain, f, b)
    if best[1] is not None:
        left = x[:, best[1]] <= best[2]
        for s in (left, ~left):
            out[s] = plain(x[s], c[s], y[s], depth - 1, least)
    return out


def test_a_subtree_is_what_recursion_gives():
    rng = np.random.default_rng(3)
    x, c = rng.integers(0, 9, (300, 3)).astype(np.uint8), rng.integers(1, 4, 300).astype(float)
    y = rng.normal(size=300)
    got = fo.grow(x, c, c, c * y, 6, 3, 4, rng)
    assert np.allclose(got["value"][fo.walk(x, np.zeros(300, int), got)], plain(x, c, y, 6, 4))


def error(model, df):
    return model.transform(df).agg(F.avg((F.col("prediction") - F.col("label")) ** 2)).first()[0]


def test_wide_nodes_are_split_over_blocks_as_in_one_task(rows, monkeypatch):
    """The same bags and, with all features tried, the same trees: wherever the border of the tasks is."""
    forest = fo.DeepForest(numTrees=3, maxDepth=8, minInstancesPerNode=3, featureSubsetStrategy="all", weightCol="weight", seed=7)
    narrow = forest.fit(rows)
    assert len(narrow.facts["feature"]) == 3  # roots only: every tree was finished in one task
    monkeypatch.setattr(fo, "LOCAL_ROWS", 500)
    wide = forest.fit(rows)
    assert len(wide.facts["feature"]) > 20 and wide.subtrees(rows.sparkSession).count() > 10
    pairs = narrow.transform(rows).select("a0", "a1", "a2", "a3", "a4", F.col("prediction").alias("p")).join(
        wide.transform(rows), ["a0", "a1", "a2", "a3", "a4"])
    assert pairs.filter(F.abs(F.col("p") - F.col("prediction")) > 1e-9).count() == 0
    assert np.allclose(narrow.featureImportances.toArray(), wide.featureImportances.toArray())


def test_it_is_as_good_as_sparks(rows):
    train, test = rows.filter("a3 >= 2.5"), rows.filter("a3 < 2.5")
    settings = dict(numTrees=20, maxDepth=12, minInstancesPerNode=3, featureSubsetStrategy="all", seed=1)
    assert error(fo.DeepForest(**settings).fit(train), test) < 1.15 * error(RandomForestRegressor(**settings).fit(train), test)


def test_nodes_are_no_load_of_the_driver(rows, monkeypatch):
    """Deep trees on noise: their nodes are in the subtree table; the model itself holds few."""
    monkeypatch.setattr(fo, "LOCAL_ROWS", 1000)
    model = fo.DeepForest(numTrees=10, maxDepth=30, featureSubsetStrategy="all").fit(rows.withColumn("label", F.rand(1)))
    nodes = model.subtrees(rows.sparkSession).agg(F.sum(F.length("cut"))).first()[0]
    assert nodes > 10000 and len(model.facts["feature"]) < nodes / 50
    assert isinstance(md.module_lap_forest(["a"]).getStages()[-1], fo.DeepForest)
    assert isinstance(md.podium_estimators(["a"])["podium_forest"].getStages()[-1], fo.DeepForest)


def test_classes_and_empty_scoring(rows):
    df = rows.withColumn("label", (F.col("a0") > 5).cast("double"))
    model = fo.DeepForest(numTrees=5, maxDepth=4, binary=True, seed=3).fit(df)
    got = md.with_probability(model.transform(df))
    assert got.filter("p < 0 or p > 1 or prediction != cast(p > 0.5 as double)").count() == 0 and got.count() == df.count()
    assert got.filter("prediction = label").count() > 0.95 * df.count()
    assert model.transform(df.limit(0)).count() == 0


@pytest.mark.parametrize("binary", [False, True])
def test_a_smaller_forest_is_a_part_of_the_larger(rows, monkeypatch, binary):
    """Fewer trees or levels of one fit say what forests fitted so say; subtrees come in many groups."""
    monkeypatch.setattr(fo, "LOCAL_ROWS", 700)
    monkeypatch.setattr(fo, "GROUP_BYTES", 500)
    df = rows.withColumn("label", (F.col("a0") > 5).cast("double")) if binary else rows
    fit = lambda trees, depth: fo.DeepForest(numTrees=trees, maxDepth=depth, minInstancesPerNode=2, weightCol="weight",
                                             binary=binary, seed=5).fit(df)
    views = [(6, 9), (2, 9), (6, 3), (4, 1)]
    whole = fit(*views[0])
    assert len(list(whole.groups(rows.sparkSession))) > 6
    names = [f"a{i}" for i in range(5)]
    scored = whole.scored(df, views).select(*names, "scores").cache()
    assert scored.count() == df.count()
    for v, view in enumerate(views):
        p = F.col("probability") if binary else None
        alone = fit(*view).transform(df).select(*names, (md.vector_to_array(p)[1] if binary else F.col("prediction")).alias("p"))
        assert scored.join(alone, names).filter(F.abs(F.col("scores")[v] - F.col("p")) > 1e-9).count() == 0


def test_rows_of_one_class_go_to_no_task(rows, monkeypatch):
    """Nodes without anything to split are leaves at once, so their rows are not dealt."""
    monkeypatch.setattr(fo, "LOCAL_ROWS", 5000)
    df = rows.select(md.vector_to_array("features").alias("x"), F.col("a4").cast("double").alias("y"), F.lit(1.0).alias("w"))
    blocks = fo.packed(df, fo.cuts_of(df)[0])
    top = fo.DeepForest(numTrees=3, maxDepth=6, featureSubsetStrategy="all", binary=True)._top(blocks, 5, 5)
    assert len(top["feature"]) == 3 * 3 and not top["open"].any() and set(top["value"][3:]) == {0.0, 1.0}


def test_a_search_fits_points_that_are_parts_of_one_model_once(rows, tmp_path):
    train = rows.withColumn("fold", (F.col("a0") > 5).cast("int"))
    fits, score = [], md.RegressionEvaluator(metricName="mse")

    def make(point):
        fits.append(point)
        return md.Pipeline(stages=[md.VectorAssembler(inputCols=[f"a{i}" for i in range(5)], outputCol="features"),
                                   fo.DeepForest(featureSubsetStrategy="all", seed=1, **point)])

    points = md.grid_points({"numTrees": [2, 4], "maxDepth": [2, 6], "minInstancesPerNode": [1, 3]})
    got = Search(rows.sparkSession, str(tmp_path / "one")).run(train.drop("features"), make, points, score, nested=fo.DeepForest.nested)
    assert len(fits) == 4 and all(p["numTrees"] == 4 and p["maxDepth"] == 6 for p in fits)
    some = points[1:7:2]  # each by itself
    alone = Search(rows.sparkSession, str(tmp_path / "two")).run(train.drop("features"), make, some, score)
    assert np.allclose(got[1:7:2], alone) and len(fits) == 4 + 2 * len(some)


def test_trees_are_dealt_in_batches(rows, monkeypatch):
    whole = fo.DeepForest(numTrees=5, maxDepth=4, seed=3).fit(rows)
    monkeypatch.setattr(fo, "DEALT_BYTES", 200_000)
    assert [list(b) for b in fo.in_batches(np.array([1.0, 1.0, 3.0, 1.0]), 2)] == [[0, 1], [2], [3]]
    parted = fo.DeepForest(numTrees=5, maxDepth=4, seed=3).fit(rows)
    assert abs(error(whole, rows) - error(parted, rows)) < 1e-12 and parted.subtrees(rows.sparkSession).count() == 5
