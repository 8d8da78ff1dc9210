"""ML invariants: every estimator fits, probabilities lie in [0, 1], reload gives the same scores,
models beat the mean; the tuning grids are the reference's."""

import pytest
from pyspark.sql import functions as F

from pitwall.plans import evaluate as ev
from pitwall.plans import models as md
from pitwall.plans.base_tables import RaceTables
from pitwall.plans.registry import ModelRegistry
from pitwall.plans.search import Search

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return RaceTables(spark, SF)


@pytest.fixture(scope="module")
def laps(tables):
    return md.lap_sets(tables)


@pytest.fixture(scope="module")
def notebook(tables):
    return md.nb_sets(tables)


@pytest.fixture(scope="module")
def podiums(tables):
    return md.podium_sets(tables)


@pytest.fixture(scope="module")
def poles(tables):
    return md.prepared(tables, "pole", weighted=True)


def _beats_mean(train, test, pipeline):
    """On the rows it learnt from a regressor is no worse than their mean; it scores every test row.

    (The lap times of the test tables are noise, so nothing can be asked of other rows.)
    """
    model = pipeline.fit(train)
    mean = train.agg(F.avg("label")).first()[0]
    row = model.transform(train).agg(F.avg((F.col("prediction") - F.col("label")) ** 2).alias("mse"),
                                     F.avg((F.lit(mean) - F.col("label")) ** 2).alias("base")).first()
    pred = model.transform(test)
    assert pred.count() == test.count() > 0 and pred.filter("prediction is null or isnan(prediction)").count() == 0
    return row["mse"] <= row["base"] * (1 + 1e-9)


@pytest.mark.parametrize("name", ["lap_linear", "lap_forest", "lap_gbt"])
def test_lap_regressors(laps, name):
    train, test, cols = laps
    assert _beats_mean(train, test, md.lap_estimators(cols)[name])


def test_module_lap_forest_at_a_small_depth(laps):
    train, test, cols = laps
    forest = md.module_lap_forest(cols, depth=5)
    assert forest.getStages()[-1].getNumTrees() == 100 and _beats_mean(train, test, forest)


@pytest.mark.parametrize("name", ["nb_linear", "nb_forest", "nb_gbt"])
def test_notebook_regressors(notebook, name):
    train, test, cols = notebook
    assert _beats_mean(train, test, md.nb_estimators(cols)[name])


def test_notebook_comparison(notebook):
    train, test, cols = notebook
    est = md.nb_estimators(cols)
    preds = {n: est[n].fit(train).transform(test) for n in ("nb_linear", "nb_forest")}
    rows = {r["model"]: r for r in md.model_comparison(preds, "nb_linear").collect()}
    assert rows["nb_linear"]["improvement_over_linear"] == 0
    assert rows["nb_forest"]["improvement_over_linear"] == rows["nb_linear"]["mse"] - rows["nb_forest"]["mse"]


@pytest.mark.parametrize("name", ["podium_logistic", "podium_forest"])
def test_podium_models(spark, podiums, name):
    train, test, cols = podiums
    model = md.podium_estimators(cols, train.count())[name].fit(train)
    pred = md.with_probability(model.transform(test))
    bounds = pred.agg(F.min("p").alias("lo"), F.max("p").alias("hi")).first()
    assert 0.0 <= bounds["lo"] <= bounds["hi"] <= 1.0
    top = ev.predicted_top3(pred).groupBy("season", "round").count()
    assert top.filter("count > 3").count() == 0
    registry = ModelRegistry(spark)
    registry.save(model, f"t_{name}")
    again = registry.latest(f"t_{name}")
    assert sorted(r["p"] for r in md.with_probability(again.transform(test)).collect()) == sorted(r["p"] for r in pred.collect())
    assert md.feature_importance(model, spark).count() == len(cols)


@pytest.mark.parametrize("name", ["pole_logistic", "pole_one_vs_rest", "pole_forest"])
def test_pole_models(spark, tables, poles, name):
    train, test, cols, features = poles
    model = md.pole_estimators(cols, train.count())[name].fit(train)
    pred = model.transform(test)
    classes = {r["label"] for r in train.select("label").distinct().collect()}
    assert {r["prediction"] for r in pred.collect()} <= classes
    assert md.decode_pole(pred, features).filter("predicted_driverId is null").count() == 0
    rows = md.feature_importance(model, spark).collect()
    if name == "pole_forest":
        assert len(rows) == len(cols)
    else:
        assert len(rows) == len(cols) * (int(max(classes)) + 1) and {r["kind"] for r in rows} == {"coefficient"}


def test_a_stronger_penalty_shrinks_the_coefficients(podiums):
    train, _, cols = podiums
    size = lambda c: sum(v * v for v in _logistic(train, cols, c))
    assert size(0.001) < size(1.0)


def _logistic(train, cols, c):
    est = md.podium_estimators(cols, train.count())["podium_logistic"]
    est.getStages()[-1].setRegParam(md.l2(train.count(), c)["regParam"])
    return est.fit(train).stages[-1].coefficients.toArray()


def test_grids_are_the_references():
    none = md.MAX_DEPTH_NONE
    assert md.LAP_GRID == {"numTrees": [100], "maxDepth": [20, none], "minInstancesPerNode": [3]}
    assert md.CLASS_GRID["numTrees"] == [100] and md.CLASS_GRID["maxDepth"] == [10, none]
    big = md.MODULE_CLASS_GRID
    assert (big["numTrees"], big["maxDepth"], big["weightCol"]) == ([50, 100], [5, 10, none], ["one", "weight"])
    assert big["minInstancesPerNode"] == sorted({max(leaf, md.min_instances(split)) for split in (2, 5) for leaf in (1, 2)})


def test_tuning_flags_the_best_and_states_the_models_own_parameters(spark, tables):
    found = md.tune_podium_forest(tables, {"numTrees": [3], "maxDepth": [1, 10], "weightCol": ["one", "weight"]})
    rows = md.tuning_table(found, "podium", spark).collect()
    assert len(rows) == 4 and sum(r["best"] for r in rows) == 1
    best = next(r for r in rows if r["best"])
    assert best["metric"] == max(r["metric"] for r in rows) and best["params"] == found.fitted_params()
    scored = md.with_probability(found.model.transform(found.test))
    assert 0 <= ev.roc_auc(scored, "on_podium", "p").first()["roc_auc"] <= 1


def test_a_lap_grid_of_two_points(spark, tables):
    found = md.tune_lap_forest(tables, {"numTrees": [2], "maxDepth": [1, 3]})
    rows = md.tuning_table(found, "lap", spark).collect()
    assert next(r for r in rows if r["best"])["metric"] == min(r["metric"] for r in rows)


def test_module_lap_grid():
    assert md.MODULE_LAP_GRID["minInstancesPerNode"] == sorted({max(leaf, md.min_instances(split)) for split in (2, 5) for leaf in (1, 2)})
    assert (md.MODULE_LAP_GRID["numTrees"], md.MODULE_LAP_GRID["maxDepth"]) == ([50, 100], [10, 20])
    assert len(md.grid_points(md.MODULE_LAP_GRID)) == 12 and len(md.grid_points(md.MODULE_CLASS_GRID)) == 36


def test_a_search_that_was_stopped_fits_only_what_is_missing(spark, podiums, tmp_path):
    train, _, cols = podiums
    train = train.withColumn("fold", (F.col("round") % 2).cast("int"))
    fits = []

    class Stopped(Exception):
        pass

    def make(point, stop_after=None):
        if stop_after is not None and len(fits) >= stop_after:
            raise Stopped
        fits.append(point)
        return md.Pipeline(stages=[md._assembler(cols), md.RandomForestClassifier(seed=1, **point)])

    points = md.grid_points({"numTrees": [2, 3], "maxDepth": [2, 3]})
    score = md.BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0)
    search = Search(spark, str(tmp_path / "search"))
    with pytest.raises(Stopped):
        search.run(train, lambda p: make(p, 3), points, score, parallelism=1)
    assert len(fits) == 3 and search.finished().count() == 3
    # a unit whose writer died half-way counts as missing
    (tmp_path / "search" / f"{Search.unit(points[2], 1)}.json").write_text('{"point":')
    got = Search(spark, str(tmp_path / "search")).run(train, make, points, score)
    assert len(fits) == 8 and search.finished().count() == 8
    assert got == Search(spark, str(tmp_path / "other")).run(train, make, points, score)
    assert got == search.run(train, lambda p: make(p, 0), points, score)
