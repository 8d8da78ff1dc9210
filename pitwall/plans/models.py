"""Spark ML fit / transform for the three models.

Features are fitted on the training seasons only (codes, medians), then
assembled; every estimator is a distributed Spark ML estimator.  Parameters
follow the reference's chosen settings, mapped to Spark ML names:

* sklearn ``max_depth=None`` -> ``maxDepth=30`` (Spark's ceiling);
* ``min_samples_split=n`` -> ``minInstancesPerNode=ceil(n / 2)`` (Spark has
  no split-size rule, only a per-child minimum);
* ``class_weight='balanced'`` -> ``weightCol`` with n / (k * n_class);
  ``balanced_subsample`` has no Spark form and is treated as ``balanced``.

* logistic ``C`` (L2) -> ``regParam = 1 / (C n)`` without standardization, as
  Spark averages the loss over the n rows.

Random streams differ from scikit-learn, so results are compared on
quality, never value by value.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import os
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, OneVsRest, RandomForestClassifier
from pyspark.ml.evaluation import (BinaryClassificationEvaluator,
                                   MulticlassClassificationEvaluator, RegressionEvaluator)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitwall.operators.aggregates import class_weights
from pitwall.operators.splits import hash_split, kfold2, stratified_kfold2, temporal_split
from pitwall.plans import evaluate as ev
from pitwall.plans import features as ft
from pitwall.plans import notebook as nb
from pitwall.plans.base_tables import RaceTables
from pitwall.plans.boosting import BoostedTrees, LevelForest, Packed
from pitwall.plans.fitted import FeatureModel
from pitwall.plans.forest import DeepForest
from pitwall.plans.registry import ModelRegistry
from pitwall.plans.search import Search
from pitwall.session import cut_lineage, input_stamp
from pitwall.sources.commit import shared_root
from pitwall.sources.conform import INPUTS

TRAIN = [1995, 1996, 1997, 1998, 1999]
TEST = [2000, 2001]
SEED = 42
#: Raise it when recipes or estimators change, so that stored models and searches of before don't count.
VERSION = 3
MAX_DEPTH_NONE = 30

# The reference's grids, in Spark's names (None -> MAX_DEPTH_NONE; a leaf
# minimum and a split minimum become the larger per-child minimum).
#: The training script's lap grid (100 trees on all features, split 5, leaf 2).
LAP_GRID = {"numTrees": [100], "maxDepth": [20, MAX_DEPTH_NONE], "minInstancesPerNode": [3]}
#: The training script's pole and podium grid (100 trees, split 5, balanced classes).
CLASS_GRID = {"numTrees": [100], "maxDepth": [10, MAX_DEPTH_NONE], "minInstancesPerNode": [3], "weightCol": ["weight"]}
#: The modules' larger grids: splits 2 and 5, leaves 1 and 2, with and without class weights.
MODULE_CLASS_GRID = {"numTrees": [50, 100], "maxDepth": [5, 10, MAX_DEPTH_NONE], "minInstancesPerNode": [1, 2, 3],
                     "weightCol": ["one", "weight"]}
#: The module's lap grid: splits 2 and 5, leaves 1 and 2.
MODULE_LAP_GRID = {"numTrees": [50, 100], "maxDepth": [10, 20], "minInstancesPerNode": [1, 2, 3]}
#: Pole forests (a few rows a race): the rows remember the node they are in, which is
#: checkpointed, and a group's statistics stay within this many megabytes a task.
DEEP = {"cacheNodeIds": True, "checkpointInterval": 10, "maxMemoryInMB": 512}
#: Training rows of a task.
ROWS_A_TASK = 1 << 15


def min_instances(min_samples_split: int) -> int:
    return max(1, math.ceil(min_samples_split / 2))


def _numeric(df: DataFrame, cols: list[str], label: str) -> DataFrame:
    keep = [c for c in df.columns if c not in cols]
    return df.select(*keep, *[F.col(c).cast("double").alias(c) for c in cols],
                     F.col(label).cast("double").alias("label"))


def _assembler(cols: list[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="error")


# --- data sets ------------------------------------------------------------------------

class Prepared(NamedTuple):
    """Training and test rows of a model family, its usable features, and the stage that made them."""

    train: DataFrame
    test: DataFrame
    cols: list[str]
    features: FeatureModel


def prepared(t: RaceTables, family: str, weighted: bool = False) -> Prepared:
    """Fit the family's recipe on the training seasons and apply it to all; ``weighted`` adds
    balanced class weights (and ``one``) to the training rows."""
    recipe = ft.RECIPES[family]
    inputs = recipe.inputs(t).filter(F.col("season").isin(TRAIN + TEST))
    stage = recipe.fitter().fit(inputs.filter(F.col("season").isin(TRAIN)))
    # ML makes several passes: materialise the feature rows once (shared folder)
    df = cut_lineage(_numeric(stage.transform(inputs), recipe.wanted, recipe.label))
    s = temporal_split(df, TRAIN, TEST)
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    if weighted:
        w = class_weights(train, "label", "weight").select("label", "weight")
        # one row per class; a shuffle by label would bring a whole class into one task
        train = train.join(F.broadcast(w), "label", "left").withColumn("one", F.lit(1.0))
    return Prepared(train, test, stage.usable, stage)


def lap_sets(t: RaceTables) -> tuple[DataFrame, DataFrame, list[str]]:
    return prepared(t, "lap")[:3]


def nb_sets(t: RaceTables) -> tuple[DataFrame, DataFrame, list[str]]:
    """The notebook's rows and its 80/20 split."""
    df = hash_split(nb.nb_lap_lags(t), ["raceId", "driverId", "lap"])
    df = cut_lineage(_numeric(df, nb.NB_FEATURES, "normalized_time"))
    return df.filter("split = 'train'"), df.filter("split = 'test'"), nb.NB_FEATURES


def podium_sets(t: RaceTables, weighted: bool = True) -> tuple[DataFrame, DataFrame, list[str]]:
    return prepared(t, "podium", weighted)[:3]


def pole_sets(t: RaceTables, weighted: bool = True) -> tuple[DataFrame, DataFrame, list[str]]:
    return prepared(t, "pole", weighted)[:3]


def in_tasks(train: DataFrame) -> DataFrame:
    """Training rows in as many partitions as they fill."""
    return cut_lineage(train.repartition(1 + train.count() // ROWS_A_TASK))


def complete(features: FeatureModel, fitted: PipelineModel) -> PipelineModel:
    """The model as it is saved: fitted features first."""
    return PipelineModel(stages=[features, *fitted.stages])


# --- estimators (reference settings) -------------------------------------------------------

def l2(rows: int, c: float = 1.0) -> dict:
    """The penalty of scikit-learn's ``C`` for a fit on ``rows`` rows."""
    return {"regParam": 1.0 / (c * max(rows, 1)), "elasticNetParam": 0.0, "standardization": False}


def module_lap_forest(cols: list[str], depth: int = 20) -> Pipeline:
    """The module's lap forest: 100 trees, all features, deep (see LAP_GRID)."""
    return Pipeline(stages=[_assembler(cols), DeepForest(
        numTrees=100, maxDepth=depth, featureSubsetStrategy="all", minInstancesPerNode=3, seed=SEED)])


def nb_estimators(cols: list[str]) -> dict[str, Pipeline]:
    """The notebook's three regressors."""
    a = _assembler(cols)
    return {
        "nb_linear": Pipeline(stages=[a, LinearRegression(solver="normal", regParam=0.0)]),
        "nb_forest": Pipeline(stages=[a, LevelForest(
            numTrees=50, maxDepth=10, featureSubsetStrategy="sqrt", minInstancesPerNode=min_instances(5), seed=SEED)]),
        "nb_gbt": Pipeline(stages=[a, BoostedTrees(
            maxIter=50, stepSize=0.1, maxDepth=5, subsamplingRate=0.8, minInstancesPerNode=min_instances(10), seed=SEED)]),
    }


def lap_estimators(cols: list[str]) -> dict[str, Pipeline]:
    a = _assembler(cols)
    return {
        "lap_linear": Pipeline(stages=[a, LinearRegression(solver="normal", regParam=0.0)]),
        # the notebook's forest (50 trees, depth 10, sqrt features); the module's is module_lap_forest
        "lap_forest": Pipeline(stages=[a, LevelForest(
            numTrees=50, maxDepth=10, featureSubsetStrategy="sqrt",
            minInstancesPerNode=min_instances(5), seed=SEED)]),
        "lap_gbt": Pipeline(stages=[a, BoostedTrees(
            maxIter=50, stepSize=0.1, maxDepth=5, subsamplingRate=0.8,
            minInstancesPerNode=min_instances(10), seed=SEED)]),
    }


def fit_all(estimators: dict[str, Pipeline], train: DataFrame) -> dict[str, PipelineModel]:
    """Fit pipelines of one assembler; those of packed rows share them."""
    assembler = next(iter(estimators.values())).getStages()[0]
    rows, packed, fitted = assembler.transform(train), None, {}
    for name, pipeline in estimators.items():
        last = pipeline.getStages()[-1]
        if isinstance(last, (LevelForest, BoostedTrees)):
            packed = packed or Packed(rows)
            model = last.fit_on(packed)
        else:
            model = last.fit(rows)
        fitted[name] = PipelineModel([assembler, model])
    return fitted


def podium_estimators(cols: list[str], rows: int | None = None) -> dict[str, Pipeline]:
    """``rows``: training rows, for the L2 penalty of C = 1 (None: no penalty)."""
    a = _assembler(cols)
    penalty = l2(rows) if rows else {}
    return {
        "podium_logistic": Pipeline(stages=[a, LogisticRegression(maxIter=100, weightCol="weight", **penalty)]),
        "podium_forest": Pipeline(stages=[a, DeepForest(
            numTrees=100, maxDepth=MAX_DEPTH_NONE, minInstancesPerNode=min_instances(5),
            weightCol="weight", seed=SEED, binary=True)]),
    }


def pole_estimators(cols: list[str], rows: int | None = None) -> dict[str, Pipeline]:
    """``rows``: training rows, for the L2 penalty of C = 1 (None: no penalty)."""
    a = _assembler(cols)
    return {
        # one binary fit per driver class, as the reference's solver does
        "pole_one_vs_rest": Pipeline(stages=[a, OneVsRest(
            classifier=LogisticRegression(maxIter=100, **(l2(rows) if rows else {})), parallelism=4)]),
        # one multinomial fit for all classes
        "pole_logistic": Pipeline(stages=[a, LogisticRegression(
            family="multinomial", maxIter=100)]),
        "pole_forest": Pipeline(stages=[a, RandomForestClassifier(
            numTrees=100, maxDepth=10, minInstancesPerNode=min_instances(5),
            weightCol="weight", seed=SEED)]),
    }


# --- transform helpers ----------------------------------------------------------------------

def with_probability(pred: DataFrame) -> DataFrame:
    """Positive-class probability and boolean prediction."""
    return pred.withColumn("p", vector_to_array("probability").getItem(1)) \
               .withColumn("predicted", F.col("prediction") == 1.0)


def decode_pole(pred: DataFrame, features: FeatureModel) -> DataFrame:
    """Predicted code -> driverId through the codes that the fitted features hold."""
    codes = features.decoder(pred, "driverId").select(F.col("code").cast("double").alias("prediction"),
                                                      F.col("value").alias("predicted_driverId"))
    return pred.join(codes, "prediction", "left")  # one row per pole winner


def regression_scores(pred: DataFrame, model: str) -> DataFrame:
    d = F.col("prediction") - F.col("label")
    return pred.agg(F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"),
                    F.count(F.lit(1)).cast("bigint").alias("n")).select(
        F.lit(model).alias("model"), "mse", "mae", "n")


def model_comparison(preds: dict[str, DataFrame], base: str = "lap_linear") -> DataFrame:
    """Test MSE per model and improvement over the linear model."""
    rows = None
    for name, p in preds.items():
        r = regression_scores(p, name)
        rows = r if rows is None else rows.unionByName(r)
    # one row per model: a frame over the whole (tiny) table
    linear = F.max(F.when(F.col("model") == base, F.col("mse"))).over(Window.partitionBy())
    return rows.withColumn("improvement_over_linear", linear - F.col("mse"))


def model_features(model: PipelineModel) -> list[str]:
    """The features a model was fitted on, in order, as its assembler names them."""
    return next(s for s in model.stages if isinstance(s, VectorAssembler)).getInputCols()


def feature_importance(model: PipelineModel, spark) -> DataFrame:
    """Importances (forests) or coefficients (logistic, one row per class), sorted."""
    last, cols = model.stages[-1], model_features(model)
    if hasattr(last, "featureImportances"):
        rows = [("importance", None, c, float(v)) for c, v in zip(cols, last.featureImportances.toArray(), strict=True)]
    elif hasattr(last, "models"):  # one-vs-rest
        rows = [("coefficient", k, c, float(v)) for k, m in enumerate(last.models)
                for c, v in zip(cols, m.coefficients.toArray(), strict=True)]
    elif getattr(last, "numClasses", 0) > 2:
        matrix = last.coefficientMatrix.toArray()
        rows = [("coefficient", k, c, float(v)) for k in range(len(matrix)) for c, v in zip(cols, matrix[k], strict=True)]
    else:
        rows = [("coefficient", None, c, float(v)) for c, v in zip(cols, last.coefficients.toArray(), strict=True)]
    df = spark.createDataFrame(rows, "kind string, class int, feature string, value double")
    return df.select("feature", "value", "kind", "class").orderBy("class", F.col("value").desc())


# --- tuning ----------------------------------------------------------------------------------

def grid_points(grid: dict[str, list]) -> list[dict]:
    """All combinations of a grid {parameter name: values}."""
    return [dict(zip(grid, values, strict=True)) for values in itertools.product(*grid.values())]


class Tuned:
    """A tuned model: the mean metric of every point, the refitted model, the test rows and the features."""

    def __init__(self, points: list[dict], metrics: list[float], larger_is_better: bool, test: DataFrame, model: PipelineModel,
                 features: FeatureModel) -> None:
        self.points, self.metrics, self.test, self.model, self.features = points, metrics, test, model, features
        self.best = best_of(metrics, larger_is_better)

    def params(self, i: int) -> str:
        return ", ".join(f"{k}={v}" for k, v in sorted(self.points[i].items()))

    def fitted_params(self) -> str:
        """The tuned parameters as the refitted model itself states them."""
        stage = self.model.stages[-1]
        return ", ".join(f"{k}={stage.getOrDefault(k)}" for k in sorted(self.points[self.best]))


def best_of(metrics: list[float], larger_is_better: bool) -> int:
    return (max if larger_is_better else min)(range(len(metrics)), key=lambda i: metrics[i])


def search_folder(t: RaceTables, name: str, cols: list[str]) -> str:
    """Where a search on this input, these features and seasons keeps its finished units, for every application."""
    setting = hashlib.md5(repr((cols, TRAIN, SEED, VERSION)).encode()).hexdigest()[:8]
    return os.path.join(shared_root(t.spark), "search", f"{name}-{model_stamp(t)}-{setting}")


def model_stamp(t: RaceTables) -> str:
    """What a stored model or a finished unit of a search was fitted on."""
    return f"{input_stamp(t.spark, t.sf_dir, INPUTS)}-{VERSION}"


def tune(t: RaceTables, name: str, data: Prepared, train: DataFrame, make, grid: dict[str, list], evaluator,
         nested: tuple[str, ...] = ()) -> Tuned:
    """Two-fold cross validation over ``grid`` with a deterministic fold column, unit by
    unit (see :mod:`pitwall.plans.search`), then a refit on all training rows with the best point."""
    train = in_tasks(train)
    points = grid_points(grid)
    metrics = Search(t.spark, search_folder(t, name, data.cols)).run(train, make, points, evaluator, nested=nested)
    best = best_of(metrics, evaluator.isLargerBetter())
    return Tuned(points, metrics, evaluator.isLargerBetter(), data.test, make(points[best]).fit(train), data.features)


def _tune_classes(t: RaceTables, family: str, name: str, grid: dict[str, list], evaluator, forest,
                  nested: tuple[str, ...] = ()) -> Tuned:
    data = prepared(t, family, weighted=True)
    train = stratified_kfold2(data.train, "label", ["season", "round", "driverId"])
    return tune(t, name, data, train, lambda p: Pipeline(stages=[_assembler(data.cols), forest(p)]), grid, evaluator,
                nested)


def tune_podium_forest(t: RaceTables, grid: dict[str, list] = CLASS_GRID) -> Tuned:
    # numBins = 0: the exact area, however many distinct scores there are
    return _tune_classes(t, "podium", "podium_forest", grid, BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0),
                         lambda p: DeepForest(seed=SEED, binary=True, **p), DeepForest.nested)


def tune_pole_forest(t: RaceTables, grid: dict[str, list] = CLASS_GRID) -> Tuned:
    # Spark's "f1" is weighted by support
    return _tune_classes(t, "pole", "pole_forest", grid, MulticlassClassificationEvaluator(metricName="f1"),
                         lambda p: RandomForestClassifier(seed=SEED, **DEEP, **p))


def tune_lap_forest(t: RaceTables, grid: dict[str, list] = LAP_GRID) -> Tuned:
    data = prepared(t, "lap")
    train = kfold2(data.train, ["season", "round", "driverId", "lap"])
    return tune(t, "lap_forest", data, train, lambda p: Pipeline(stages=[_assembler(data.cols), DeepForest(
        featureSubsetStrategy="all", seed=SEED, **p)]), grid, RegressionEvaluator(metricName="mse"), DeepForest.nested)


TUNERS = {"lap": tune_lap_forest, "pole": tune_pole_forest, "podium": tune_podium_forest}
_TUNED: dict[tuple[str, str, str], Tuned] = {}


def tuned(t: RaceTables, family: str) -> Tuned:
    """The tuned model of a family, fitted once per application and input, and saved (S17) with its
    parameters and metric."""
    stamp = model_stamp(t)
    key = (t.spark.sparkContext.applicationId, stamp, family)
    if key not in _TUNED:
        found = _TUNED[key] = TUNERS[family](t)
        ModelRegistry(t.spark).save(complete(found.features, found.model), f"tuned_{family}", stamp,
                                    found.points[found.best], {"cv": found.metrics[found.best]})
    return _TUNED[key]


def tuning_table(found: Tuned, name: str, spark) -> DataFrame:
    """One row per parameter map with its mean fold metric; the best is flagged."""
    rows = [(name, found.params(i), float(m), i == found.best) for i, m in enumerate(found.metrics)]
    return spark.createDataFrame(rows, "model string, params string, metric double, best boolean")


def training_summary(t: RaceTables) -> DataFrame:
    """Tune, refit, score on the test seasons and save all three models."""

    def line(family: str, metrics: DataFrame) -> DataFrame:
        found = tuned(t, family)
        return metrics.select(F.lit(family).alias("model"), F.lit(found.fitted_params()).alias("best_params"), "metric", "value")

    lap, pole, podium = (tuned(t, f) for f in ("lap", "pole", "podium"))
    laps = regression_scores(lap.model.transform(lap.test), "lap")
    laps = laps.select(F.explode(F.create_map(F.lit("test_mse"), "mse", F.lit("test_mae"), "mae")).alias("metric", "value"))
    poles = ev.accuracy(pole.model.transform(pole.test), "label", "prediction").select(
        F.lit("test_accuracy").alias("metric"), F.col("accuracy").alias("value"))
    scored = with_probability(podium.model.transform(podium.test))
    podiums = ev.accuracy(scored, "on_podium", "predicted").select(
        F.lit("test_accuracy").alias("metric"), F.col("accuracy").alias("value")).unionByName(
        ev.roc_auc(scored, "on_podium", "p").select(F.lit("test_roc_auc").alias("metric"), F.col("roc_auc").alias("value")))
    return line("lap", laps).unionByName(line("pole", poles)).unionByName(line("podium", podiums))


# --- stored models (S17, S18) ---------------------------------------------------------------

def trained_podium_model(t: RaceTables, name: str = "podium_forest") -> PipelineModel:
    """The latest saved podium model for this input, features included; fitted and saved first if
    there is none yet (train once, then every report loads the latest, in any application)."""
    registry, stamp = ModelRegistry(t.spark), model_stamp(t)
    try:
        return registry.latest(name, stamp)
    except FileNotFoundError:
        data = prepared(t, "podium", weighted=True)
        train = in_tasks(data.train)
        fitted = podium_estimators(data.cols, train.count())[name].fit(train)
        registry.save(complete(data.features, fitted), name, stamp, {"seasons": TRAIN})
        return registry.latest(name, stamp)


def score_podium(model: PipelineModel, t: RaceTables, seasons: list[int], latest_round: bool = False) -> DataFrame:
    """A stored model on the entries of some seasons (or of their last races): no training row is read."""
    rows = ft.podium_inputs(t).filter(F.col("season").isin(list(seasons)))
    if latest_round:
        last = t.races.filter(F.col("season").isin(list(seasons))).groupBy("season").agg(F.max("round").alias("round"))
        rows = rows.join(last, ["season", "round"], "left_semi")
    return with_probability(model.transform(rows))


def podium_test_predictions(t: RaceTables, name: str = "podium_forest") -> DataFrame:
    return score_podium(trained_podium_model(t, name), t, TEST)
