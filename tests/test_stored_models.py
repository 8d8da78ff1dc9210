"""Models and fitted features outlive their application; a folder without manifest is no model."""

import os
import shutil
import subprocess
import sys
import textwrap

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from pitwall.plans import features as ft
from pitwall.plans.fitted import FeatureFitter, FeatureModel
from pitwall.plans.registry import ModelRegistry

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def rows(spark):
    data = [(1, "K1", 1.0, None, 5.0, True), (1, "K2", None, None, 6.0, False), (2, "K3", 3.0, None, None, True), (2, None, 4.0, None, 8.0, True)]
    return spark.createDataFrame(data, "season int, circuitId string, grid double, mean_temp double, y double, flag boolean")


def fitter(**more):
    return FeatureFitter(categories={"circuitId": "code"}, numeric=["grid", "mean_temp"],
                         wanted=["code", "grid", "mean_temp", "flag", "absent"], label="y", keep=["season", "circuitId"], **more)


def test_the_stage_does_what_the_plan_does(rows):
    for scope in ("batch", [1]):
        model = fitter().fit(rows if scope == "batch" else rows.filter("season = 1"))
        want = ft.fitted_features(rows, scope, {"circuitId": "code"}, ["grid", "mean_temp"], ["code", "grid", "mean_temp", "flag"], "y")
        got = model.transform(rows)
        assert got.columns == ["season", "circuitId", "code", "grid", "mean_temp", "flag", "y"]
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))
        assert model.usable == ["code", "grid", "flag"]


def test_a_stage_is_saved_and_loaded_whole(spark, rows, tmp_path):
    model = fitter().fit(rows.filter("season = 1"))
    PipelineModel(stages=[model]).write().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m")).stages[0]
    assert isinstance(again, FeatureModel) and again.uid == model.uid
    assert (again.medians, again.codes, again.usable) == (model.medians, model.codes, model.usable)
    assert again.explainParams() == model.explainParams()
    unlabelled = rows.drop("y")
    assert again.transform(unlabelled).count() == model.transform(unlabelled).count() == 4
    assert {r["code"]: r["value"] for r in again.decoder(rows, "circuitId").collect()} == {0: "K1", 1: "K2"}


def test_an_empty_table_can_be_fitted(rows):
    model = fitter().fit(rows.limit(0))
    assert (model.medians, model.codes) == ({}, {"circuitId": []})
    assert sorted(r["code"] for r in model.transform(rows).collect()) == [-1, -1, -1]  # a NULL grid has no median, and costs no row
    assert model.transform(rows.limit(0)).collect() == []


def test_versions_without_a_manifest_do_not_exist(spark, rows, tmp_path):
    registry = ModelRegistry(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        registry.latest("m")
    stages = [PipelineModel(stages=[fitter().fit(rows.filter(F.col("season") == s))]) for s in (1, 2)]
    first = registry.save(stages[0], "m", "a", {"depth": 3}, {"auc": 0.5})
    registry.save(stages[1], "m", "b")
    assert [m["stamp"] for m in registry.versions("m")] == ["a", "b"]
    assert registry.latest("m").stages[0].codes == stages[1].stages[0].codes
    assert registry.latest("m", "a").stages[0].codes == stages[0].stages[0].codes
    # a writer that died: a folder of a later version without manifest, and one whose manifest is cut short
    shutil.copytree(first, tmp_path / "m" / "99990101_000000_000000000-dead")
    (tmp_path / "m" / "99990101_000000_000000001.json").write_text('{"model": "m", "da')
    assert registry.latest("m").stages[0].codes == stages[1].stages[0].codes
    row = registry.table("m").filter("stamp = 'a'").first()
    assert (row["params"], row["metrics"]) == ({"depth": "3"}, {"auc": 0.5})


def run(script, *args):
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(script), *args], cwd=REPO, capture_output=True, text=True, timeout=300)
    assert done.returncode == 0, done.stderr[-3000:]
    return done.stdout


SESSION = """
import os, sys
from pitwall.session import build_session
spark = build_session("local[4]", 4, extra={"spark.checkpoint.dir": sys.argv[1], "spark.driver.memory": "3g"})
from pyspark.sql import functions as F
from pitwall.plans import models as md
from pitwall.plans.base_tables import RaceTables
"""


def test_train_in_one_application_and_score_in_another(tmp_path):
    """The second application has no training season and no race table of the first."""
    shared, data, later = str(tmp_path / "shared"), str(tmp_path / "sf"), str(tmp_path / "later")
    shutil.copytree("/root/testdata/sf0.001", data)
    os.chmod(data, 0o755)
    for name in os.listdir(data):
        os.chmod(os.path.join(data, name), 0o644)
    trained = run(SESSION + """
t = RaceTables(spark, sys.argv[2])
data = md.prepared(t, "podium", weighted=True)
model = md.complete(data.features, md.podium_estimators(data.cols, data.train.count())["podium_logistic"].fit(data.train))
from pitwall.plans.registry import ModelRegistry
ModelRegistry(spark).save(model, "podium_logistic", "x", {"seasons": md.TRAIN})
rows = md.score_podium(model, t, [2001]).select("round", "driverId", "p").orderBy("round", "driverId").collect()
for r in rows: print("ROW", r["round"], r["driverId"], repr(r["p"]))
# only the last two seasons go to the second application
import pyspark
for name in ("supplier", "nation"):
    spark.read.parquet(f"{sys.argv[2]}/{name}.parquet").write.parquet(f"{sys.argv[3]}/{name}.parquet")
orders = spark.read.parquet(f"{sys.argv[2]}/orders.parquet").filter(F.year("o_orderdate") >= 2000)
orders.write.parquet(f"{sys.argv[3]}/orders.parquet")
lines = spark.read.parquet(f"{sys.argv[2]}/lineitem.parquet")
lines.join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").select(*lines.columns).write.parquet(f"{sys.argv[3]}/lineitem.parquet")
""", shared, data, later)
    shutil.rmtree(data)
    scored = run(SESSION + """
from pitwall.plans.registry import ModelRegistry
t = RaceTables(spark, sys.argv[2])
model = ModelRegistry(spark).latest("podium_logistic", "x")
assert t.races.filter("season < 2000").count() == 0
rows = md.score_podium(model, t, [2001]).select("round", "driverId", "p").orderBy("round", "driverId").collect()
for r in rows: print("ROW", r["round"], r["driverId"], repr(r["p"]))
""", shared, later)
    lines = [x for x in trained.splitlines() if x.startswith("ROW")]
    assert lines and lines == [x for x in scored.splitlines() if x.startswith("ROW")]
