"""Medians, codes and imputation against plain Python; all-NULL features cost no rows."""

import random
import statistics

from pyspark.sql import functions as F

from pitwall.operators import aggregates as ag
from pitwall.plans import features as ft


def test_medians_against_python(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, rnd.gauss(1, 0.1), rnd.gauss(-1e6, 1e5), 0.0, 1.5]), rnd.randint(-3, 3), None, 7.0) for _ in range(1001)]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").repartition(4)
    got = {r.column_name: r.median for r in ag.medians(df, ["a", "b", "c", "d"]).collect()}
    assert set(got) == {"a", "b", "d"}
    assert got["a"] == statistics.median([r[0] for r in rows if r[0] is not None])
    assert got["b"] == statistics.median([r[1] for r in rows]) and got["d"] == 7.0
    assert ag.medians(df.limit(0), ["a", "b"]).collect() == []


def test_an_all_null_feature_drops_no_row(spark):
    rows = [(2000, "K1", 1.0, None, 5.0), (2000, "K2", None, None, 6.0), (2001, "K3", 3.0, None, None), (2001, None, 4.0, None, 8.0)]
    df = spark.createDataFrame(rows, "season int, circuitId string, grid double, mean_temp double, y double")
    args = {"circuitId": "code"}, ["grid", "mean_temp"], ["code", "grid", "mean_temp", "absent"], "y"
    out = ft.fitted_features(df, "batch", *args)
    got = sorted(map(tuple, out.select("code", "grid", "mean_temp", "y").collect()))
    assert got == [(-1, 4.0, None, 8.0), (0, 1.0, None, 5.0), (1, 3.0, None, 6.0)]
    assert ft.usable_features(out, ["grid", "mean_temp"]) == ["grid"]
    train_only = ft.fitted_features(df, [2000], *args)
    assert sorted(r["code"] for r in train_only.collect()) == [-1, 0, 1]  # K3 is unseen, NULL too


def test_statistics_of_an_empty_table(spark):
    df = spark.createDataFrame([], "season int, circuitId string, grid double, y double")
    assert ft.fitted_features(df, "batch", {"circuitId": "code"}, ["grid"], ["code", "grid"], "y").collect() == []


def test_fitting_runs_no_job_while_building(spark):
    df = spark.range(10).select(F.col("id").cast("double").alias("grid"), F.lit(2000).alias("season"), F.lit("K").alias("circuitId"), F.lit(1.0).alias("y"))
    spark.sparkContext.setJobGroup("fit", "fit")
    try:
        ft.fitted_features(df, "batch", {"circuitId": "code"}, ["grid"], ["code", "grid"], "y")
        assert not list(spark.sparkContext.statusTracker().getJobIdsForGroup("fit"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
