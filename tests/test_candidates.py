"""The pole as a choice: weights against a plain optimiser, chances per race, odd races."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pitwall.plans import candidates as cd
from pitwall.plans import evaluate as ev
from pitwall.plans.base_tables import RaceTables

SF = "/root/testdata/sf0.001"
SCHEMA = "season int, round int, driverId string, a double, b double, is_pole boolean"


@pytest.fixture(scope="module")
def races(spark):
    rnd, rows = random.Random(3), []
    for r in range(120):
        field = [(2000 + r % 3, r, f"D{k}", rnd.gauss(0, 2), None if rnd.random() < 0.2 else rnd.gauss(5, 1)) for k in range(rnd.randint(2, 9))]
        score = [1.5 * f[3] - (f[4] or 5.0) + rnd.gauss(0, 1) for f in field]
        rows += [(*f, s == max(score)) for f, s in zip(field, score)]
    rows += [(2009, 1, "D1", 0.0, 0.0, False), (2009, 2, "D1", 0.0, 0.0, True), (2009, 2, "D2", 0.0, 0.0, True)]  # no pole, two poles
    return rows


def plain(rows):
    """The same likelihood by gradient steps in numpy."""
    x = np.array([[np.nan if v is None else v for v in r[3:5]] for r in rows], float)
    mean, scale = np.nanmean(x, axis=0), np.nanstd(x, axis=0)
    z = np.clip((x - mean) / scale, -cd.REACH, cd.REACH)
    z = np.column_stack((np.nan_to_num(z), np.isnan(x).any(axis=1)))
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(r[:2], []).append(i)
    groups = [g for g in groups.values() if sum(rows[i][5] for i in g) == 1]
    w = np.zeros(3)
    for _ in range(4000):
        g = -cd.RIDGE * w
        for ids in groups:
            e = np.exp(z[ids] @ w)
            own = next(i for i in ids if rows[i][5])
            g += z[own] - (e / e.sum()) @ z[ids]
        w += 0.02 * g
    return w


def test_weights_maximise_the_likelihood(spark, races):
    df = spark.createDataFrame(races, SCHEMA).repartition(5)
    choice = cd.fit(df, ["a", "b"])
    assert np.allclose(choice.weights, plain(races), atol=2e-3)
    chances = choice.chances(df)
    assert all(abs(r["t"] - 1) < 1e-9 for r in chances.groupBy("season", "round").agg(F.sum("p").alias("t")).collect())
    called = choice.poles(df)
    assert called.count() == df.select("season", "round").distinct().count()
    assert called.filter("season < 2009").agg(F.avg(F.col("is_pole").cast("int"))).first()[0] > 0.7


def test_nothing_to_learn(spark, races):
    df = spark.createDataFrame(races, SCHEMA)
    choice = cd.fit(df.limit(0), ["a", "b"])
    assert not choice.weights.any()
    assert choice.poles(df.filter("season = 2009")).orderBy("round").select("driverId").collect()[1]["driverId"] == "D1"
    constant = df.withColumn("a", F.lit(1.0)).withColumn("b", F.lit(None).cast("double"))
    assert np.allclose(cd.fit(constant, ["a", "b"]).weights, 0)


def test_no_feature_knows_the_race(spark):
    """The form of a season's candidates does not change when that season's results do."""
    t = RaceTables(spark, SF)
    rows = cd.candidates(t)
    assert set(rows.columns) - {"season", "round", "driverId", "constructorId", "is_pole"} == set(cd.FORM)
    per = rows.groupBy("season", "driverId").agg(*[F.countDistinct(c).alias(c) for c in ("driver_prev_season_points", "prev_season_qualifying")])
    assert per.filter("driver_prev_season_points > 1 or prev_season_qualifying > 1").count() == 0
    assert rows.groupBy("season", "round").agg(F.count_if("is_pole").alias("n")).filter("n <> 1").count() == 0


def test_the_report_names_classes_by_code(spark):
    df = spark.createDataFrame([(0, 0), (0, 2), (2, 2), (-1, 2), (2, 0)], "y int, p int")
    names = spark.createDataFrame([(0, "x"), (1, "never"), (2, "z")], "code int, name string")
    got = {r["name"]: (round(r["precision"], 4), round(r["recall"], 4), r["support"]) for r in ev.named_report(df, "y", "p", names).collect()}
    assert got == {"x": (0.5, 0.5, 2), "never": (0.0, 0.0, 0), "z": (0.3333, 0.5, 2), "macro avg": (0.2778, 0.3333, 4),
                   "weighted avg": (0.4167, 0.5, 4)}
