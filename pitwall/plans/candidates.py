"""The pole as a choice among all entrants of a race.

Every entrant is a candidate, described by what is known before the race: the last season's
standings, qualifying positions and poles of driver and team.  (The parity recipe only has
rows of pole sitters, whose own standings are then the features.)  The chance of a pole is a
softmax over the race's candidates; its weights maximise the likelihood by Newton steps.  Each
step is one aggregation by race: sums of e^s, of e^s x and of e^s x x' combine map-side, so
that no race is gathered, and a few numbers per feature pair come back to the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitwall.operators.joins import join_prev_season, left_join
from pitwall.operators.windows import Key, top_k_per_group
from pitwall.plans.base_tables import RaceTables
from pitwall.session import cut_lineage

RACE = ["season", "round"]
FORM = [f"{who}_prev_season_{m}" for who in ("driver", "constructor") for m in ("points", "position", "wins")]
FORM += ["prev_season_qualifying", "prev_season_poles"]
#: Newton steps, and the ridge that keeps weights finite when one candidate is always right.
STEPS, RIDGE = 12, 1e-3
#: Standardised features and scores are kept within these bounds.
REACH, HIGHEST = 8.0, 30.0


def candidates(t: RaceTables) -> DataFrame:
    """One row per (race, entrant): its form of the last season and whether it took the pole."""
    q = t.qualifying
    last = q.groupBy((F.col("season") + 1).alias("season"), "driverId").agg(
        (F.sum("position") / F.count(F.lit(1))).alias("prev_season_qualifying"),
        F.count_if(F.col("position") == 1).alias("prev_season_poles"))
    df = q.select(*RACE, "driverId", "constructorId", (F.col("position") == 1).alias("is_pole"))
    df = join_prev_season(df, t.driver_standings, "driverId", "driver")
    df = join_prev_season(df, t.constructor_standings, "constructorId", "constructor")
    return left_join(df, last, ["season", "driverId"])


class Choice:
    """Weights of the standardised form; a missing value is the mean, and that one is missing is a feature."""

    def __init__(self, means: dict[str, float], scales: dict[str, float], weights: np.ndarray) -> None:
        self.means, self.scales, self.weights = means, scales, weights

    def features(self) -> list[Column]:
        near = [F.coalesce((F.col(c).cast("double") - m) / self.scales[c], F.lit(0.0)) for c, m in self.means.items()]
        known = [F.greatest(F.least(x, F.lit(REACH)), F.lit(-REACH)) for x in near]
        missing = [F.col(c).isNull().cast("double") for c in self.means]
        return known + [F.greatest(*missing, F.lit(0.0))]

    def score(self, features: list[Column] | None = None) -> Column:
        s = sum((F.lit(float(w)) * x for w, x in zip(self.weights, features or self.features(), strict=True)), F.lit(0.0))
        return F.greatest(F.least(s, F.lit(HIGHEST)), F.lit(-HIGHEST))

    def chances(self, df: DataFrame) -> DataFrame:
        """``df`` with the chance ``p`` of each candidate; the chances of a race add up to one."""
        scored = df.withColumn("__e", F.exp(self.score()))
        whole = scored.groupBy(*RACE).agg(F.sum("__e").alias("__z"))
        return left_join(scored, whole, RACE).withColumn("p", F.col("__e") / F.col("__z")).drop("__e", "__z")

    def poles(self, df: DataFrame) -> DataFrame:
        """One predicted pole per race (ties to the smaller driverId)."""
        return top_k_per_group(self.chances(df), RACE, [Key("p", desc=True), Key("driverId")], 1, "rank").drop("rank")


def _sums(rows: DataFrame, choice: Choice) -> tuple[np.ndarray, np.ndarray, float]:
    """Gradient and curvature of the log-likelihood, and the log-likelihood, added up over races with
    one pole; ``rows`` holds the features x0, x1, ..."""
    d = len(choice.weights)
    x = [F.col(f"x{i}") for i in range(d)]
    e = F.col("e")
    rows = rows.withColumn("e", F.exp(choice.score(x)))
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    races = rows.groupBy(*RACE).agg(
        F.sum(e).alias("z"), F.count_if("is_pole").alias("poles"), F.sum(F.when(F.col("is_pole"), F.log(e))).alias("own"),
        *[F.sum(e * x[i]).alias(f"m{i}") for i in range(d)],
        *[F.sum(F.when(F.col("is_pole"), x[i])).alias(f"y{i}") for i in range(d)],
        *[F.sum(e * x[i] * x[j]).alias(f"c{i}_{j}") for i, j in pairs]).filter("poles = 1")
    z = F.col("z")
    row = races.agg(
        F.sum(F.col("own") - F.log(z)).alias("likelihood"),
        *[F.sum(F.col(f"y{i}") - F.col(f"m{i}") / z).alias(f"g{i}") for i in range(d)],
        *[F.sum(F.col(f"c{i}_{j}") / z - F.col(f"m{i}") * F.col(f"m{j}") / (z * z)).alias(f"h{i}_{j}") for i, j in pairs]).first()
    curve = np.zeros((d, d))
    for i, j in pairs:
        curve[i, j] = curve[j, i] = row[f"h{i}_{j}"] or 0.0
    return np.array([row[f"g{i}"] or 0.0 for i in range(d)]), curve, row["likelihood"] or 0.0


def fit(df: DataFrame, cols: list[str] | None = None) -> Choice:
    """Maximum penalised likelihood on candidates with ``is_pole``; races without exactly one pole don't count."""
    cols = list(cols or FORM)
    one = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{c}") for c in cols],
                 *[F.stddev_pop(F.col(c).cast("double")).alias(f"s_{c}") for c in cols]).first()
    choice = Choice({c: one[f"m_{c}"] or 0.0 for c in cols}, {c: one[f"s_{c}"] or 1.0 for c in cols}, np.zeros(len(cols) + 1))
    rows = cut_lineage(df.select(*RACE, "is_pole", *[f.alias(f"x{i}") for i, f in enumerate(choice.features())]))

    def worth(at: Choice) -> tuple[np.ndarray, np.ndarray, float]:
        g, h, likelihood = _sums(rows, at)
        n = len(at.weights)
        return g - RIDGE * at.weights, h + RIDGE * np.eye(n), likelihood - RIDGE / 2 * float(at.weights @ at.weights)

    gradient, curve, value = worth(choice)
    for _ in range(STEPS):
        step = np.linalg.solve(curve, gradient)
        if np.abs(step).max() < 1e-8:
            break
        for _ in range(8):  # shorter, until it is better
            trial = Choice(choice.means, choice.scales, choice.weights + step)
            found = worth(trial)
            if found[2] >= value:
                choice, (gradient, curve, value) = trial, found
                break
            step = step / 4
        else:
            break
    return choice
