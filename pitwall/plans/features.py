"""Feature tables for the three models, in the reference's step order.

``scope`` decides which rows fit the category codes and medians:

* ``"batch"``: every row passed in (what the reference does when it
  preprocesses train and test together; SQL-checkable);
* a list of seasons: only rows of those seasons (no test leakage).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.functions.timing import qual_time_to_ms, time_to_ms
from pitwall.operators.aggregates import code_of, fit_statistics, impute, race_min, with_statistics
from pitwall.operators.windows import ENTRY, add_lags
from pitwall.plans.base_tables import RaceTables, lap_base, podium_base, pole_base
from pitwall.plans.fitted import FeatureFitter, known_rows

RACE = ["season", "round"]

LAP_LAGS = [f"normalized_lap_time_lag_{k}" for k in (1, 2, 3)]
WEATHER = ["mean_temp", "precipitation_sum", "windspeed_mean"]
LAP_X = ["lap", "position", "is_pit_stop_lap", "is_pit_exit_lap", *LAP_LAGS,
         "circuitId_code", *WEATHER]
LAP_Y = "normalized_lap_time"
LAP_IMPUTE = [*LAP_LAGS, *WEATHER]

PREV = [f"{who}_prev_season_{m}" for who in ("driver", "constructor")
        for m in ("points", "position", "wins")]
POLE_X = ["circuitId_code", *PREV[:3], "constructorId_code", *PREV[3:]]
POLE_Y = "driverId_code"

QUAL_MS = ["qual_q1_ms", "qual_q2_ms", "qual_q3_ms"]
PODIUM_X = ["grid", "circuitId_code", *PREV[:3], "constructorId_code", *PREV[3:],
            *QUAL_MS, *WEATHER]
PODIUM_Y = "on_podium"
PODIUM_IMPUTE = ["grid", *PREV, *WEATHER]


def _fit_rows(df: DataFrame, scope) -> DataFrame:
    if scope == "batch":
        return df
    return df.filter(F.col("season").isin(list(scope)))


def normalized_laps(t: RaceTables, parity: bool = False) -> DataFrame:
    """F1 + W3/A1/P14: lap ms and lap / race-fastest-lap (NULL when that is 0 or NULL).

    The race minimum is a partial aggregate of the lap times alone (one row per race),
    so the fact rows are never gathered per race.
    """
    ms = time_to_ms("time", parity)
    df = lap_base(t).withColumn("lap_time_milliseconds", ms)
    mins = race_min(t.lap_times.select(*RACE, ms.alias("__ms")), "__ms", "min_lap_time_race", RACE)
    df = df.join(mins, RACE, "left")
    m = F.col("min_lap_time_race")
    return df.withColumn(LAP_Y, F.when(m != 0, F.col("lap_time_milliseconds") / m))


def lap_series(t: RaceTables, parity: bool = False) -> DataFrame:
    """W1 + W2 on top of the normalisation, computed before the outlier filter."""
    df = normalized_laps(t, parity)
    lags = {LAP_Y: [(k, f"normalized_lap_time_lag_{k}") for k in (1, 2, 3)],
            "is_pit_stop_lap": [(1, "is_pit_exit_lap")]}
    return add_lags(df, lags, ENTRY, "lap",
                                fill={"is_pit_exit_lap": F.lit(False)})


def lap_outlier_filter(df: DataFrame, limit: float = 1.5) -> DataFrame:
    """P10: keep laps within ``limit`` x the race's fastest (drops NULL)."""
    return df.filter(F.col(LAP_Y).isNotNull() & (F.col(LAP_Y) <= limit))


def complete_cases(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a NULL in any of ``cols``."""
    return df.na.drop(how="any", subset=cols)


def feature_guard(df: DataFrame, wanted: list[str]) -> list[str]:
    """The wanted feature names that exist in the frame (plan-time check)."""
    return [c for c in wanted if c in df.columns]


def fitted_features(df: DataFrame, scope, codes: dict[str, str], numeric: list[str],
                    wanted: list[str], label: str) -> DataFrame:
    """Fit codes and medians in one row, apply them, and keep the complete rows, in one plan.

    A feature that is NULL in all fit rows has no median: it stays NULL, and
    costs no row (D3); :func:`usable_features` names the others.
    ``codes`` maps category columns to code columns.
    """
    fitted = fit_statistics(_fit_rows(df, scope), numeric, list(codes))
    df = with_statistics(df, fitted).withColumns({out: code_of(c) for c, out in codes.items()})
    cols = feature_guard(df, wanted)
    return known_rows(df.withColumns(impute(numeric)), cols, numeric, label).drop("medians", "codes")


def usable_features(df: DataFrame, cols: list[str]) -> list[str]:
    """The columns with any value, in order: what a model can be fitted on (one small aggregate)."""
    row = df.agg(*[F.count(F.col(c)).alias(c) for c in cols]).first()
    return [c for c in cols if row[c]] or list(cols)


@dataclass(frozen=True)
class Recipe:
    """One model family's features: its rows before anything is fitted, and what is fitted on them."""

    inputs: Callable[..., DataFrame]
    codes: dict[str, str]
    numeric: list[str]
    wanted: list[str]
    label: str
    keep: list[str]

    def fitter(self) -> FeatureFitter:
        """The recipe as a Spark ML stage, to be fitted on training rows and saved with a model."""
        return FeatureFitter(categories=self.codes, numeric=self.numeric, wanted=self.wanted, label=self.label, keep=self.keep)

    def features(self, t: RaceTables, scope, **options) -> DataFrame:
        """The features with codes and medians fitted on the rows of ``scope``, in one plan."""
        df = fitted_features(self.inputs(t, **options), scope, self.codes, self.numeric, self.wanted, self.label)
        return df.select(*dict.fromkeys([*self.keep, *feature_guard(df, self.wanted), self.label]))


def lap_inputs(t: RaceTables, parity: bool = False) -> DataFrame:
    return lap_outlier_filter(lap_series(t, parity))


def pole_inputs(t: RaceTables) -> DataFrame:
    return pole_base(t)


def podium_inputs(t: RaceTables, parity: bool = False) -> DataFrame:
    return podium_base(t).withColumns({f"{q}_ms": qual_time_to_ms(q, parity) for q in ("qual_q1", "qual_q2", "qual_q3")})


RECIPES = {
    "lap": Recipe(lap_inputs, {"circuitId": "circuitId_code"}, LAP_IMPUTE, LAP_X, LAP_Y, ["season", "round", "driverId"]),
    "pole": Recipe(pole_inputs, {"driverId": POLE_Y, "circuitId": "circuitId_code", "constructorId": "constructorId_code"},
                   PREV, POLE_X, POLE_Y, ["season", "round", "driverId"]),
    "podium": Recipe(podium_inputs, {"circuitId": "circuitId_code", "constructorId": "constructorId_code"}, PODIUM_IMPUTE,
                     PODIUM_X, PODIUM_Y, ["season", "round", "raceName", "driverId", "constructorId", "position"]),
}


def lap_features(t: RaceTables, scope="batch", parity: bool = False) -> DataFrame:
    return RECIPES["lap"].features(t, scope, parity=parity)


def pole_features(t: RaceTables, scope="batch") -> DataFrame:
    return RECIPES["pole"].features(t, scope)


def podium_features(t: RaceTables, scope="batch", parity: bool = False) -> DataFrame:
    return RECIPES["podium"].features(t, scope, parity=parity)
