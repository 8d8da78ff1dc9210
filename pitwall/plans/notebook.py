"""The notebook's second lap-feature recipe.

Differences from the module recipe, kept on purpose: races keyed by one
integer ``raceId``; the outlier filter runs *before* the lags; first laps
are dropped instead of imputed; two lags instead of three.  The pit-exit
flag is a lag *within* (race, driver): the notebook's ungrouped shift leaks
a previous driver's pit lap into the next driver's first lap (D7).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.operators.joins import indicator_join
from pitwall.operators.windows import add_lags
from pitwall.plans.base_tables import RaceTables

NB_ENTRY = ["raceId", "driverId"]
NB_FEATURES = ["circuitId", "lap", "is_pit_stop", "is_pit_exit", "lag_1", "lag_2"]


def race_id(season="season", rnd="round"):
    return (F.col(season) * 100 + F.col(rnd)).cast("int")


def nb_lap_times(t: RaceTables) -> DataFrame:
    return t.laps.select(race_id().alias("raceId"), "driverId", "lap",
                         F.col("lap_ms").alias("milliseconds"))


def nb_races(t: RaceTables) -> DataFrame:
    return t.races.select(race_id().alias("raceId"),
                          F.substring("circuitId", 2, 10).cast("int").alias("circuitId"))


def nb_pit_stops(t: RaceTables) -> DataFrame:
    return t.pit_stops.select(race_id().alias("raceId"), "driverId", "lap")


def nb_join_races(t: RaceTables) -> DataFrame:
    """Laps left-join races on raceId (one row per race)."""
    return nb_lap_times(t).join(nb_races(t), "raceId", "left")


def nb_normalized(t: RaceTables) -> DataFrame:
    """A1: milliseconds / race minimum (race minimum as an aggregate, joined back)."""
    df = nb_join_races(t)
    mins = nb_lap_times(t).groupBy("raceId").agg(F.min("milliseconds").alias("race_min"))
    df = df.join(mins, "raceId", "left")
    return df.withColumn("normalized_time",
                         F.col("milliseconds") / F.col("race_min")).drop("race_min")


def nb_pit_indicator(t: RaceTables) -> DataFrame:
    """Matched-row indicator against the pit stops."""
    return indicator_join(nb_normalized(t), nb_pit_stops(t), ["raceId", "driverId", "lap"],
                          "is_pit_stop")


def nb_pit_exit(t: RaceTables) -> DataFrame:
    """W5 (partitioned, see module docstring)."""
    return add_lags(nb_pit_indicator(t), {"is_pit_stop": [(1, "is_pit_exit")]},
                                NB_ENTRY, "lap", fill={"is_pit_exit": F.lit(False)})


def nb_lap_lags(t: RaceTables, limit: float = 1.5) -> DataFrame:
    """Filter to <= limit first, then lags 1 and 2, then drop incomplete rows."""
    df = nb_pit_exit(t).filter(F.col("normalized_time") <= limit)
    df = add_lags(df, {"normalized_time": [(1, "lag_1"), (2, "lag_2")]},
                              NB_ENTRY, "lap")
    df = df.na.drop(subset=NB_FEATURES + ["normalized_time"])
    return df.select("raceId", "driverId", *NB_FEATURES, "normalized_time")
