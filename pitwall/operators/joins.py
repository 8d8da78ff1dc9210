"""Join operators (J1-J14).  Every reference join is an equi left outer join.

Broadcast policy: no side is hinted.  The optimizer broadcasts a side whose
size it knows to be small, AQE does after it has measured the side at run
time, and otherwise the shuffle join stays (with skew splitting enabled).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def left_join(fact: DataFrame, dim: DataFrame, keys: list[str]) -> DataFrame:
    """Plain left join on equal-named keys."""
    overlap = (set(fact.columns) & set(dim.columns)) - set(keys)
    if overlap:
        raise ValueError(f"ambiguous columns after join: {sorted(overlap)}")
    return fact.join(dim, on=keys, how="left")


def join_races(fact: DataFrame, races: DataFrame, carry: list[str]) -> DataFrame:
    """Attach race attributes on (season, round)."""
    return left_join(fact, races.select("season", "round", *carry), ["season", "round"])


def one_per_circuit(circuits: DataFrame) -> DataFrame:
    """One row per circuitId: of a per-season table the latest season's row (ties: smallest values)."""
    others = [c for c in circuits.columns if c not in ("circuitId", "season")]
    row = F.struct(*[F.col(c) for c in others])
    if "season" in circuits.columns:
        row = F.struct((-F.col("season")).alias("__latest"), *[F.col(c) for c in others])
    best = circuits.groupBy("circuitId").agg(F.min(row).alias("__row"))
    return best.select("circuitId", *[F.col(f"__row.{c}").alias(c) for c in others])


def join_circuits(fact: DataFrame, circuits: DataFrame) -> DataFrame:
    """Attach circuit attributes by circuitId; a circuit listed in several seasons
    counts once, so no row of ``fact`` is repeated."""
    return left_join(fact, one_per_circuit(circuits), ["circuitId"])


def pit_marker(laps: DataFrame, pit_stops: DataFrame) -> DataFrame:
    """Flag pit laps; stop -> 0 and duration -> NULL on other laps.

    Keys are the four typed columns (no string key).  Two stops on one lap
    give two rows, as a left join does.
    """
    keys = ["season", "round", "driverId", "lap"]
    marks = pit_stops.select(*keys, "stop", F.col("duration").alias("duration_pitstop"),
                             F.lit(True).alias("is_pit_stop_lap"))
    j = laps.join(marks, on=keys, how="left")
    return j.withColumns({
        "is_pit_stop_lap": F.coalesce(F.col("is_pit_stop_lap"), F.lit(False)),
        "stop": F.coalesce(F.col("stop"), F.lit(0)),
    })


WEATHER_COLS = ["mean_temp", "precipitation_sum", "windspeed_mean"]


def join_weather(fact: DataFrame, weather: DataFrame) -> DataFrame:
    """Weather by (season, round).  Only the metric columns are carried, so
    a circuitId in the weather table cannot collide with the fact's."""
    w = weather.select("season", "round", *WEATHER_COLS)
    return left_join(fact, w, ["season", "round"])


def join_prev_season(fact: DataFrame, standings: DataFrame, key: str,
                     prefix: str) -> DataFrame:
    """Standings of the previous season, for all seasons in one join.

    The standings side is re-keyed to ``season + 1``; it is one row per
    (season, driver or team), so its size grows with the data and the join
    strategy is left to AQE.
    """
    prev = standings.select(
        (F.col("season") + 1).alias("season"), key,
        F.col("points").alias(f"{prefix}_prev_season_points"),
        F.col("position").alias(f"{prefix}_prev_season_position"),
        F.col("wins").alias(f"{prefix}_prev_season_wins"))
    return left_join(fact, prev, ["season", key])


def indicator_join(left: DataFrame, right: DataFrame, keys: list[str], flag: str) -> DataFrame:
    """Left join that only records whether a match exists."""
    marks = right.select(*keys).withColumn(flag, F.lit(True))
    j = left.join(marks, on=keys, how="left")
    return j.withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))
