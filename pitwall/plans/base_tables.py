"""Composed base tables (C1-C3), one DataFrame plan each, for all seasons at once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators import joins
from pitwall.sources import conform
from pitwall.sources import fixtures as fx

# column order of each conformed table (partition columns come back last)
_COLUMNS = {
    "laps": ["season", "round", "driverId", "constructorId", "lap", "lap_ms", "is_pit", "qty",
             "disc", "tax"],
    "lap_times": ["season", "round", "driverId", "lap", "position", "time"],
    "pit_stops": ["season", "round", "driverId", "lap", "stop", "duration"],
    "qualifying": ["season", "round", "driverId", "constructorId", "position", "q1", "q2", "q3"],
    "race_results": ["season", "round", "driverId", "constructorId", "position", "points", "laps"],
    "driver_standings": ["season", "driverId", "points", "wins", "position"],
    "constructor_standings": ["season", "constructorId", "points", "wins", "position"],
    "weather": ["season", "round", "mean_temp", "precipitation_sum", "windspeed_mean"],
    "races": ["season", "round", "raceName", "circuitId"],
}


class RaceTables:
    """The race-shaped inputs of one dataset.

    ``conformed=True`` (default) reads the conformed Parquet tables, built
    once per application (see :mod:`pitwall.sources.conform`);
    ``conformed=False`` derives each view from the given tables inside the
    query's own plan.
    """

    def __init__(self, spark: SparkSession, sf_dir: str, conformed: bool = True):
        self.spark, self.sf_dir, self.conformed = spark, sf_dir, conformed
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in fx.VIEWS:
            raise AttributeError(name)
        if name not in self._cache:
            if self.conformed:
                df = conform.read(self.spark, self.sf_dir, name).select(
                    *_COLUMNS.get(name, ["*"]))
            elif name == "lap_times":
                df = fx.lap_times_from(self.laps)
            elif name == "pit_stops":
                df = fx.pit_stops_from(self.laps)
            else:
                df = fx.VIEWS[name](self.spark, self.sf_dir)
            self._cache[name] = df
        return self._cache[name]


def race_days(races: DataFrame) -> DataFrame:
    """Races with ``date`` and ``time_race_start``; where the table has none, the day of the
    fixtures (the month's first, at midnight UTC)."""
    out = races
    if "date" not in races.columns:
        out = out.withColumn("date", F.make_date("season", "round", F.lit(1)))
    if "time_race_start" not in races.columns:
        out = out.withColumn("time_race_start", F.lit("00:00:00Z"))
    return out


def lap_base(t: RaceTables, dated: bool = False) -> DataFrame:
    """C1 = J1 + J2 + J3 + J4: laps with race, circuit, pit and weather columns.

    ``dated`` carries the race's date and start time too.
    """
    more = ["date", "time_race_start"] if dated else []
    df = joins.join_races(t.lap_times, race_days(t.races) if dated else t.races, ["circuitId", "raceName", *more])
    df = joins.join_circuits(df, t.circuits)
    df = joins.pit_marker(df, t.pit_stops)
    return joins.join_weather(df, t.weather)


def pole_sitters(t: RaceTables) -> DataFrame:
    """Qualifying position 1, with q3 as the pole lap text and grid 1."""
    q = t.qualifying.filter(F.col("position") == 1)
    return q.select("season", "round", "driverId", "constructorId",
                    fx.format_ms(F.col("q3")).alias("pole_lap_time"),
                    F.lit(1).alias("grid"))


def pole_base(t: RaceTables) -> DataFrame:
    """C2 = P7 + J5 + J6 + J7 + J4."""
    df = joins.join_races(pole_sitters(t), t.races, ["circuitId", "raceName"])
    df = joins.join_prev_season(df, t.driver_standings, "driverId", "driver")
    df = joins.join_prev_season(df, t.constructor_standings, "constructorId", "constructor")
    return joins.join_weather(df, t.weather)


def podium_label(position) -> F.Column:
    """Finishing position in {1,2,3}; text that is not a number -> False."""
    pos = position.try_cast("double")
    return F.coalesce(pos.isin(1, 2, 3), F.lit(False))


def results_join_qualifying(t: RaceTables) -> DataFrame:
    """Grid := qualifying position; qualifying times as text columns."""
    q = t.qualifying.select(
        "season", "round", "driverId",
        F.col("position").cast("double").alias("grid"),
        fx.format_ms(F.col("q1")).alias("qual_q1"),
        fx.format_ms(F.col("q2")).alias("qual_q2"),
        fx.format_ms(F.col("q3")).alias("qual_q3"))
    return joined_grid(t.race_results, q)


def joined_grid(results: DataFrame, qualifying: DataFrame) -> DataFrame:
    """J8 on plain frames: the results' own starting grid, if there is one, stays as
    ``grid_official`` (D5), and ``grid`` is the qualifying position."""
    r = results.withColumn("on_podium", podium_label(F.col("position")))
    if "grid" in r.columns:
        r = r.withColumnRenamed("grid", "grid_official")
    return joins.left_join(r, qualifying, ["season", "round", "driverId"])


def podium_base(t: RaceTables) -> DataFrame:
    """C3 = P8 + J8 + J9 + J6 + J7 + J4: one row per (race, driver) entry."""
    df = results_join_qualifying(t)
    df = joins.join_races(df, t.races, ["circuitId", "raceName"])
    df = joins.join_prev_season(df, t.driver_standings, "driverId", "driver")
    df = joins.join_prev_season(df, t.constructor_standings, "constructorId", "constructor")
    return joins.join_weather(df, t.weather)
