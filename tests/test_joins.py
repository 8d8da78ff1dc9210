"""Join semantics: fan-out on duplicate right keys, previous season, ambiguity guard."""

import pytest

from pitwall.operators import joins


def test_two_stops_on_one_lap_fan_out(spark):
    laps = spark.createDataFrame([(2000, 1, "D1", 1), (2000, 1, "D1", 2)],
                                 "season int, round int, driverId string, lap int")
    pits = spark.createDataFrame([(2000, 1, "D1", 2, 1, "20.1"), (2000, 1, "D1", 2, 2, "3.0")],
                                 "season int, round int, driverId string, lap int, stop int, duration string")
    out = joins.pit_marker(laps, pits).collect()
    assert len(out) == 3
    assert sorted((r["lap"], r["stop"], r["is_pit_stop_lap"]) for r in out) == \
        [(1, 0, False), (2, 1, True), (2, 2, True)]


def test_previous_season_for_all_seasons_in_one_join(spark):
    entries = spark.createDataFrame([(1996, "D1"), (1997, "D1"), (1997, "D2")],
                                    "season int, driverId string")
    st = spark.createDataFrame([(1996, "D1", 10.0, 1, 2)],
                               "season int, driverId string, points double, wins int, position int")
    got = {(r["season"], r["driverId"]): r["driver_prev_season_points"]
           for r in joins.join_prev_season(entries, st, "driverId", "driver").collect()}
    assert got == {(1996, "D1"): None, (1997, "D1"): 10.0, (1997, "D2"): None}


def test_weather_join_drops_colliding_columns(spark):
    fact = spark.createDataFrame([(2000, 1, "K1")], "season int, round int, circuitId string")
    w = spark.createDataFrame([(2000, 1, "K9", 20.0, 0.0, 5.0)],
                              "season int, round int, circuitId string, mean_temp double, "
                              "precipitation_sum double, windspeed_mean double")
    row = joins.join_weather(fact, w).first()
    assert row["circuitId"] == "K1" and row["mean_temp"] == 20.0
    with pytest.raises(ValueError):
        joins.left_join(fact, w, ["season", "round"])


def test_circuits_of_several_seasons_repeat_no_row(spark):
    laps = spark.createDataFrame([(2000, 1, "K1"), (2001, 1, "K1"), (2001, 2, None)], "season int, round int, circuitId string")
    circuits = spark.createDataFrame([(2000, "K1", "old", 1.0), (2001, "K1", "new", 2.0), (2001, "K1", "newer", 0.0)],
                                     "season int, circuitId string, circuitName string, lat double")
    got = sorted(map(tuple, joins.join_circuits(laps, circuits).select("season", "circuitId", "circuitName").collect()), key=str)
    assert got == [(2000, "K1", "new"), (2001, "K1", "new"), (2001, None, None)]


def test_weather_for_races_with_circuits_of_several_seasons(spark):
    from pitwall.sources.landed import weather_for_races
    races = spark.createDataFrame([(2000, 1, "K1", "2000-01-01T00:00:00Z"), (2000, 2, "K1", "not a day")],
                                  "season int, round int, circuitId string, date string")
    circuits = spark.createDataFrame([(1999, "K1", "1.001", "2.0"), (2000, "K1", "1.001", "2.0"), (2000, "K2", "x", "2.0")],
                                     "season int, circuitId string, lat string, long string")
    weather = spark.sql("select 1.0D as lat, 2.0D as long, date'2000-01-01' as date, 20.0D as mean_temp, "
                        "0.0D as precipitation_sum, 3.0D as windspeed_mean")
    assert [tuple(r)[:3] for r in weather_for_races(races, circuits, weather).collect()] == [(2000, 1, "K1")]


def test_date_forms(spark):
    from datetime import date

    from pitwall.sources.landed import clean_date
    texts = ["2024-03-02", "2024-03-02T15:00:00Z", "2024-03-02 15:00:00Z", " 2024-03-02 15:00 ", "2 Mar 2024", "02 March 2024",
             "Mar 2, 2024", "March 2, 2024", "2024/03/02", "20240302"]
    df = spark.createDataFrame([(t,) for t in [*texts, "2024-13-02", "soon", "", None, "2024-3-2x"]], "t string")
    got = {r["t"]: r["d"] for r in df.select("t", clean_date(df["t"]).alias("d")).collect()}
    assert all(got[t] == date(2024, 3, 2) for t in texts), got
    assert [got[t] for t in ("2024-13-02", "soon", "", None, "2024-3-2x")] == [None] * 5
