"""Race-shaped tables derived from the given star-schema tables.

season = order year, round = order month, driver = supplier, constructor =
supplier nation, one lap per line item.  Every view is a lazy DataFrame plan
over the parquet scans, so its work grows with the tables.

Ranking columns (lap number, classification positions, standings) go
through :func:`pitwall.operators.windows.row_number_by`, which splits a
race or season that holds a large share of all rows into ordered slices.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.operators.windows import (Key, numeric_slice, prefix_slice, rank_by,
                                      row_number_by)
from pitwall.sources.tables import driver_table

RACE = ["season", "round"]
ENTRY = ["season", "round", "driverId"]


def lap_rows(spark: SparkSession, sf_dir: str, with_order_cols: bool = False) -> DataFrame:
    """lineitem x orders x supplier, one row per line item, before lap numbering."""
    li = driver_table(spark, sf_dir, "lineitem", [
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_shipdate"])
    o = driver_table(spark, sf_dir, "orders", ["o_orderkey", "o_orderdate"])
    s = driver_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])
    j = (li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
           .join(s, F.col("s_suppkey") == F.col("l_suppkey")))
    cols = [
        F.year("o_orderdate").cast("int").alias("season"),
        F.month("o_orderdate").cast("int").alias("round"),
        F.concat(F.lit("D"), F.col("l_suppkey").cast("string")).alias("driverId"),
        F.concat(F.lit("C"), F.col("s_nationkey").cast("string")).alias("constructorId"),
        (F.lit(80000) + F.floor(F.col("l_extendedprice") / 2)).cast("bigint").alias("lap_ms"),
        (F.col("l_returnflag") == "R").alias("is_pit"),
        F.col("l_quantity").alias("qty"),
        F.col("l_discount").alias("disc"),
        F.col("l_tax").alias("tax"),
    ]
    if with_order_cols:
        cols += ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"]
    return j.select(*cols)


def laps(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> DataFrame:
    """One row per lap; lap = position of the line item within (race, driver).

    ``buckets``: the rows are dealt by (round, driver) into as many partitions, once for the
    numbering and for whoever stores them so.
    """
    base = lap_rows(spark, sf_dir, with_order_cols=True)
    order = [Key("l_shipdate"), Key("l_orderkey"), Key("l_linenumber"), Key("l_partkey"),
             Key("l_extendedprice"), Key("qty"), Key("disc"), Key("tax")]
    if buckets:
        base = base.repartition(buckets, "round", "driverId")
    out = row_number_by(base, ENTRY, order, "lap")
    return out.select("season", "round", "driverId", "constructorId", "lap", "lap_ms",
                      "is_pit", "qty", "disc", "tax")


def races(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (season, round); circuit from a fixed rotation of 23."""
    return races_from(lap_rows(spark, sf_dir))


def races_from(rows: DataFrame) -> DataFrame:
    r = rows.select(*RACE).distinct()
    return r.select(
        "season", "round",
        F.concat(F.lit("GP "), F.col("season").cast("string"), F.lit("-"),
                 F.col("round").cast("string")).alias("raceName"),
        F.concat(F.lit("K"), ((F.col("season") * 12 + F.col("round")) % 23).cast("string"))
        .alias("circuitId"))


def format_ms(ms: Column) -> Column:
    """Milliseconds -> 'M:SS.mmm'."""
    return F.concat(
        F.floor(ms / 60000).cast("int").cast("string"), F.lit(":"),
        F.lpad(F.floor((ms % 60000) / 1000).cast("int").cast("string"), 2, "0"), F.lit("."),
        F.lpad((ms % 1000).cast("string"), 3, "0"))


def lap_times_from(lp: DataFrame) -> DataFrame:
    # (race, lap) groups hold every driver of a race: slice by 512 ms of lap time.
    lp = lp.select("season", "round", "lap", "driverId", "lap_ms")
    ranked = rank_by(lp, ["season", "round", "lap"], [Key("lap_ms"), Key("driverId")],
                     "position", slices=[numeric_slice(Key("lap_ms"), 512)])
    return ranked.select("season", "round", "driverId", "lap", "position",
                         format_ms(F.col("lap_ms")).alias("time"))


def lap_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lap_times_from(laps(spark, sf_dir))


def pit_stops_from(lp: DataFrame) -> DataFrame:
    pits = lp.filter("is_pit").select("season", "round", "driverId", "lap", "qty")
    out = row_number_by(pits, ENTRY, [Key("lap")], "stop")
    return out.select("season", "round", "driverId", "lap", "stop",
                      F.col("qty").cast("string").alias("duration"))


def pit_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pit_stops_from(laps(spark, sf_dir))


def _entry_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per (race, driver) partial aggregate shared by qualifying and results.

    Lap numbers are not needed here, so this reads the un-numbered rows and
    aggregates map-side before the shuffle.
    """
    return entry_rollup_from(lap_rows(spark, sf_dir))


def entry_rollup_from(lp: DataFrame) -> DataFrame:
    return lp.groupBy(*ENTRY).agg(
        F.min("constructorId").alias("constructorId"),
        F.min(F.when(F.col("disc") <= 0.04, F.col("lap_ms"))).alias("q1"),
        F.min(F.when(F.col("disc").between(0.03, 0.07), F.col("lap_ms"))).alias("q2"),
        F.min(F.when(F.col("disc") >= 0.06, F.col("lap_ms"))).alias("q3"),
        F.count(F.lit(1)).cast("int").alias("n"),
        (F.sum("lap_ms") / F.count(F.lit(1))).alias("avg_ms"),
    )


def qualifying(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Qualifying order: q3, then q2, then q1 (missing last), then driverId."""
    return qualifying_from(_entry_rollup(spark, sf_dir))


def qualifying_from(e: DataFrame) -> DataFrame:
    order = [Key("q3", nulls_last=True), Key("q2", nulls_last=True),
             Key("q1", nulls_last=True), Key("driverId")]
    # A race holds all its entries: slice by 256 ms of q3 (missing q3 last).
    e = e.select(*ENTRY, "constructorId", "q1", "q2", "q3")
    out = row_number_by(e, RACE, order, "position",
                        slices=[numeric_slice(order[0], 256)])
    return out.select("season", "round", "driverId", "constructorId", "position",
                      "q1", "q2", "q3")


def race_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finishing order by mean lap time; fewer than 4 laps = retired ('R')."""
    return race_results_from(_entry_rollup(spark, sf_dir))


def race_results_from(e: DataFrame) -> DataFrame:
    e = e.select(*ENTRY, "constructorId", "avg_ms", "n")
    ranked = row_number_by(e, RACE, [Key("avg_ms"), Key("driverId")], "pos",
                           slices=[numeric_slice(Key("avg_ms"), 256)])
    pos, n = F.col("pos"), F.col("n")
    points = (F.when(n < 4, F.lit(0.0)).when(pos == 1, 25.0).when(pos == 2, 18.0)
              .when(pos == 3, 15.0).when(pos <= 10, (22 - 2 * pos).cast("double"))
              .otherwise(0.0))
    return ranked.select(
        "season", "round", "driverId", "constructorId",
        F.when(n < 4, F.lit("R")).otherwise(pos.cast("string")).alias("position"),
        points.alias("points"), n.alias("laps"))


def standings_from(results: DataFrame, who: str) -> DataFrame:
    agg = results.groupBy("season", who).agg(
        F.sum("points").alias("points"),
        F.sum(F.when(F.col("position") == "1", 1).otherwise(0)).cast("int").alias("wins"))
    order = [Key("points", desc=True), Key("wins", desc=True), Key(who)]
    # A season holds all its drivers, most of them on equal points: slice by
    # points, wins and the id prefix so no slice is one huge tie.
    out = row_number_by(agg, ["season"], order, "position",
                        slices=[numeric_slice(order[0], 1.0), numeric_slice(order[1], 1.0),
                                prefix_slice(order[2], 4)])
    return out.select("season", who, "points", "wins", "position")


def driver_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """End-of-season standings per driver."""
    return standings_from(race_results(spark, sf_dir), "driverId")


def constructor_standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standings_from(race_results(spark, sf_dir), "constructorId")


def weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily weather per race; round 7 is missing on purpose (a data definition of FIXTURES.md)."""
    return weather_from(lap_rows(spark, sf_dir))


def weather_from(rows: DataFrame) -> DataFrame:
    # Exact decimal sums, so a value on a rounding tie (x.xxxx5) rounds the same
    # way whatever order the partial sums arrive in.
    lp = rows.filter(F.col("round") != 7)
    dec = lambda c: F.col(c).cast("decimal(18,6)")
    return lp.groupBy(*RACE).agg(
        F.round(F.avg(dec("qty")), 4).cast("double").alias("mean_temp"),
        F.round(F.sum(dec("tax")), 4).cast("double").alias("precipitation_sum"),
        F.round(F.avg(dec("disc")) * 100, 4).cast("double").alias("windspeed_mean"))


def circuits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """23 circuits with coordinates, one per nation key below 23 (a data definition of FIXTURES.md)."""
    n = driver_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"])
    return n.filter(F.col("n_nationkey") < 23).select(
        F.concat(F.lit("K"), F.col("n_nationkey").cast("string")).alias("circuitId"),
        F.col("n_name").alias("circuitName"),
        (F.col("n_nationkey") * 3.5 - 40).alias("lat"),
        (F.col("n_nationkey") * 7.25 - 80).alias("long"))


VIEWS = {
    "laps": laps, "races": races, "lap_times": lap_times, "pit_stops": pit_stops,
    "qualifying": qualifying, "race_results": race_results,
    "driver_standings": driver_standings, "constructor_standings": constructor_standings,
    "weather": weather, "circuits": circuits,
}
