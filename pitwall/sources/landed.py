"""Landed API pages: nested JSON in, flat season tables out.

The reference pulls nested JSON page by page over HTTP.  Here the pages are
*landed files* (one JSON document per line) and every flattening is a
declared-schema ``read.json`` followed by ``explode``.  For tests and the
query checks, :func:`land` writes such pages from the race tables: each
page holds at most ``PAGE`` items (pages are keyed by position buckets),
so no page, task or group grows with the data.  Every leaf is a string, as
in the source API; the flatteners cast.
"""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitwall.operators.joins import one_per_circuit
from pitwall.operators.windows import Key, prefix_slice, row_number_by

PAGE = 100
OVERLAP = 5

S = T.StringType()


def _struct(**fields) -> T.StructType:
    return T.StructType([T.StructField(k, v, True) for k, v in fields.items()])


def _arr(t) -> T.ArrayType:
    return T.ArrayType(t, True)


DRIVER = _struct(driverId=S, permanentNumber=S, code=S, givenName=S, familyName=S)
CONSTRUCTOR = _struct(constructorId=S, name=S, nationality=S)
LOCATION = _struct(lat=S, long=S, locality=S, country=S)
CIRCUIT = _struct(circuitId=S, circuitName=S, url=S, Location=LOCATION)
QUAL = _struct(number=S, position=S, Driver=DRIVER, Constructor=CONSTRUCTOR, Q1=S, Q2=S, Q3=S)
RESULT = _struct(number=S, position=S, positionText=S, points=S, Driver=DRIVER,
                 Constructor=CONSTRUCTOR, grid=S, laps=S, status=S)
TIMING = _struct(driverId=S, position=S, time=S)
LAP = _struct(number=S, Timings=_arr(TIMING))
PIT = _struct(driverId=S, lap=S, stop=S, time=S, duration=S)
RACE = _struct(season=S, round=S, raceName=S, Circuit=CIRCUIT, date=S, time=S,
               QualifyingResults=_arr(QUAL), Results=_arr(RESULT), Laps=_arr(LAP),
               PitStops=_arr(PIT))
DRIVER_STANDING = _struct(position=S, positionText=S, points=S, wins=S, Driver=DRIVER,
                          Constructors=_arr(CONSTRUCTOR))
CONSTRUCTOR_STANDING = _struct(position=S, positionText=S, points=S, wins=S,
                               Constructor=CONSTRUCTOR)
STANDINGS_LIST = _struct(season=S, round=S, DriverStandings=_arr(DRIVER_STANDING),
                         ConstructorStandings=_arr(CONSTRUCTOR_STANDING))
MRDATA = _struct(
    limit=S, offset=S, total=S,
    RaceTable=_struct(season=S, round=S, Races=_arr(RACE)),
    StandingsTable=_struct(season=S, StandingsLists=_arr(STANDINGS_LIST)),
    CircuitTable=_struct(season=S, Circuits=_arr(CIRCUIT)),
    SeasonTable=_struct(Seasons=_arr(_struct(season=S, url=S))))
PAGE_SCHEMA = _struct(MRData=MRDATA)
WEATHER_SCHEMA = T.StructType([
    T.StructField("latitude", T.DoubleType()), T.StructField("longitude", T.DoubleType()),
    T.StructField("daily", T.StructType([
        T.StructField("time", _arr(S)),
        T.StructField("temperature_2m_mean", _arr(T.DoubleType())),
        T.StructField("precipitation_sum", _arr(T.DoubleType())),
        T.StructField("windspeed_10m_mean", _arr(T.DoubleType()))]))])


def read_pages(spark: SparkSession, path: str, schema: T.StructType = PAGE_SCHEMA) -> DataFrame:
    """Read a folder of landed pages with the declared schema (no inference)."""
    return spark.read.schema(schema).option("mode", "PERMISSIVE").json(path)


# --- quarantine (S4-S13) --------------------------------------------------------------

#: Column of a text that is not one whole JSON document.
BROKEN = "_corrupt_record"


def judged(lines: DataFrame, table: str = "RaceTable", schema: T.StructType = PAGE_SCHEMA) -> DataFrame:
    """Landed lines (``value``, ``file``) with the parsed page and the reason it is rejected for, if any.

    ``malformed``: not a whole JSON document; ``no <table>``: it lacks the table it was asked
    for; ``no race key``: a race in it has no season or round.  Nothing disappears: each line is
    a page or a reject.
    """
    wide = T.StructType([*schema.fields, T.StructField(BROKEN, T.StringType())])
    page = F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BROKEN})
    out = lines.withColumn("page", page)
    inside = F.col(f"page.MRData.{table}")
    reason = F.when(F.col("page").isNull() | F.col(f"page.{BROKEN}").isNotNull(), F.lit("malformed")).when(inside.isNull(), F.lit(f"no {table}"))
    if table == "RaceTable":
        keyless = F.exists(F.coalesce(inside["Races"], F.array().cast(_arr(RACE))), lambda r: r["season"].isNull() | r["round"].isNull())
        reason = reason.when(keyless, F.lit("no race key"))
    return out.withColumn("reason", reason)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a folder of landed pages, as they came, with their file."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))


def good_pages(lines: DataFrame) -> DataFrame:
    """The pages among judged lines, as the flatteners take them."""
    return lines.filter(F.col("reason").isNull()).select("page.MRData")


def rejects(lines: DataFrame) -> DataFrame:
    """The rejected lines: file, reason and the text as it came."""
    return lines.filter(F.col("reason").isNotNull()).select("file", "reason", F.col("value").alias("text"))


def spoilt(lines: DataFrame) -> DataFrame:
    """Landed lap pages with broken copies beside them, as failed requests leave them: of laps
    divisible by ten the first half of the text, of the other multiples of five a page without its table."""
    lap = F.get_json_object("value", "$.MRData.RaceTable.Races[0].Laps[0].number").cast("int")
    copies = F.array(F.col("value"), F.when(lap % 10 == 0, F.expr("left(value, length(value) div 2)")).when(
        lap % 5 == 0, F.lit('{"MRData":{"limit":"100"}}')))
    return lines.select(F.explode(F.filter(copies, lambda c: c.isNotNull())).alias("value"))


# --- flatteners ---------------------------------------------------------------------

def _s(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _int(c) -> Column:
    return _s(c).try_cast("int")


def flatten_races(pages: DataFrame) -> DataFrame:
    """Races[] with nested Circuit.Location; optional time."""
    r = pages.select(F.explode("MRData.RaceTable.Races").alias("r"))
    return r.select(
        _int("r.season").alias("season"), _int("r.round").alias("round"),
        F.col("r.raceName").alias("raceName"), F.col("r.Circuit.circuitId").alias("circuitId"),
        F.col("r.Circuit.circuitName").alias("circuitName"),
        F.col("r.Circuit.Location.locality").alias("circuitLocality"),
        F.col("r.Circuit.Location.country").alias("circuitCountry"),
        clean_date(F.col("r.date")).alias("date"),
        F.col("r.time").alias("time"))


def _driver_cols(p: str) -> list[Column]:
    return [F.col(f"{p}.Driver.driverId").alias("driverId"),
            _int(f"{p}.Driver.permanentNumber").alias("permanentNumber"),
            F.col(f"{p}.Driver.code").alias("driverCode"),
            F.col(f"{p}.Driver.givenName").alias("givenName"),
            F.col(f"{p}.Driver.familyName").alias("familyName")]


def flatten_qualifying(pages: DataFrame) -> DataFrame:
    """Races[].QualifyingResults[]; a race without the array gives no rows."""
    r = pages.select(F.explode("MRData.RaceTable.Races").alias("r"))
    q = r.select("r.season", "r.round", "r.raceName",
                 F.explode("r.QualifyingResults").alias("q"))
    return q.select(
        _int("season").alias("season"), _int("round").alias("round"), "raceName",
        *_driver_cols("q"), F.col("q.Constructor.constructorId").alias("constructorId"),
        F.col("q.Constructor.name").alias("constructorName"),
        _int("q.position").alias("position"),
        F.col("q.Q1").alias("q1"), F.col("q.Q2").alias("q2"), F.col("q.Q3").alias("q3"))


def flatten_results(pages: DataFrame) -> DataFrame:
    """Races[].Results[]."""
    r = pages.select(F.explode("MRData.RaceTable.Races").alias("r"))
    x = r.select("r.season", "r.round", "r.raceName", F.explode("r.Results").alias("x"))
    return x.select(
        _int("season").alias("season"), _int("round").alias("round"), "raceName",
        *_driver_cols("x"), F.col("x.Constructor.constructorId").alias("constructorId"),
        F.col("x.Constructor.name").alias("constructorName"),
        _int("x.number").alias("carNumber"), F.col("x.position").alias("position"),
        F.col("x.points").try_cast("double").alias("points"), _int("x.grid").alias("grid"),
        _int("x.laps").alias("laps"), F.col("x.status").alias("status"))


def flatten_laps(pages: DataFrame) -> DataFrame:
    """First race of the page, Laps[].Timings[]; lap number cast to int."""
    r = pages.select(F.try_element_at("MRData.RaceTable.Races", F.lit(1)).alias("r"))
    lp = r.select("r.season", "r.round", F.explode("r.Laps").alias("l"))
    tm = lp.select("season", "round", F.col("l.number").alias("lap"),
                   F.explode("l.Timings").alias("t"))
    return tm.select(_int("season").alias("season"), _int("round").alias("round"),
                     F.col("t.driverId").alias("driverId"), _int("lap").alias("lap"),
                     _int("t.position").alias("position"), F.col("t.time").alias("time"))


def flatten_pit_stops(pages: DataFrame) -> DataFrame:
    """First race of the page, PitStops[]; optional duration and time."""
    r = pages.select(F.try_element_at("MRData.RaceTable.Races", F.lit(1)).alias("r"))
    p = r.select("r.season", "r.round", F.explode("r.PitStops").alias("p"))
    return p.select(_int("season").alias("season"), _int("round").alias("round"),
                    F.col("p.driverId").alias("driverId"), _int("p.lap").alias("lap"),
                    _int("p.stop").alias("stop"), F.col("p.time").alias("time"),
                    F.col("p.duration").alias("duration"))


def flatten_driver_standings(pages: DataFrame) -> DataFrame:
    """First StandingsLists entry; first of Constructors or NULL."""
    sl = pages.select(F.try_element_at("MRData.StandingsTable.StandingsLists", F.lit(1)).alias("s"))
    d = sl.select("s.season", "s.round", F.explode("s.DriverStandings").alias("d"))
    first = F.try_element_at("d.Constructors", F.lit(1))
    return d.select(
        _int("season").alias("season"), _int("round").alias("round"), *_driver_cols("d"),
        first.getField("constructorId").alias("constructorId"),
        first.getField("name").alias("constructorName"),
        _int("d.position").alias("position"), F.col("d.points").try_cast("double").alias("points"),
        _int("d.wins").alias("wins"))


def flatten_constructor_standings(pages: DataFrame) -> DataFrame:
    """S10."""
    sl = pages.select(F.try_element_at("MRData.StandingsTable.StandingsLists", F.lit(1)).alias("s"))
    c = sl.select("s.season", "s.round", F.explode("s.ConstructorStandings").alias("c"))
    return c.select(
        _int("season").alias("season"), _int("round").alias("round"),
        F.col("c.Constructor.constructorId").alias("constructorId"),
        F.col("c.Constructor.name").alias("constructorName"),
        F.col("c.Constructor.nationality").alias("nationality"),
        _int("c.position").alias("position"), F.col("c.points").try_cast("double").alias("points"),
        _int("c.wins").alias("wins"))


def flatten_circuits(pages: DataFrame) -> DataFrame:
    """Circuits[] with Location."""
    c = pages.select("MRData.CircuitTable.season",
                     F.explode("MRData.CircuitTable.Circuits").alias("c"))
    return c.select(_int("season").alias("season"), F.col("c.circuitId").alias("circuitId"),
                    F.col("c.circuitName").alias("circuitName"),
                    F.col("c.Location.locality").alias("locality"),
                    F.col("c.Location.country").alias("country"),
                    F.col("c.Location.lat").try_cast("double").alias("lat"),
                    F.col("c.Location.long").try_cast("double").alias("long"),
                    F.col("c.url").alias("url"))


def flatten_seasons(pages: DataFrame) -> DataFrame:
    """Seasons[].season."""
    s = pages.select(F.explode("MRData.SeasonTable.Seasons").alias("s"))
    return s.select(_int("s.season").alias("season"))


def flatten_weather(docs: DataFrame) -> DataFrame:
    """First value of each daily series; partial NULLs kept, all-NULL dropped."""
    d = docs.select(
        F.col("latitude").alias("lat"), F.col("longitude").alias("long"),
        F.try_to_date(F.try_element_at("daily.time", F.lit(1)), "yyyy-MM-dd").alias("date"),
        F.try_element_at("daily.temperature_2m_mean", F.lit(1)).alias("mean_temp"),
        F.try_element_at("daily.precipitation_sum", F.lit(1)).alias("precipitation_sum"),
        F.try_element_at("daily.windspeed_10m_mean", F.lit(1)).alias("windspeed_mean"))
    return d.filter(F.coalesce("mean_temp", "precipitation_sum", "windspeed_mean").isNotNull())


def merge_pages(flat: DataFrame, key: list[str]) -> DataFrame:
    """Pages that overlap (offset/limit windows) merged into one table."""
    return flat.dropDuplicates(key)


#: Fixed value: the date forms that are understood, by what the text looks like.
DATE_FORMS = {r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$": "yyyy-MM-dd", r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$": "yyyy/MM/dd",
              r"^[0-9]{8}$": "yyyyMMdd", r"^[0-9]{1,2} [A-Za-z]{3} [0-9]{4}$": "d MMM yyyy",
              r"^[0-9]{1,2} [A-Za-z]{4,} [0-9]{4}$": "d MMMM yyyy", r"^[A-Za-z]{3} [0-9]{1,2}, [0-9]{4}$": "MMM d, yyyy",
              r"^[A-Za-z]{4,} [0-9]{1,2}, [0-9]{4}$": "MMMM d, yyyy"}


def clean_date(text: Column) -> Column:
    """the day of a date or datetime text, else NULL.

    A time part (after 'T' or a blank, with or without zone) is cut off.
    """
    day = F.regexp_replace(F.trim(text), r"(?:T|[ ]+)[0-9]{1,2}:[0-9]{2}.*$", "")
    out = F.lit(None).cast("date")
    for pattern, form in DATE_FORMS.items():
        out = F.when(day.rlike(pattern), F.try_to_date(day, form)).otherwise(out)
    return out


def weather_for_races(races: DataFrame, circuits: DataFrame, weather: DataFrame) -> DataFrame:
    """Races with numeric coordinates, rounded to 2 dp, joined to
    landed daily weather by place and day.  Races without weather are absent."""
    c = one_per_circuit(circuits).select("circuitId", F.col("lat").try_cast("double").alias("lat"),
                                         F.col("long").try_cast("double").alias("long"))
    r = races.join(c, "circuitId", "left") \
             .filter(F.col("lat").isNotNull() & F.col("long").isNotNull())
    r = r.select("season", "round", "circuitId", F.round("lat", 2).alias("lat2"),
                 F.round("long", 2).alias("long2"), clean_date(F.col("date")).alias("day"))
    w = weather.select(F.round("lat", 2).alias("lat2"), F.round("long", 2).alias("long2"),
                       F.col("date").alias("day"), "mean_temp", "precipitation_sum",
                       "windspeed_mean")
    j = r.filter(F.col("day").isNotNull()).join(w, ["lat2", "long2", "day"], "inner")
    return j.select("season", "round", "circuitId", "mean_temp", "precipitation_sum",
                    "windspeed_mean")


# --- landing pages from the race tables (test and check input) ------------------------

def race_date(season: Column, rnd: Column) -> Column:
    """Race day text with a time part, as the source sends it."""
    return F.concat(F.make_date(season, rnd, F.lit(1)).cast("string"), F.lit("T00:00:00Z"))


def _page_doc(table: str, inner: Column) -> Column:
    """One page document: MRData with its paging field and one table."""
    mr = F.struct(F.lit(str(PAGE)).alias("limit"), inner.alias(table))
    return F.to_json(F.struct(mr.alias("MRData")))


def _race_table(season: Column, races: Column) -> Column:
    return _page_doc("RaceTable", F.struct(season.cast("string").alias("season"),
                                           races.alias("Races")))


def _write(df: DataFrame, doc: Column, path: str) -> None:
    df.select(doc.alias("value")).write.mode("overwrite").option("compression", "gzip").text(path)


def _driver(c: str = "driverId") -> Column:
    return F.struct(F.col(c).alias("driverId"),
                    F.substring(F.col(c), 2, 20).alias("permanentNumber"))


def _constructor(c: str = "constructorId") -> Column:
    return F.struct(F.col(c).alias("constructorId"),
                    F.concat(F.lit("Team "), F.col(c)).alias("name"))


ENDPOINTS = ("races", "qualifying", "results", "laps", "laps_overlap", "pit_stops", "driver_standings",
             "constructor_standings", "circuits", "seasons", "weather")


def land(t, root: str, endpoints: tuple[str, ...] = ENDPOINTS) -> dict[str, str]:
    """Write API-shaped pages for the endpoints below ``root``; return the folders.  Of the race
    tables only those that an endpoint shows are read."""
    from pitwall.sources.fixtures import format_ms

    paths = {k: os.path.join(root, k) for k in endpoints}
    races, circuits = t.races, t.circuits
    race_info = races.join(circuits, "circuitId", "left")
    loc = F.struct(F.col("lat").cast("string").alias("lat"), F.col("long").cast("string").alias("long"),
                   F.col("circuitName").alias("country"))
    circuit = F.struct("circuitId", "circuitName", loc.alias("Location"))
    race = F.struct(F.col("season").cast("string").alias("season"),
                    F.col("round").cast("string").alias("round"), "raceName",
                    circuit.alias("Circuit"), race_date(F.col("season"), F.col("round")).alias("date"),
                    F.when(F.col("round") % 2 == 0, F.lit("14:00:00Z")).alias("time"))
    if "races" in paths:
        # races: one page per season (a season has a bounded number of rounds)
        rp = race_info.groupBy("season").agg(F.collect_list(race).alias("rs"))
        _write(rp, _race_table(F.col("season"), F.col("rs")), paths["races"])

    def race_pages(items: DataFrame, arr_name: str, item: Column, bucket: Column, out: str):
        g = items.withColumn("__b", bucket).groupBy("season", "round", "__b").agg(
            F.collect_list(item).alias("items"))
        g = g.join(races.select("season", "round", "raceName"), ["season", "round"])
        one = F.struct(F.col("season").cast("string").alias("season"),
                       F.col("round").cast("string").alias("round"), "raceName",
                       F.col("items").alias(arr_name))
        _write(g, _race_table(F.col("season"), F.array(one)), out)

    if "qualifying" in paths:
        q = t.qualifying
        qual = F.struct(F.col("position").cast("string").alias("position"), _driver().alias("Driver"),
                        _constructor().alias("Constructor"), format_ms(F.col("q1")).alias("Q1"),
                        format_ms(F.col("q2")).alias("Q2"), format_ms(F.col("q3")).alias("Q3"))
        race_pages(q, "QualifyingResults", qual, F.floor((F.col("position") - 1) / PAGE),
                   paths["qualifying"])

    if "results" in paths:
        rr = row_number_by(t.race_results, ["season", "round"], [Key("driverId")], "__rn",
                           slices=[prefix_slice(Key("driverId"), 4)])
        res = F.struct(F.col("position").alias("position"), F.col("position").alias("positionText"),
                       F.col("points").cast("string").alias("points"), _driver().alias("Driver"),
                       _constructor().alias("Constructor"), F.col("laps").cast("string").alias("laps"),
                       F.when(F.col("position") == "R", "Retired").otherwise("Finished").alias("status"))
        race_pages(rr, "Results", res, F.floor((F.col("__rn") - 1) / PAGE), paths["results"])

    timing = F.struct("driverId", F.col("position").cast("string").alias("position"), "time")

    def lap_pages(src: DataFrame, out: str):
        g = src.groupBy("season", "round", "lap", "__b").agg(F.collect_list(timing).alias("tm"))
        lap = F.struct(F.col("lap").cast("string").alias("number"), F.col("tm").alias("Timings"))
        one = F.struct(F.col("season").cast("string").alias("season"),
                       F.col("round").cast("string").alias("round"), F.array(lap).alias("Laps"))
        _write(g, _race_table(F.col("season"), F.array(one)), out)

    paged = lambda: t.lap_times.withColumn("__b", F.floor((F.col("position") - 1) / PAGE))
    if "laps" in paths:
        lap_pages(paged(), paths["laps"])
    if "laps_overlap" in paths:
        # overlapping pages: the last OVERLAP rows of a page repeat at the start of the next
        tail = paged().filter((F.col("position") - 1) % PAGE >= PAGE - OVERLAP).withColumn("__b", F.col("__b") + 1)
        lap_pages(paged().unionByName(tail), paths["laps_overlap"])

    if "pit_stops" in paths:
        ps = t.pit_stops.join(t.lap_times.select("season", "round", "driverId", "lap", "position"),
                              ["season", "round", "driverId", "lap"], "left")
        pit = F.struct("driverId", F.col("lap").cast("string").alias("lap"),
                       F.col("stop").cast("string").alias("stop"), "duration")
        g = ps.withColumn("__b", F.floor((F.coalesce("position", F.lit(1)) - 1) / PAGE)) \
              .groupBy("season", "round", "lap", "__b").agg(F.collect_list(pit).alias("ps"))
        one = F.struct(F.col("season").cast("string").alias("season"),
                       F.col("round").cast("string").alias("round"), F.col("ps").alias("PitStops"))
        _write(g, _race_table(F.col("season"), F.array(one)), paths["pit_stops"])

    def standings_pages(src: DataFrame, arr: str, item: Column, out: str):
        last = t.races.groupBy("season").agg(F.max("round").alias("last_round"))
        g = src.withColumn("__b", F.floor((F.col("position") - 1) / PAGE)) \
               .groupBy("season", "__b").agg(F.collect_list(item).alias("items")) \
               .join(last, "season", "left")
        sl = F.struct(F.col("season").cast("string").alias("season"),
                      F.col("last_round").cast("string").alias("round"), F.col("items").alias(arr))
        _write(g, _page_doc("StandingsTable", F.struct(F.array(sl).alias("StandingsLists"))), out)

    if "driver_standings" in paths:
        ds = F.struct(F.col("position").cast("string").alias("position"),
                      F.col("points").cast("string").alias("points"),
                      F.col("wins").cast("string").alias("wins"), _driver().alias("Driver"),
                      F.array().cast(_arr(CONSTRUCTOR)).alias("Constructors"))
        standings_pages(t.driver_standings, "DriverStandings", ds, paths["driver_standings"])

    if "constructor_standings" in paths:
        cs = F.struct(F.col("position").cast("string").alias("position"),
                      F.col("points").cast("string").alias("points"),
                      F.col("wins").cast("string").alias("wins"), _constructor().alias("Constructor"))
        standings_pages(t.constructor_standings, "ConstructorStandings", cs,
                        paths["constructor_standings"])

    if "circuits" in paths:
        # circuits per season: the circuits raced that season (bounded by the calendar)
        cps = races.select("season", "circuitId").distinct().join(circuits, "circuitId")
        g = cps.groupBy("season").agg(F.collect_list(circuit).alias("cs"))
        _write(g, _page_doc("CircuitTable", F.struct(F.col("season").cast("string").alias("season"), F.col("cs").alias("Circuits"))), paths["circuits"])

    if "seasons" in paths:
        seasons = races.select("season").distinct().agg(
            F.collect_list(F.struct(F.col("season").cast("string").alias("season"))).alias("ss"))
        _write(seasons, _page_doc("SeasonTable", F.struct(F.col("ss").alias("Seasons"))), paths["seasons"])

    if "weather" in paths:
        # weather: one document per race day and place; races without weather land empty series
        w = race_info.join(t.weather, ["season", "round"], "left")
        daily = F.struct(
            F.array(F.make_date("season", "round", F.lit(1)).cast("string")).alias("time"),
            F.when(F.col("mean_temp").isNotNull(), F.array("mean_temp")).otherwise(F.array().cast(_arr(T.DoubleType()))).alias("temperature_2m_mean"),
            F.when(F.col("precipitation_sum").isNotNull(), F.array("precipitation_sum")).otherwise(F.array().cast(_arr(T.DoubleType()))).alias("precipitation_sum"),
            F.when(F.col("windspeed_mean").isNotNull(), F.array("windspeed_mean")).otherwise(F.array().cast(_arr(T.DoubleType()))).alias("windspeed_10m_mean"))
        doc = F.to_json(F.struct(F.col("lat").alias("latitude"), F.col("long").alias("longitude"),
                                 daily.alias("daily")))
        _write(w, doc, paths["weather"])
    return paths


class Landed:
    """The landed pages of one input: an endpoint's folder is written when it is first asked for."""

    def __init__(self, t, root: str) -> None:
        self.t, self.root, self.done = t, root, {}

    def __getitem__(self, endpoint: str) -> str:
        if endpoint not in self.done:
            self.done |= land(self.t, self.root, (endpoint,))
        return self.done[endpoint]


_LANDED: dict[tuple[str, str], Landed] = {}


def landed_paths(t) -> Landed:
    """Pages landed once per application and dataset, below the shared folder."""
    from pitwall.session import input_stamp, scratch_path
    from pitwall.sources.conform import INPUTS

    key = (t.spark.sparkContext.applicationId, input_stamp(t.spark, t.sf_dir, INPUTS))
    if key not in _LANDED:
        _LANDED[key] = Landed(t, scratch_path(t.spark, "landed"))
    return _LANDED[key]


def incomplete_laps(lap_times: DataFrame, results: DataFrame) -> DataFrame:
    """Drivers of whom fewer laps have landed than their result counts."""
    landed = lap_times.groupBy("season", "round", "driverId").agg(F.max("lap").alias("landed_laps"))
    j = results.select("season", "round", "driverId", "laps").join(landed, ["season", "round", "driverId"], "left")
    j = j.withColumn("landed_laps", F.coalesce("landed_laps", F.lit(0)))
    return j.filter(F.col("landed_laps") < F.col("laps"))
