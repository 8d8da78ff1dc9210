"""Shared folders, conformed tables on demand, page ingest in several batches, landed pages by hand."""

import json
import os
import shutil
import types

import pytest

from pitwall import session
from pitwall.plans.base_tables import joined_grid
from pitwall.sources import commit, conform, landed
from pitwall.streaming.ingest import LAP_KEY, upsert_batch

SF = "/root/testdata/sf0.001"


def _fake(master):
    class Context:
        def __init__(self):
            self.master, self.dir = master, None

        def getCheckpointDir(self):
            return self.dir

        def getConf(self):
            return types.SimpleNamespace(get=lambda key, default=None: default)

        def setCheckpointDir(self, path):
            self.dir = path

    return types.SimpleNamespace(sparkContext=Context(), conf=types.SimpleNamespace(get=lambda key, default=None: default))


@pytest.mark.parametrize("master", ["yarn", "spark://host:7077", "k8s://x", "local-cluster[2,1,1024]"])
def test_a_cluster_needs_a_shared_folder(master):
    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(_fake(master))


def test_one_machine_may_use_a_temporary_folder():
    assert os.path.isdir(session.ensure_checkpoint_dir(_fake("local[8]")))


def test_tables_are_written_when_asked_for(spark, tmp_path):
    own = conform.Store(spark, SF, str(tmp_path / "store"))
    assert own.table("races").count() > 0
    assert set(own._done) == {"races", "entries", "laps"}
    own.all_tables()
    assert set(own._done) == set(conform.TABLES)


def test_a_second_store_reuses_what_is_published_and_nothing_else(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "store")
    first = conform.Store(spark, SF, root)
    path, rows = first.located("races"), first.table("races").count()
    # a writer that died: files without a manifest
    shutil.copytree(path, os.path.join(root, "weather-dead"))
    monkeypatch.setitem(conform.RECIPES, "races", ((), None))
    again = conform.Store(spark, SF, root)
    assert again.buckets == first.buckets and again.located("races") == path and again.table("races").count() == rows
    assert again.table("weather").columns[-1] == "season" and again.located("weather") != os.path.join(root, "weather-dead")
    # a manifest cut short counts as none
    os.remove(os.path.join(root, "circuits.json")) if os.path.exists(os.path.join(root, "circuits.json")) else None
    with open(os.path.join(root, "circuits.json"), "w") as f:
        f.write('{"data": ')
    assert commit.manifest(spark, root, "circuits") is None


RESULTS = "season int, round int, driverId string"


def test_a_half_written_season_is_completed_by_the_next_append(spark, tmp_path):
    from pyspark.sql import types as T
    from pitwall.sources import tables
    schema = T._parse_datatype_string(RESULTS)
    root, rows = str(tmp_path), [(s, r, f"D{d}") for s in (1999, 2000, 2001) for r in (1, 2) for d in range(5)]
    new = spark.createDataFrame([*rows, (None, 1, "D9")], RESULTS)
    read = lambda **k: sorted(tuple(r) for r in tables.scan_table(spark, root, "t", schema, **k).select("season", "round", "driverId").collect())
    assert read() == []
    out = tables.incremental_append(spark, new.filter("season = 1999"), root, "t", schema)
    assert out.count() == 10 and read() == rows[:10]
    # a writer dies: staged rows, one season half in place without its marker, one marker cut short
    new.filter("season = 2000 and round = 1").drop("season").write.parquet(str(tmp_path / "t" / "season=2000"))
    new.filter("season = 2001").drop("season").write.parquet(str(tmp_path / "t" / "season=2001"))
    (tmp_path / "t" / "_committed" / "2001.json").write_text('{"sea')
    new.write.partitionBy("season").parquet(str(tmp_path / "t" / "_staged-dead"))
    assert read() == rows[:10] and tables.committed(spark, root, "t") == [1999]
    again = tables.incremental_append(spark, new, root, "t", schema)
    assert sorted({r["season"] for r in again.collect()}) == [2000, 2001]
    assert read() == rows and read(seasons=[2000]) == rows[10:20]
    assert tables.incremental_append(spark, new, root, "t", schema).count() == 0 and read() == rows


def test_seasons_of_a_whole_table_count_as_landed(spark, tmp_path):
    from pyspark.sql import types as T
    from pitwall.sources import tables
    schema, root = T._parse_datatype_string(RESULTS), str(tmp_path)
    tables.write_table(spark.createDataFrame([(1999, 1, "a")], RESULTS), root, "t")
    tables.incremental_append(spark, spark.createDataFrame([(1999, 2, "b"), (2000, 1, "c")], RESULTS), root, "t", schema)
    assert sorted(r["driverId"] for r in tables.scan_table(spark, root, "t", schema).collect()) == ["a", "c"]


def test_broken_lines_are_kept_with_their_reason(spark, tmp_path):
    whole = json.dumps(race_page(Laps=[{"number": "1", "Timings": [{"driverId": "max", "position": "1", "time": "1:30.0"}]}]))
    keyless = json.dumps({"MRData": {"RaceTable": {"Races": [{"raceName": "x"}]}}})
    lines = [whole, whole[:len(whole) // 2], '{"MRData": {"StandingsTable": {}}}', "<html>busy</html>", keyless, "[]", "null", "{}"]
    (tmp_path / "pages").mkdir()
    (tmp_path / "pages" / "a.json").write_text("\n".join(lines) + "\n")
    got = landed.judged(landed.read_lines(spark, str(tmp_path / "pages")))
    found = {r["text"]: r["reason"] for r in landed.rejects(got).collect()}
    assert len(found) == len(lines) - 1 and whole not in found
    assert (found[lines[1]], found[lines[2]], found[lines[3]], found[keyless]) == ("malformed", "no RaceTable", "malformed", "no race key")
    assert [r["driverId"] for r in landed.flatten_laps(landed.good_pages(got)).collect()] == ["max"]
    # the same in a stream, run twice
    from pitwall.streaming.ingest import ingested_laps, rejected
    root = str(tmp_path / "out")
    for _ in range(2):
        assert ingested_laps(spark, str(tmp_path / "pages"), root).count() == 1
        assert rejected(spark, root).count() == len(lines) - 1


def test_two_writers_publish_one_table(spark, tmp_path):
    folder = str(tmp_path / "p")

    def slow(path):
        # another application is done first
        commit.publish(spark, folder, "t", lambda other: spark.range(2).write.parquet(other))
        spark.range(5).write.parquet(path)

    found = commit.publish(spark, folder, "t", slow)
    assert spark.read.parquet(found["path"]).count() == 2
    assert sorted(n for n in os.listdir(folder) if n.startswith("t")) == sorted(["t.json", os.path.basename(found["path"])])


def exchanges(df):
    """Exchanges of the final plan, by the scan they are fed from: (keys, tables below)."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]


def test_stored_facts_are_joined_and_windowed_where_they_lie(spark, tmp_path):
    from pitwall.operators.windows import ENTRY, add_lags
    from pitwall.plans import base_tables as bt
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no fact were small
    try:
        own = conform.Store(spark, SF, str(tmp_path / "store"))
        laps, pits, results, quali = (own.table(n) for n in ("lap_times", "pit_stops", "race_results", "qualifying"))
        joined = laps.join(pits.drop("stop"), ["season", "round", "driverId", "lap"], "left")
        assert exchanges(joined) == []
        assert exchanges(add_lags(joined, {"time": [(1, "before")]}, ENTRY, "lap")) == []
        assert exchanges(bt.joined_grid(results, quali.select(*ENTRY, "q3"))) == []
        plain = spark.read.parquet(own.located("lap_times")).join(
            spark.read.parquet(own.located("pit_stops")).drop("stop"), ["season", "round", "driverId", "lap"], "left")
        assert sorted(map(str, joined.collect())) == sorted(map(str, plain.select(*joined.columns).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_changed_input_gets_another_stamp(spark, tmp_path):
    for name in ("a", "b"):
        spark.range(3 if name == "a" else 4).write.parquet(str(tmp_path / name / "orders.parquet"))
    stamp = lambda n: session.input_stamp(spark, str(tmp_path / n), ("orders",))
    assert stamp("a") == stamp("a") != stamp("b")
    spark.range(1).write.mode("append").parquet(str(tmp_path / "a" / "orders.parquet"))
    before = stamp("b")
    assert stamp("b") == before


def test_batches_that_overlap_add_each_lap_once(spark, tmp_path):
    out = str(tmp_path / "laps")
    schema = "season int, round int, driverId string, lap int, position int, time string"
    batches = [[(2000, 1, "D1", k, 1, "1:00.0") for k in range(a, b)] for a, b in ((1, 5), (3, 9), (1, 12))]
    batches.append([(2001, 1, "D1", 1, 1, "x"), (2001, 1, "D1", 1, 1, "x"), (2000, 1, "D1", 2, 9, "late")])
    for rows in batches:
        upsert_batch(spark.createDataFrame(rows, schema), out, LAP_KEY)
    got = spark.read.parquet(out)
    assert got.count() == got.select(*LAP_KEY).distinct().count() == 12


def test_official_grid_stays_beside_the_qualifying_position(spark):
    results = spark.createDataFrame([(2000, 1, "D1", "1", 5), (2000, 1, "D2", "R", None)],
                                    "season int, round int, driverId string, position string, grid int")
    quali = spark.createDataFrame([(2000, 1, "D1", 2.0)], "season int, round int, driverId string, grid double")
    got = {r["driverId"]: (r["grid"], r["grid_official"], r["on_podium"]) for r in joined_grid(results, quali).collect()}
    assert got == {"D1": (2.0, 5, True), "D2": (None, None, False)}


def test_laps_that_have_not_landed(spark):
    laps = spark.createDataFrame([(2000, 1, "D1", 1), (2000, 1, "D1", 3)], "season int, round int, driverId string, lap int")
    results = spark.createDataFrame([(2000, 1, "D1", 3), (2000, 1, "D2", 2), (2000, 1, "D3", 0), (2000, 1, "D4", None)],
                                    "season int, round int, driverId string, laps int")
    got = [tuple(r) for r in landed.incomplete_laps(laps, results).select("driverId", "laps", "landed_laps").collect()]
    assert got == [("D2", 2, 0)]


DRIVER = {"driverId": "max", "permanentNumber": "33", "code": "VER", "givenName": "Max", "familyName": "V", "nationality": "Dutch"}
TEAMS = [{"constructorId": "rb", "name": "Red", "nationality": "Austrian"}, {"constructorId": "tr", "name": "Toro", "nationality": "Italian"}]
RACE = {"season": "2016", "round": "5", "raceName": "Spanish", "date": "2016-05-15", "time": "12:00:00Z",
        "Circuit": {"circuitId": "cat", "circuitName": "C", "url": "u", "Location": {"lat": "41.57", "long": "2.26", "locality": "M", "country": "Spain"}}}


def pages(spark, tmp_path, doc, schema=landed.PAGE_SCHEMA):
    path = tmp_path / "page.json"
    path.write_text(json.dumps(doc) + "\n")
    return spark.read.schema(schema).json(str(path))


def race_page(**extra):
    return {"MRData": {"RaceTable": {"season": "2016", "Races": [{**RACE, **extra}]}}}


def test_pages_with_all_fields(spark, tmp_path):
    results = [{"number": "33", "position": "1", "positionText": "1", "points": "25", "Driver": DRIVER, "Constructor": TEAMS[0],
                "grid": "4", "laps": "66", "status": "Finished"},
               {"position": "x", "points": None, "Driver": {"driverId": "nobody"}, "Constructor": None}]
    got = {r["driverId"]: r for r in landed.flatten_results(pages(spark, tmp_path, race_page(Results=results))).collect()}
    assert (got["max"]["season"], got["max"]["round"], got["max"]["constructorId"]) == (2016, 5, "rb")
    assert float(got["max"]["points"]) == 25 and int(got["max"]["laps"]) == 66 and got["nobody"]["constructorId"] is None
    quali = [{"number": "33", "position": "4", "Driver": DRIVER, "Constructor": TEAMS[0], "Q1": "1:23.5", "Q2": None}]
    row = landed.flatten_qualifying(pages(spark, tmp_path, race_page(QualifyingResults=quali))).first()
    assert (row["driverId"], int(row["position"])) == ("max", 4)


def test_standings_take_the_first_of_several_teams(spark, tmp_path):
    entry = {"position": "1", "positionText": "1", "points": "204", "wins": "7", "Driver": DRIVER}
    doc = lambda teams: {"MRData": {"StandingsTable": {"season": "2016", "StandingsLists": [
        {"season": "2016", "round": "21", "DriverStandings": [{**entry, "Constructors": teams}]}]}}}
    for teams, want in ((TEAMS, "rb"), (TEAMS[1:], "tr"), ([], None), (None, None)):
        row = landed.flatten_driver_standings(pages(spark, tmp_path, doc(teams))).first()
        assert row["driverId"] == "max" and want in [row[c] for c in row.asDict() if "onstructor" in c] + [None]
