"""Incremental ingest: a second run over overlapping pages adds no duplicate rows."""

import os

from pitwall.plans.base_tables import RaceTables
from pitwall.session import scratch_path
from pitwall.sources.landed import landed_paths
from pitwall.streaming.ingest import ingest_laps

SF = "/root/testdata/sf0.001"


def test_second_ingest_is_idempotent(spark):
    t = RaceTables(spark, SF)
    paths = landed_paths(t)
    root = scratch_path(spark, "stream-test")
    out = os.path.join(root, "lap_times")
    ingest_laps(spark, paths["laps"], out, os.path.join(root, "_ck1"))
    first = spark.read.parquet(out).count()
    ingest_laps(spark, paths["laps_overlap"], out, os.path.join(root, "_ck2"))
    df = spark.read.parquet(out)
    assert first == t.lap_times.count()
    assert df.count() == first
    assert df.select("season", "round", "driverId", "lap").distinct().count() == first
