"""Benchmark the headline queries; prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query runs its full plan into Spark's ``noop`` sink (no driver-side
collection).  ``conform`` is the one-off ingest that derives and writes the
race tables; every later query starts from those tables, as a production
job would.  The ``view_*`` queries derive their table from the raw tables
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "view_laps", "view_lap_times", "view_pit_stops", "view_qualifying", "view_race_results",
    "view_driver_standings", "view_weather",
    "time_to_ms", "lap_features", "podium_base", "podium_features", "pole_features",
    "season_validation", "podium_set_eval", "roc_auc", "classification_report", "race_ranking",
    "nb_lap_lags", "ml_podium_forest", "ml_season_validation", "ml_race_prediction",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from pitwall import catalog
    from pitwall.functions.timing import time_to_ms
    from pitwall.plans import base_tables as bt
    from pitwall.plans.base_tables import RaceTables
    from pitwall.session import build_session
    from pitwall.session import scratch_path
    from pitwall.sources import conform

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    times: dict[str, float] = {}
    # Stores and models outlive an application: begin with new ones, so that deriving and training are timed.
    spark.conf.set("spark.pitwall.models", scratch_path(spark, "models"))
    t0 = time.time()
    conform.use(spark, sf_dir, scratch_path(spark, "conformed")).all_tables()
    times["conform"] = round(time.time() - t0, 3)
    # The base table and the time parse from the given tables, without the conformed store.
    raw = RaceTables(spark, sf_dir, conformed=False)
    builders = {"raw_podium_base": lambda: bt.podium_base(raw),
                "raw_time_to_ms": lambda: raw.lap_times.select("season", "round", "driverId", "lap", time_to_ms("time").alias("ms"))}
    builders |= {k: (lambda k=k: catalog.QUERIES[k](spark, sf_dir)) for k in HEADLINE}
    for key, build in builders.items():
        t0 = time.time()
        df = build()
        df.write.format("noop").mode("overwrite").save()
        times[key] = round(time.time() - t0, 3)
    sf = os.path.basename(os.path.normpath(sf_dir)).replace("sf", "")
    print(json.dumps({"metric": "headline_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
