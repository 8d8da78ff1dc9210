"""Conformed race tables: derive once, write, reuse in every later application.

The race tables are an ingest product (the reference lands them as files and
every job reads them back).  Here one conform pass derives them from the
given tables, each step reading the previous step's written output, and
publishes them below the shared folder under the stamp of their input (see
:mod:`pitwall.sources.commit`): a table without manifest is not read, a
finished one is derived by no later application.  Downstream plans start
from short lineage, prune columns and seasons at the scan, and a lost
executor costs a re-read of Parquet rather than a recompute of the joins.

Fact tables are partitioned by season and bucketed by (round, driver), so
that joins and windows of one race's driver need no exchange of them.
"""

from __future__ import annotations

import json
import os
import threading
import uuid
from collections import defaultdict
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.session import input_stamp
from pitwall.sources import fixtures as fx
from pitwall.sources.commit import Files, publish, shared_root

#: Layout of the stored tables; raise it when tables are derived or stored in another way.
VERSION = 5

#: The given tables that the race tables come from.
INPUTS = ("lineitem", "orders", "supplier", "nation")

#: Per table: the conformed tables it is made from, and how.
RECIPES: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {
    "laps": ((), fx.laps),
    "circuits": ((), fx.circuits),
    "lap_times": (("laps",), fx.lap_times_from),
    "pit_stops": (("laps",), fx.pit_stops_from),
    "entries": (("laps",), fx.entry_rollup_from),
    "weather": (("laps",), fx.weather_from),
    "qualifying": (("entries",), fx.qualifying_from),
    "race_results": (("entries",), fx.race_results_from),
    "races": (("entries",), fx.races_from),
    "driver_standings": (("race_results",), lambda r: fx.standings_from(r, "driverId")),
    "constructor_standings": (("race_results",), lambda r: fx.standings_from(r, "constructorId")),
}
TABLES = tuple(RECIPES)

#: Tables stored in buckets of (round, driver) within each season.
BUCKETED = ("laps", "lap_times", "pit_stops", "qualifying", "race_results")
BUCKET_KEY = ("round", "driverId")
#: Those that are derived in buckets, and need no exchange to be written.
DEALT = ("laps",)


class Store:
    """The conformed tables of one input, each written when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str, root: str | None = None) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        stamp = input_stamp(spark, sf_dir, INPUTS)
        self.root = root or os.path.join(shared_root(spark), "conformed", f"{stamp}-{VERSION}")
        self._locks: dict[str, threading.Lock] = defaultdict(threading.Lock)
        self._done: dict[str, str] = {}
        self.buckets = self._layout()
        # buckets of (round, driver) also bring together rows of equal (season, round, driver, ...)
        spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")

    def _layout(self) -> int:
        """Buckets of this store: the shuffle partitions of the application that began it."""
        files, path = Files(self.spark), os.path.join(self.root, "layout.json")
        files.create(path, json.dumps({"buckets": int(self.spark.conf.get("spark.sql.shuffle.partitions"))}))
        return json.loads(files.read(path))["buckets"]

    def _write(self, name: str, path: str) -> None:
        sources, make = RECIPES[name]
        more = {"buckets": self.buckets} if name in DEALT else {}
        df = make(*map(self.table, sources)) if sources else make(self.spark, self.sf_dir, **more)
        if name in BUCKETED:
            # each task writes one bucket of every season
            table = f"pitwall_new_{uuid.uuid4().hex}"
            dealt = df if name in DEALT else df.repartition(self.buckets, *BUCKET_KEY)
            writer = dealt.write.partitionBy("season").option("path", path)
            writer.bucketBy(self.buckets, *BUCKET_KEY).sortBy(*BUCKET_KEY).format("parquet").saveAsTable(table)
            self.spark.sql(f"drop table {table}")  # the name; the files stay
        elif "season" in df.columns:
            # Seasons come together before the write, and large ones are split again.
            df.hint("rebalance", F.col("season")).write.partitionBy("season").parquet(path)
        else:
            df.write.parquet(path)

    def located(self, name: str) -> str:
        """Path of a table, which is derived and published first if nobody has."""
        with self._locks[name]:
            if name not in self._done:
                self._done[name] = publish(self.spark, self.root, name, lambda path: self._write(name, path))["path"]
            return self._done[name]

    def table(self, name: str) -> DataFrame:
        path = self.located(name)
        if name not in BUCKETED:
            return self.spark.read.parquet(path)
        known = f"pitwall_{os.path.basename(path).replace('-', '_')}"
        with self._locks[name]:
            if not self.spark.catalog.tableExists(known):
                fields = self.spark.read.parquet(path).schema
                columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
                self.spark.sql(f"""create table if not exists {known} ({columns}) using parquet partitioned by (season)
                    clustered by ({', '.join(BUCKET_KEY)}) sorted by ({', '.join(BUCKET_KEY)}) into {self.buckets} buckets
                    location '{path}'""")
                self.spark.sql(f"msck repair table {known}")
        return self.spark.table(known)

    def all_tables(self) -> None:
        """Write every table; independent ones are submitted together."""
        with ThreadPoolExecutor(max_workers=len(TABLES)) as pool:
            list(pool.map(self.located, TABLES))


_STORES: dict[tuple[str, str], Store] = {}
_LOCK = threading.Lock()


def store(spark: SparkSession, sf_dir: str) -> Store:
    """The store of an input (a new one if the input's files have changed)."""
    key = (spark.sparkContext.applicationId, input_stamp(spark, sf_dir, INPUTS))
    with _LOCK:
        if key not in _STORES:
            _STORES[key] = Store(spark, sf_dir)
        return _STORES[key]


def use(spark: SparkSession, sf_dir: str, root: str) -> Store:
    """Take the tables of an input from the store below ``root`` in this application."""
    key = (spark.sparkContext.applicationId, input_stamp(spark, sf_dir, INPUTS))
    with _LOCK:
        _STORES[key] = Store(spark, sf_dir, root)
        return _STORES[key]


def located(spark: SparkSession, sf_dir: str, name: str) -> tuple[str, str]:
    """(folder, name) of a conformed table's files."""
    return os.path.split(store(spark, sf_dir).located(name))


def conformed_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder with all conformed tables of an input."""
    own = store(spark, sf_dir)
    own.all_tables()
    return own.root


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return store(spark, sf_dir).table(name)
