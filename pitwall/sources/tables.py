"""Table scans and sinks.

Season-partitioned tables are read with one scan; the season list becomes a
partition filter, never a per-season loop.  Appended seasons are committed one
by one: staged aside, moved into place, and marked last, so that a season whose
writer died is neither read nor taken for landed.
"""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitwall.sources.commit import Files

#: Folder of a table with one small file per committed season (Spark's scans skip it).
COMMITTED = "_committed"


def driver_table(spark: SparkSession, sf_dir: str, name: str,
                 columns: list[str] | None = None) -> DataFrame:
    """Read one of the given parquet tables, keeping only ``columns``."""
    df = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """A missing source is an empty table of the declared schema."""
    return spark.createDataFrame([], schema)


def committed(spark: SparkSession, root: str, table: str) -> list | None:
    """The seasons whose marker is there; None for a table that was written as a whole."""
    files, folder = Files(spark), os.path.join(root, table, COMMITTED)
    if not files.exists(folder):
        return None
    found = []
    for name in files.names(folder):
        try:
            found.append(json.loads(files.read(os.path.join(folder, name)))["season"])
        except (ValueError, KeyError):  # its writer did not finish
            continue
    return sorted(found)


def scan_table(spark: SparkSession, root: str, table: str, schema: StructType,
               fmt: str = "parquet", seasons: list[int] | None = None,
               columns: list[str] | None = None) -> DataFrame:
    """Scan ``root/table`` (partitioned by season) with a declared schema.

    Absent path -> empty frame of the schema.  ``seasons`` becomes a
    partition-pruning predicate; ``columns`` a column-pruning projection.
    Of a table with committed seasons only those are read.
    """
    path = os.path.join(root, table)
    known = committed(spark, root, table)
    if known == [] or not Files(spark).exists(path):
        df = empty_like(spark, schema)
    else:
        reader = spark.read.schema(schema)
        if fmt == "csv":
            reader = reader.option("header", "true")
        df = reader.format(fmt).load(path)
        if known:
            df = df.filter(F.col("season").isin(known))
    if seasons is not None:
        df = df.filter(F.col("season").isin(list(seasons)))
    if columns:
        df = df.select(*columns)
    return df


def write_table(df: DataFrame, root: str, table: str, fmt: str = "parquet",
                mode: str = "overwrite", partition_by: tuple[str, ...] = ("season",)) -> str:
    """Partitioned sink.  ``overwrite`` is dynamic per partition."""
    path = os.path.join(root, table)
    (df.write.mode(mode)
       .option("partitionOverwriteMode", "dynamic")
       .option("header", "true")
       .partitionBy(*partition_by)
       .format(fmt).save(path))
    return path


def incremental_append(spark: SparkSession, new: DataFrame, root: str, table: str,
                       schema: StructType, key: str = "season") -> DataFrame:
    """Append only the seasons that have not landed; returns the appended rows.

    The rows are staged aside in one write; then each season replaces what a dead writer may
    have left in its place and is marked.  A crash at any point leaves committed seasons whole
    and the others to the next append.  Seasons of a table that was written as a whole count as
    landed.  Rows without a season don't land.
    """
    files, path = Files(spark), os.path.join(root, table)
    done = committed(spark, root, table)
    if done is None:
        done = [r[0] for r in scan_table(spark, root, table, schema).select(key).distinct().collect()]  # one row a season
        for season in done:
            _mark(files, path, season)
    staged = os.path.join(path, f"_staged-{uuid.uuid4().hex}")
    fresh = new.filter(F.col(key).isNotNull() & ~F.col(key).isin(done)) if done else new.filter(F.col(key).isNotNull())
    fresh.write.partitionBy(key).parquet(staged)
    landed = [int(name.split("=", 1)[1]) for name in files.names(staged) if name.startswith(f"{key}=")]
    for season in landed:  # metadata only: two renames' worth of work a season
        place = os.path.join(path, f"{key}={season}")
        files.drop(place)
        files.move(os.path.join(staged, f"{key}={season}"), place)
        _mark(files, path, season)
    files.drop(staged)
    return scan_table(spark, root, table, schema, seasons=landed)


def _mark(files: Files, path: str, season) -> None:
    place = os.path.join(path, COMMITTED, f"{season}.json")
    if not files.create(place, json.dumps({"season": season})):
        files.drop(place)  # a marker whose writer died
        files.create(place, json.dumps({"season": season}))
