"""Incremental ingest of landed pages with Structured Streaming.

New page files arriving in a folder are picked up by a file stream, run
with ``availableNow`` (process everything present, then stop; rerun to pick
up what landed since).  Each micro-batch is flattened, de-duplicated within
itself, and anti-joined against the rows already written for the races
it touches, so overlapping pages never produce duplicate rows.  Lines that
are no whole page go to a rejects table, one folder per micro-batch, which a
repeated batch replaces.  No
streaming de-duplication state is kept: the state would grow with every
key ever seen, while the anti join reads only the partitions of the
races in the batch.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.sources.landed import flatten_laps, good_pages, judged, rejects

LAP_KEY = ["season", "round", "driverId", "lap"]


def _path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def upsert_batch(batch: DataFrame, out: str, key: list[str]) -> None:
    """Append the batch's rows whose key is not yet in ``out`` (partitioned by season and round).

    The batch is kept for its two uses, and only the partitions of its races are read back.
    """
    spark = batch.sparkSession
    fresh = batch.dropDuplicates(key).persist()
    try:
        if _path_exists(spark, out):
            races = fresh.select("season", "round").distinct().collect()  # at most the races of one batch of pages
            have = spark.read.parquet(out).filter(F.col("season").isin(sorted({r[0] for r in races}))
                                                  & F.col("round").isin(sorted({r[1] for r in races}))).select(*key)
            fresh.join(have, key, "left_anti").write.mode("append").partitionBy("season", "round").parquet(out)
        else:
            fresh.write.mode("append").partitionBy("season", "round").parquet(out)
    finally:
        fresh.unpersist()


def ingest_laps(spark: SparkSession, pages_dir: str, out: str, checkpoint: str,
                files_per_batch: int = 64, rejects_dir: str | None = None) -> None:
    """Run the lap-page stream once over everything landed so far."""
    stream = (spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(pages_dir)
              .select("value", F.col("_metadata.file_path").alias("file")))

    def take(batch: DataFrame, epoch: int) -> None:
        lines = judged(batch).persist()
        try:
            upsert_batch(flatten_laps(good_pages(lines)), out, LAP_KEY)
            if rejects_dir:
                rejects(lines).write.mode("overwrite").parquet(os.path.join(rejects_dir, f"batch={epoch}"))
        finally:
            lines.unpersist()

    q = (stream.writeStream
         .foreachBatch(take)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()


def ingested_laps(spark: SparkSession, pages_dir: str, root: str) -> DataFrame:
    out = os.path.join(root, "lap_times")
    ingest_laps(spark, pages_dir, out, os.path.join(root, "_checkpoint"), rejects_dir=os.path.join(root, "rejects"))
    return spark.read.parquet(out).select("season", "round", "driverId", "lap", "position", "time")


def rejected(spark: SparkSession, root: str) -> DataFrame:
    """The rejects of all batches below ``root``."""
    return spark.read.schema("file string, reason string, text string, batch long").parquet(os.path.join(root, "rejects"))
