"""Session construction and shared-storage helpers.

Everything that needs durable intermediate storage (lineage cuts, landed
pages, sink round trips, saved models) goes below the folder named by
``spark.checkpoint.dir``.  On a cluster that setting names shared storage;
only when it is unset (local tests, the smoke driver) do we create one.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings that matter at scale; every one is a plain Spark conf.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "pitwall", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", "16g")
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def _is_local(master: str) -> bool:
    return master == "local" or master.startswith("local[")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder.

    Only a single-machine session (tests, smoke runs) may leave it unset and gets a
    temporary folder; on a cluster a folder of one machine would not do, so that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not conf_dir:
        if not _is_local(sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="pitwall-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder, scheme kept."""
    return os.path.join(ensure_checkpoint_dir(spark), "pitwall", f"{name}-{uuid.uuid4().hex[:12]}")


def input_stamp(spark: SparkSession, sf_dir: str, tables: tuple[str, ...]) -> str:
    """Path and change times of input tables: what is kept per input is rebuilt when they change."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    parts = [sf_dir.rstrip("/")]
    for t in tables:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/{t}.parquet")
        fs = path.getFileSystem(conf)
        files = list(fs.listStatus(path)) if fs.exists(path) else []
        parts += [f"{t}:{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in files]
    return hashlib.md5("|".join(parts).encode()).hexdigest()[:12]


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (never a local checkpoint)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
