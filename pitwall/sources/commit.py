"""Commit protocol for durable tables and models.

What is kept beyond one application is written aside, under a name of its own, and published
by creating a small manifest last.  A reader goes by manifests only, so that a folder whose
writer died is never taken for a whole one; a manifest is created, never replaced, so that of
two writers the first is right and the other drops its own copy.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

from pitwall.session import ensure_checkpoint_dir


def shared_root(spark: SparkSession) -> str:
    """The folder that all applications share: ``spark.checkpoint.dir`` itself (the checkpoint
    folder of one application lies below it)."""
    own = ensure_checkpoint_dir(spark)
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return os.path.join((named or os.path.dirname(own.rstrip("/"))).rstrip("/"), "pitwall")


class Files:
    """The few operations on Spark's file systems that the protocol needs."""

    def __init__(self, spark: SparkSession) -> None:
        self.jvm, self.conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self.jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def read(self, path: str) -> str:
        fs, p = self._at(path)
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def create(self, path: str, text: str) -> bool:
        """Create a file with this text; False if there is one already."""
        fs, p = self._at(path)
        if fs.exists(p):
            return False
        try:
            out = fs.create(p, False)
        except Exception:  # noqa: BLE001 - another writer was first, or the folder can't be written
            if fs.exists(p):
                return False
            raise
        try:
            out.write(text.encode())
        finally:
            out.close()
        return True

    def move(self, old: str, new: str) -> None:
        fs, p = self._at(old)
        target = self.jvm.org.apache.hadoop.fs.Path(new)
        fs.mkdirs(target.getParent())
        if not fs.rename(p, target):
            raise OSError(f"cannot move {old} to {new}")

    def drop(self, path: str) -> None:
        fs, p = self._at(path)
        if fs.exists(p):
            fs.delete(p, True)


def manifest(spark: SparkSession, folder: str, name: str) -> dict | None:
    """The manifest of ``name``, with the path of its data; None if it has not been published."""
    files, path = Files(spark), os.path.join(folder, f"{name}.json")
    if not files.exists(path):
        return None
    try:
        facts = json.loads(files.read(path))
        return {**facts, "path": os.path.join(folder, facts["data"])}
    except (ValueError, KeyError):  # its writer has not finished
        return None


def publish(spark: SparkSession, folder: str, name: str, write: Callable[[str], object], facts: dict | None = None) -> dict:
    """Write aside with ``write(path)`` and publish as ``name``; the manifest that holds."""
    known = manifest(spark, folder, name)
    if known:
        return known
    data = f"{name}-{uuid.uuid4().hex}"
    path = os.path.join(folder, data)
    write(path)
    text = json.dumps({**(facts or {}), "name": name, "data": data, "created": time.strftime("%Y-%m-%dT%H:%M:%SZ", time.gmtime())})
    files = Files(spark)
    if not files.create(os.path.join(folder, f"{name}.json"), text):
        other = manifest(spark, folder, name)
        if other:
            files.drop(path)
            return other
    return {**json.loads(text), "path": path}


def published(spark: SparkSession, folder: str) -> list[str]:
    """Names that have been published in a folder, ascending."""
    return [n[:-5] for n in Files(spark).names(folder) if n.endswith(".json") and manifest(spark, folder, n[:-5])]
