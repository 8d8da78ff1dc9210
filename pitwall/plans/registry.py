"""A registry of fitted models that outlives the application.

``root/<model>/<version>-<id>`` holds a saved pipeline (its fitted features included) and
``root/<model>/<version>.json`` its manifest: input stamp, parameters, metrics.  The manifest
is created last (see :mod:`pitwall.sources.commit`), so a version without one does not exist.
Versions are times, so that the latest sorts last.
"""

from __future__ import annotations

import os
import time

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from pitwall.sources.commit import manifest, publish, published, shared_root


class ModelRegistry:
    """Models below ``root``: the folder that the user names, ``spark.pitwall.models``, or one in the shared folder."""

    def __init__(self, spark: SparkSession, root: str | None = None) -> None:
        self.spark = spark
        self.root = root or spark.conf.get("spark.pitwall.models", None) or os.path.join(shared_root(spark), "models")

    def save(self, model: PipelineModel, name: str, stamp: str = "", params: dict | None = None, metrics: dict | None = None) -> str:
        """Write the model aside, then publish it as the next version; its path."""
        version = f"{time.strftime('%Y%m%d_%H%M%S', time.gmtime())}_{time.time_ns() % 10**9:09d}"
        facts = {"model": name, "stamp": stamp, "params": params or {}, "metrics": metrics or {}}
        return publish(self.spark, os.path.join(self.root, name), version, lambda path: model.write().save(path), facts)["path"]

    def versions(self, name: str, stamp: str | None = None) -> list[dict]:
        """Manifests of the whole versions, oldest first; of one input only, if ``stamp`` says so."""
        folder = os.path.join(self.root, name)
        found = [manifest(self.spark, folder, v) for v in published(self.spark, folder)]
        return [m for m in found if m and stamp in (None, m["stamp"])]

    def latest(self, name: str, stamp: str | None = None) -> PipelineModel:
        """The latest whole version."""
        found = self.versions(name, stamp)
        if not found:
            raise FileNotFoundError(f"no model {name} in {self.root}")
        return PipelineModel.load(found[-1]["path"])

    def table(self, name: str) -> DataFrame:
        """One row per version: parameters and metrics as the manifests state them."""
        rows = [(m["model"], m["name"], m["stamp"], {k: str(v) for k, v in m["params"].items()},
                 {k: float(v) for k, v in m["metrics"].items()}) for m in self.versions(name)]
        return self.spark.createDataFrame(
            rows, "model string, version string, stamp string, params map<string,string>, metrics map<string,double>")
