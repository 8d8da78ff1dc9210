"""A grid search that can be resumed.

Each (grid point, fold) is a unit: fit on the other fold, score on this one, and record the
metric as a small file in the shared folder.  A rerun reads what is there and fits only what
is missing, in the same application or in another one.

Points whose models are parts of one another (forests of one seed that differ in trees and levels)
are fitted once, with the most of each, and every point is scored on its own part of that model.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.evaluation import Evaluator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.sources.commit import Files

FOLDS = (0, 1)


class Search:
    """The finished units of one search, below ``folder``."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark, self.folder, self.files = spark, folder, Files(spark)

    @staticmethod
    def unit(point: dict, fold: int) -> str:
        return hashlib.md5(json.dumps([point, fold], sort_keys=True).encode()).hexdigest()

    def metric(self, point: dict, fold: int) -> float | None:
        path = os.path.join(self.folder, f"{self.unit(point, fold)}.json")
        try:
            return float(json.loads(self.files.read(path))["metric"]) if self.files.exists(path) else None
        except (ValueError, KeyError):  # its writer did not finish
            self.files.drop(path)
            return None

    def record(self, point: dict, fold: int, metric: float) -> None:
        text = json.dumps({"point": point, "fold": fold, "metric": metric})
        self.files.create(os.path.join(self.folder, f"{self.unit(point, fold)}.json"), text)

    def finished(self) -> DataFrame:
        """One row per finished unit."""
        found = [json.loads(self.files.read(os.path.join(self.folder, n))) for n in self.files.names(self.folder) if n.endswith(".json")]
        rows = [({k: str(v) for k, v in u["point"].items()}, u["fold"], u["metric"]) for u in found]
        return self.spark.createDataFrame(rows, "params map<string,string>, fold int, metric double")

    def run(self, train: DataFrame, make: Callable[[dict], Estimator], points: list[dict], evaluator: Evaluator,
            fold_col: str = "fold", parallelism: int = 4, nested: tuple[str, ...] = ()) -> list[float]:
        """The mean metric of every point; ``train`` has the fold of each row.  ``nested``: the parameters
        by which a model is a part of another one; it is then the last stage of a pipeline."""
        known = {(i, f): self.metric(p, f) for i, p in enumerate(points) for f in FOLDS}

        def fit(group: tuple[list[int], int]) -> None:
            part, fold = group
            model = make({**points[part[0]], **{k: max(points[i][k] for i in part) for k in nested}}).fit(
                train.filter(F.col(fold_col) != fold))
            rows = train.filter(F.col(fold_col) == fold)
            if nested:
                views = [tuple(points[i][k] for k in nested) for i in part]
                scored = model.stages[-1].predictions(PipelineModel(model.stages[:-1]).transform(rows), views)
            else:
                scored = [model.transform(rows)]
            for i, predictions in zip(part, scored, strict=True):
                known[i, fold] = evaluator.evaluate(predictions)
                self.record(points[i], fold, known[i, fold])

        groups: dict[tuple, list[int]] = {}
        for (i, fold), metric in known.items():
            if metric is None:
                alike = json.dumps({k: v for k, v in points[i].items() if k not in nested} if nested else [i], sort_keys=True)
                groups.setdefault((alike, fold), []).append(i)
        if groups:
            with ThreadPoolExecutor(max_workers=parallelism) as pool:
                list(pool.map(fit, [(part, fold) for (_, fold), part in groups.items()]))
        return [sum(known[i, f] for f in FOLDS) / len(FOLDS) for i in range(len(points))]
