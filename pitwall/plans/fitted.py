"""The feature recipe as a fitted Spark ML stage.

:class:`FeatureFitter` learns the category codes, the medians and which features can be used
from the rows it is given; :class:`FeatureModel` applies them to any rows and is saved and
loaded with the pipeline, so that one season is scored without the training seasons.
"""

from __future__ import annotations

import os

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.ml.util import (DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter,
                             MLReadable, MLReader, MLWritable, MLWriter)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitwall.operators.aggregates import code_of, fit_statistics, impute, with_statistics

STATISTICS = "medians map<string,double>, codes map<string,array<string>>"


class FeatureParams(Params):
    """What a recipe does, apart from what it learns."""

    categories = Param(Params._dummy(), "categories", "category column -> column of its code")
    numeric = Param(Params._dummy(), "numeric", "columns whose NULLs become the median")
    wanted = Param(Params._dummy(), "wanted", "feature columns, in order")
    label = Param(Params._dummy(), "label", "label column; rows without one are dropped where the column is there")
    keep = Param(Params._dummy(), "keep", "columns that go on besides the features and the label")

    def _of(self, param: str):
        return self.getOrDefault(param)


def known_rows(df: DataFrame, cols: list[str], numeric: list[str], label: str | None) -> DataFrame:
    """The complete rows: a feature that is NULL in all fit rows has no median and costs no row (D3)."""
    whole = F.lit(True)
    for c in [*cols, *([label] if label else [])]:
        known = F.col(c).isNotNull()
        whole = whole & (known | F.col("medians")[c].isNull() if c in numeric else known)
    return df.filter(whole)


class FeatureFitter(Estimator, FeatureParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns codes and medians in one pass each; both have a bounded size (one value per
    column, and circuits, teams and pole winners)."""

    @keyword_only
    def __init__(self, *, categories=None, numeric=None, wanted=None, label=None, keep=None) -> None:
        super().__init__()
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> FeatureModel:
        numeric, categories = self._of("numeric"), self._of("categories")
        row = fit_statistics(df, numeric, list(categories)).first()
        present = [c for c in self._of("wanted") if c in df.columns and c not in numeric]
        filled = df.agg(*[F.count(F.col(c)).alias(c) for c in present]).first() if present else {}
        medians = dict(row["medians"])
        usable = [c for c in self._of("wanted")
                  if c in medians or c in categories.values() or (c in present and filled[c])]
        model = FeatureModel(medians, {k: list(v) for k, v in row["codes"].items()}, usable or list(self._of("wanted")))
        return self._copyValues(model)


class FeatureModel(Model, FeatureParams, MLWritable, MLReadable):
    """Applies the learnt codes and medians: ``keep``, the usable features and the label, complete rows only."""

    def __init__(self, medians: dict[str, float] | None = None, codes: dict[str, list[str]] | None = None,
                 usable: list[str] | None = None) -> None:
        super().__init__()
        self.medians, self.codes, self.usable = medians or {}, codes or {}, usable or []

    def statistics(self, df: DataFrame) -> DataFrame:
        return df.sparkSession.createDataFrame([(self.medians, self.codes)], STATISTICS)

    def _transform(self, df: DataFrame) -> DataFrame:
        numeric, categories = self._of("numeric"), self._of("categories")
        label = self._of("label")
        df = with_statistics(df, self.statistics(df))
        df = df.withColumns({out: code_of(c) for c, out in categories.items() if c in df.columns})
        df = df.withColumns(impute([c for c in numeric if c in df.columns]))
        label = label if label in df.columns else None
        cols = [c for c in self._of("wanted") if c in df.columns]
        keep = [c for c in self._of("keep") if c in df.columns]
        return known_rows(df, cols, numeric, label).select(*dict.fromkeys([*keep, *cols, *([label] if label else [])]))

    def decoder(self, df: DataFrame, column: str) -> DataFrame:
        """(code, value) of a category column, for a join back from codes."""
        one = self.statistics(df).select(F.posexplode(F.col("codes")[column]).alias("code", "value"))
        return one

    def write(self) -> MLWriter:
        return _FeatureModelWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _FeatureModelReader(cls)


class _FeatureModelWriter(MLWriter):
    def __init__(self, model: FeatureModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        spark = self.sparkSession
        DefaultParamsWriter.saveMetadata(self.model, path, spark, extraMetadata={"usable": self.model.usable})
        one = spark.createDataFrame([(self.model.medians, self.model.codes)], STATISTICS)
        one.coalesce(1).write.parquet(os.path.join(path, "statistics"))


class _FeatureModelReader(MLReader):
    def __init__(self, cls: type) -> None:
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> FeatureModel:
        spark = self.sparkSession
        facts = DefaultParamsReader.loadMetadata(path, spark)
        row = spark.read.schema(STATISTICS).parquet(os.path.join(path, "statistics")).first()
        model = self.cls(dict(row["medians"]), {k: list(v) for k, v in row["codes"].items()}, list(facts["usable"]))
        model._resetUid(facts["uid"])
        DefaultParamsReader.getAndSetParams(model, facts)
        return model
