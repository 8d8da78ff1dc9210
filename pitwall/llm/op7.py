"""Query of operator 7: quality score of every whole text of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import quality
from pitwall.llm.common import table

THRESHOLD = 0.3


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted per document."""
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), THRESHOLD)


QUERIES = {"op7_quality": op7_quality}
#: A fitted model; tests check held-out accuracy and the sums against numpy.
ORACLE: dict[str, str] = {}
