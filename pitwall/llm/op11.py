"""Query of operator 11: toxicity score of every whole text of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import toxicity
from pitwall.llm.common import table

THRESHOLD = 0.5


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted per document."""
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), THRESHOLD)


QUERIES = {"op11_toxicity": op11_toxicity}
#: A fitted model; tests check restoration against a plain search and held-out accuracy.
ORACLE: dict[str, str] = {}
