"""Query of operator 3: language-model scores of every whole text of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import lm
from pitwall.llm.common import table


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: token counts, the unigram base score and the model's score."""
    return lm.score_texts(table(spark, sf_dir, "documents"))


QUERIES = {"op3_lm_score": op3_lm_score}
#: A trained model; tests check the base score exactly and the probabilities' sums.
ORACLE: dict[str, str] = {}
