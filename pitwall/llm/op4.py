"""Query of operator 4: near-duplicate components of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import near
from pitwall.llm.common import table


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: size of its shingle set, its component and whether it stays."""
    return near.near_components(table(spark, sf_dir, "documents"))


QUERIES = {"op4_minhash_near_dedup": op4_minhash_near_dedup}
#: Components are iterative; tests compare with a brute-force version.
ORACLE: dict[str, str] = {}
