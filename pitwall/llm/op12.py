"""Query of operator 12: repair of the damaged ``conversations``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import repair
from pitwall.llm.common import table


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per original conv_id: gaps, faults, cost and audit of the cheapest edits, digest of the repaired text."""
    given = table(spark, sf_dir, "conversations")
    return repair.audited(repair.damaged(given), given)


QUERIES = {"op12_conversation_repair": op12_conversation_repair}
#: The edits are an iterative optimum; tests compare with a search over all edits and a plain programme.
ORACLE: dict[str, str] = {}
