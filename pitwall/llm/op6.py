"""Query of operator 6: exact copies of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import exact
from pitwall.llm.common import table


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document: who stays of its group, the group's size, the digest."""
    found = exact.dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


QUERIES = {"op6_exact_dedup": op6_exact_dedup}
ORACLE = {"op6_exact_dedup": r"""
with d as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size,
       doc_id is not distinct from min(doc_id) over w as kept, text_sha256
from d window w as (partition by text_sha256)"""}
