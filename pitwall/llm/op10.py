"""Query of operator 10: repeated strings of 200 bytes leave ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import repeats
from pitwall.llm.common import table


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: bytes, removed bytes and runs, digest of what is left."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("removed", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


QUERIES = {"op10_suffix_dedup": op10_suffix_dedup}
#: SQL has no substring index; tests compare with a brute-force version.
ORACLE: dict[str, str] = {}
