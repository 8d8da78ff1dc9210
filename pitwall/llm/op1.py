"""Query of operator 1: encode and decode every whole text of ``documents``."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import bpe
from pitwall.llm.common import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str, path: str = VOCABULARY) -> DataFrame:
    """Per document: token count, digest of the ids, digest of the decoded text."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.round_trip(docs, path).drop("text"))


QUERIES = {"op1_bpe_round_trip": op1_bpe_round_trip}
#: SQL has no BPE; tests compare with the tokenizers library.
ORACLE: dict[str, str] = {}
