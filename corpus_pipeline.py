"""Training-corpus pipeline: quality, exact copies, near copies, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; all but the last
return the columns of ``documents``.  ``run`` writes each stage's rows below the
shared checkpoint folder and reads them back as the next stage's documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import bpe, exact, mixing, near, quality
from pitwall.llm.common import table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Documents with a lower quality score go.
LEAST_QUALITY = 0.3
#: Near copies share four fifths of their five-word shingles; a pair at that similarity misses all bands with 3.0e-6.
NEAR = near.Similarity((80, 100), bands=32, rows=5, step=32)
SEED = 9
VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


MARK = "__mark"


def _marked(docs: DataFrame) -> DataFrame:
    """The documents with their texts' digests, so that rows without id or with a repeated one can be told apart."""
    return docs.select(*COLUMNS,
                       F.unhex(F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)).alias(MARK))


def _staying(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of marked ``docs`` whose id and text are among ``kept``; a null id is an id like others here."""
    kept = kept.select(F.col("doc_id").alias("__id"), F.col(MARK).alias("__kept")).distinct()
    own = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col(MARK) == F.col("__kept"))
    return docs.join(kept, own, "left_semi").select(*COLUMNS)


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts, row by row.

    A null text is scored as an empty one, and rows without id or with a repeated one are judged by
    their own text; repeated rows share one fate; an empty table stays empty."""
    docs = _marked(docs)
    scored = quality.classify(docs, table(spark, sf_dir, "labels"), LEAST_QUALITY, mark=MARK)
    return _staying(docs, scored.where("predicted = 1"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts: of the smallest id (null ids last), and of rows that
    repeat it the smallest by text, lang, source and n_chars.

    A null text equals an empty one; an empty table stays empty."""
    kept = exact.dedup(docs).where("kept").select("doc_id", "digest").distinct()
    rows = exact.text_digests(docs)
    own = rows["doc_id"].eqNullSafe(kept["doc_id"]) & (rows["digest"] == kept["digest"])
    one = F.min(F.struct(*[c for c in COLUMNS if c != "doc_id"])).alias("row")
    return rows.join(kept, own, "left_semi").groupBy("doc_id", "digest").agg(one).select("doc_id", "row.*").select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: the one with the smallest id.

    Texts without words are linked with nothing and stay; rows without id are judged by their own
    text; an empty table stays empty."""
    docs = _marked(docs)
    return _staying(docs, near.near_components(docs, like=NEAR, mark=MARK).where("kept"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents such that every source has the same weight, globally shuffled.

    A null source is a source of its own; rows that repeat an id get the same number of copies; an
    empty table stays empty."""
    return mixing.mix(docs, seed=SEED).select(*COLUMNS)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every whole text, and whether decoding them gives the text back.

    A null text has no tokens; every row has its own result, repeated ones too."""
    out = bpe.round_trip(docs, VOCABULARY)
    same = F.col("decoded") == F.coalesce(F.col("text"), F.lit(""))
    return out.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids", same.alias("round_trip"))


STAGES = [
    ("quality", quality_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("mixing", mixing_stage),
    ("bpe", encoding_stage),
]

#: The quality and near-duplicate stages are no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
