"""Query of operator 5: exact nearest rows of ``embeddings`` by whole-number inner product."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import balltree
from pitwall.llm.common import table

BEST = 5


def op5_ball_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """For every row whose vec_id is divisible by 50: its five best other rows."""
    return balltree.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, BEST)


QUERIES = {"op5_ball_tree_top_k": op5_ball_tree_top_k}
ORACLE = {"op5_ball_tree_top_k": f"""
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as v from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id and len(q.v) = len(c.v)),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from s)
select query_id, rank, vec_id, score from r where rank <= {BEST}"""}
