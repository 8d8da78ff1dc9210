"""Query of operator 9: all sources of ``documents`` mixed to equal weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import mixing
from pitwall.llm.common import table

SEED = 9


def op9_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each copy that the mixture holds: document, source, copy number, copies, shuffle key."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.mix(docs, seed=SEED)


def op9_mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each copy as the whole document: all columns of the table, copy number, copies, shuffle key."""
    return mixing.mix(table(spark, sf_dir, "documents"), seed=SEED)


QUERIES = {"op9_mix_documents": op9_mix_documents, "op9_mix_sources": op9_mix_sources}
ORACLE = {"op9_mix_sources": f"""
with recursive per as (
  select source, count(*) as n, (select count(*) from documents) * 1.0::double as total,
         (select count(distinct coalesce(source, chr(1))) from documents) * 1.0::double as weights
  from documents group by source),
rate as (select source, total * 1.0 / weights / n as rate from per),
split as (select source, rate, greatest(ceil(rate / {mixing.DRAW_RATE}), 1)::int as draws from rate),
step as (
  select source, 0 as k, exp(-(rate / draws)) as p, exp(-(rate / draws)) as total, rate / draws as mean from split
  union all
  select source, k + 1, p * mean / (k + 1), total + p * mean / (k + 1), mean from step
  where k < ceil(mean + 12 * sqrt(mean) + 24)),
drawn as (
  select d.doc_id, d.source, s.draws,
         ('0x' || substr(md5('{SEED}|' || coalesce(d.doc_id::varchar, '') || '|' || i), 1, 13))::bigint
           / 4503599627370496.0::double as u
  from documents d join split s on d.source is not distinct from s.source,
       lateral (select unnest(generate_series(1, s.draws)) as i)),
counted as (
  select doc_id, source, sum((select count(*) from step t
      where t.source is not distinct from x.source and t.total <= x.u))::int as copies
  from drawn x group by doc_id, source)
select doc_id, source, copy::int as copy, copies,
       md5('{SEED}s|' || coalesce(doc_id::varchar, '') || '|' || copy) as shuffle_key
from (select *, unnest(generate_series(1, copies)) as copy from counted where copies > 0)"""}

#: Rows that repeat an id are copied row by row here, so that each brings its own text.
ORACLE["op9_mix_documents"] = f"""
with copies as ({ORACLE["op9_mix_sources"]}),
once as (select distinct * from copies)
select d.*, c.copy, c.copies, c.shuffle_key
from documents d join once c on d.doc_id is not distinct from c.doc_id and d.source is not distinct from c.source"""
