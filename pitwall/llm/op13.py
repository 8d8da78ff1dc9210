"""Query of operator 13: phrase collocations of every whole text of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitwall.llm import phrases
from pitwall.llm.common import table


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's first 2000 phrases of 2 to 5 words: lang, rank, phrase, a, l, r, n, score."""
    return phrases.collocations(table(spark, sf_dir, "documents"))


QUERIES = {"op13_collocations": op13_collocations}

ORACLE = {"op13_collocations": r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as w from pieces),
totals as (select lang, cast(sum(len(w)) as bigint) as n from worded group by lang),
grams as (
  select lang, k, array_to_string(w[i:i + k - 1], ' ') as phrase
  from (select lang, w, k, unnest(range(1, len(w) - k + 2)) as i from worded, (select unnest([1, 2, 3, 4, 5]) as k) where len(w) >= k)),
freq as (select lang, k, phrase, cast(count(*) as bigint) as a from grams group by all having count(*) >= 100),
split as (select *, string_split(phrase, ' ') as w from freq),
inside as (
  select lang, sub, max(a) as longer from (
    select lang, a, unnest([array_to_string(w[1:k - 1], ' '), array_to_string(w[2:k], ' ')]) as sub from split where k > 2) group by all),
cuts as (
  select s.lang, s.phrase, s.a, c.k as k, array_to_string(s.w[1:c.k], ' ') as lp, array_to_string(s.w[c.k + 1:s.k], ' ') as rp
  from split s, (select unnest([1, 2, 3, 4]) as k) c where s.k >= 2 and c.k < s.k),
scored as (
  select c.lang, c.phrase, c.a, c.k, x.a as l, y.a as r, t.n,
    (1000::hugeint * c.a * t.n) // (x.a::hugeint * y.a) as score
  from cuts c join freq x on x.lang = c.lang and x.phrase = c.lp join freq y on y.lang = c.lang and y.phrase = c.rp
  join totals t on t.lang = c.lang),
best as (select *, row_number() over (partition by lang, phrase order by score, k) as cut from scored),
kept as (
  select b.* from best b left join inside i on i.lang = b.lang and i.sub = b.phrase
  where b.cut = 1 and (i.longer is null or 100 * i.longer < 100 * b.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from kept)
select lang, cast(rank as bigint) as rank, phrase, a, l, r, n, cast(score as bigint) as score from ranked where rank <= 2000"""}
