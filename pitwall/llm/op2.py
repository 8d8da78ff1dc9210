"""Query of operator 2: preference pairs from ``conversations``.

The table marks no preferences, so each conversation is the chosen side of a pair, and the same
turns with the last assistant's answer exchanged for its neighbour's (of ids 2n and 2n + 1) are
the rejected side.  Up to that answer both sides agree: those turns are the prompt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitwall.llm import chat
from pitwall.llm.common import table


def op2_preference_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per conversation: prompt, completions and learned spans (as text: start:stop, comma-separated)."""
    out = chat.formatted(chat.exchanged(table(spark, sf_dir, "conversations")))
    for side in ("chosen_spans", "rejected_spans"):
        out = out.withColumn(side, F.array_join(F.transform(side, lambda s: F.concat_ws(":", s["start"], s["stop"])), ","))
    return out


def _side(name: str) -> str:
    turns = f"{name}[p + 1:]"
    size = "len(x.role) + len(x.text) + 13"
    return f"""array_to_string(list_transform({turns}, lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') as {name},
  array_to_string(list_transform(list_filter(generate_series(1, len({turns})), lambda i: {turns}[i].role = 'assistant'),
    lambda i: (coalesce(list_sum(list_transform({turns}[1:i - 1], lambda x: {size})), 0)::int + 5 + len({turns}[i].role))::varchar || ':' ||
              (list_sum(list_transform({turns}[1:i], lambda x: {size})))::int::varchar), ',') as {name}_spans,
  len({turns})::int as {name}_turns"""


QUERIES = {"op2_preference_pairs": op2_preference_pairs}
ORACLE = {"op2_preference_pairs": f"""
with t as (
  select conv_id as pair_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations),
l as (select pair_id, max({{'turn': turn, 'role': role, 'text': text}}) as last from t where role = 'assistant' group by pair_id),
e as (select l.pair_id, l.last, coalesce(o.last.text, '') as other
      from l left join l o on o.pair_id = l.pair_id + 1 - 2 * (l.pair_id % 2)),
b as (select t.*, case when e.last = {{'turn': t.turn, 'role': t.role, 'text': t.text}} then e.other else t.text end as instead
      from t left join e on e.pair_id is not distinct from t.pair_id),
g as (
  select pair_id, list({{'role': role, 'text': text}} order by turn, role, text) as chosen,
         list({{'role': role, 'text': instead}} order by turn, role, instead) as rejected from b group by pair_id),
q as (
  select *, least(len(chosen), len(rejected)) as both,
         coalesce(list_min(list_filter(generate_series(1, least(len(chosen), len(rejected))),
                                       lambda i: chosen[i] <> rejected[i])) - 1, least(len(chosen), len(rejected))) as p from g)
select pair_id, p::int as prompt_turns,
  array_to_string(list_transform(chosen[1:p], lambda x: '<|' || x.role || '|>' || chr(10) || x.text || '<|end|>' || chr(10)), '') as prompt,
  {_side('chosen')},
  {_side('rejected')}
from q"""}
