"""op2_preference: every conversation against itself with the last answer of its neighbour.

Neighbours are the conversations whose ids differ in the last bit; without a neighbour's answer the rejected side ends
before the last answer.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import preference
from daybook.llm.registry import query, table

_RENDERED = "'<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10)"
_MASK = """repeat('0', length('<|' || coalesce(role, '') || '|>' || chr(10))) ||
    repeat(case when role = 'assistant' then '1' else '0' end, length(coalesce(text, '') || '<|end|>' || chr(10)))"""

SQL = f"""with last as (select conv_id, max(turn) as at from conversations where role = 'assistant' and conv_id is not null group by conv_id),
answer as (select c.conv_id, max(c.text) as text from conversations c join last l on c.conv_id = l.conv_id and c.turn = l.at
  where c.role = 'assistant' group by c.conv_id),
sides as (
  select conv_id, 'c' as side, turn, role, text from conversations where conv_id is not null
  union all select c.conv_id, 'r', turn, role, text from conversations c left join last l on c.conv_id = l.conv_id
    where c.conv_id is not null and (l.at is null or turn < l.at)
  union all select l.conv_id, 'r', l.at, 'assistant', a.text from last l join answer a on a.conv_id = xor(l.conv_id, 1)),
placed as (select *, row_number() over (partition by conv_id, side order by turn, role, text) as k from sides),
differ as (select coalesce(a.conv_id, b.conv_id) as conv_id, min(coalesce(a.k, b.k)) as k
  from (select * from placed where side = 'c') a full join (select * from placed where side = 'r') b
    on a.conv_id = b.conv_id and a.k = b.k
  where a.k is null or b.k is null or a.role is distinct from b.role or a.text is distinct from b.text group by 1),
parts as (select p.*, case when d.k is null or p.k < d.k then 'p' else side end as part
  from placed p left join differ d on p.conv_id = d.conv_id)
select conv_id,
  coalesce(string_agg(case when part = 'p' and side = 'c' then {_RENDERED} end, '' order by k), '') as prompt,
  cast(count(case when part = 'p' and side = 'c' then 1 end) as bigint) as prompt_turns,
  coalesce(string_agg(case when part = 'c' then {_RENDERED} end, '' order by k), '') as chosen,
  coalesce(string_agg(case when part = 'c' then {_MASK} end, '' order by k), '') as chosen_mask,
  coalesce(string_agg(case when part = 'r' then {_RENDERED} end, '' order by k), '') as rejected,
  coalesce(string_agg(case when part = 'r' then {_MASK} end, '' order by k), '') as rejected_mask,
  cast(coalesce(max(case when part = 'c' and role = 'assistant' then 1 end), 0)
     * coalesce(max(case when part = 'r' and role = 'assistant' then 1 end), 0) as bigint) as usable
from parts group by conv_id"""


@query("op2_preference", SQL)
def op2_preference(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").where("conv_id is not null")
    answers = (
        turns.where(F.col("role") == preference.ASSISTANT)
        .groupBy("conv_id")
        .agg(F.max(F.struct("turn", "text")).alias("last"))
        .select("conv_id", F.col("last.turn").alias("at"), F.col("last.text").alias("answer"))
    )
    before = turns.join(answers.select("conv_id", "at"), "conv_id", "left").where("at is null or turn < at")
    other = answers.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("answer").alias("text"))
    swapped = answers.select("conv_id", F.col("at").alias("turn"), F.lit("assistant").alias("role")).join(other, "conv_id")
    rejected = before.select("conv_id", "turn", "role", "text").unionByName(swapped)
    pairs = preference.format_preferences(turns, rejected, "conv_id")
    return pairs.withColumns({"prompt_turns": F.col("prompt_turns").cast("long"), "usable": F.col("usable").cast("long")})
