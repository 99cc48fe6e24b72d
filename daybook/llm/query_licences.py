"""op10_licences: licence notices and texts in every document."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import functions as F

from daybook.llm import licences
from daybook.llm.registry import query, table


def _templates() -> str:
    rows = []
    for name, text in sorted(licences.TEMPLATES.items()):
        counts = Counter(licences.bigrams(text))
        size = sum(counts.values())
        rows += [f"('{name}', '{g}', {n}, {size}, {licences.bounds(size, licences.LEAST)[1]})" for g, n in sorted(counts.items())]
    return ",\n    ".join(rows)


# hits: the places of a template's bigrams; `before` is the place at which the template has used up the bigram.
# found: from each first place the best run; list_reduce then goes from left to right and keeps the better of two that overlap.
SQL = f"""with templates as (select * from (values {_templates()}) t(name, g, times, size, most)),
texts as (select doc_id, string_split(trim(regexp_replace(translate(coalesce(text, ''), '{licences.UPPER}', '{licences.LOWER}'),
  '[^0-9a-z]+', ' ', 'g')), ' ') as w from documents),
places as (select doc_id, unnest(range(0, len(w) - 1)) as p, w from texts),
grams as (select doc_id, p, w[p + 1] || ' ' || w[p + 2] as g from places),
numbered as (select doc_id, name, p, g, times, size, most, row_number() over (partition by doc_id, name, g order by p) as o
  from grams join templates using (g)),
hits as (select a.doc_id, a.name, a.p, a.size, a.most, coalesce(b.p, -1) as before
  from numbered a left join numbered b on a.doc_id = b.doc_id and a.name = b.name and a.g = b.g and b.o = a.o - a.times),
near as (select s.doc_id, s.name, s.p as first, e.p as last, s.size, e.before
  from hits s join hits e on s.doc_id = e.doc_id and s.name = e.name and e.p >= s.p and e.p - s.p < s.most),
runs as (select doc_id, name, first, last, size,
  sum(case when before < first then 1 else 0 end) over (partition by doc_id, name, first order by last) as c from near),
scored as (select doc_id, name, first, last, cast(2 * c as double) / (last - first + 1 + size) as dice from runs),
found as (select doc_id, name, first, last + 1 as last, dice from scored where dice >= {licences.LEAST}
  qualify row_number() over (partition by doc_id, name, first order by dice desc, last) = 1),
lists as (select doc_id, name, list([{{'a': first, 'b': last, 'd': dice}}] order by first) as l from found group by doc_id, name),
kept as (select doc_id, name, list_reduce(l, lambda x, y: case when y[1].a > x[-1].b then list_concat(x, y)
  when y[1].d > x[-1].d then list_concat(x[1:len(x) - 1], y) else x end) as m from lists),
matches as (select doc_id, name, unnest(m).d as dice from kept),
found_docs as (select doc_id, count(*) as n, string_agg(distinct name, ',' order by name) as names, max(dice) as best
  from matches group by doc_id)
select d.doc_id, cast(coalesce(n, 0) as bigint) as n_matches, coalesce(names, '') as licences, round(best, 6) as best_dice
from documents d left join found_docs f on d.doc_id = f.doc_id"""


@query("op10_licences", SQL)
def op10_licences(spark, sf_dir):
    found = licences.scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id",
        F.size("licences").cast("long").alias("n_matches"),
        F.array_join(F.array_sort(F.array_distinct(F.col("licences.name"))), ",").alias("licences"),
        F.round(F.array_max(F.col("licences.dice")), 6).alias("best_dice"),
    )
