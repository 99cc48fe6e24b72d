"""op13_negatives: hard negatives of every fiftieth vector."""

from __future__ import annotations

from pyspark.sql import functions as F

from daybook.llm import hard_negatives
from daybook.llm.registry import query, table

SQL = """with vectors as (select row_number() over () as r, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
    list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings where label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scores as (select a.r, a.vec_id as anchor_id, a.label = b.label as same, b.vec_id as id, cast(list_dot_product(a.v, b.v) as bigint) as score
  from vectors a join vectors b on a.r <> b.r where a.vec_id % 50 = 0),
positives as (select *, row_number() over (partition by r order by score desc, id) as k from scores where same qualify k <= 5)
select p.anchor_id, p.id as positive_id, cast(row_number() over (partition by p.r, p.k order by n.score desc, n.id) as integer) as rank,
  n.id as negative_id, p.score as positive_score, n.score as negative_score
from positives p join scores n on p.r = n.r and not n.same and 50 * p.score <= 100 * n.score and 100 * n.score <= 95 * p.score
qualify rank <= 3"""


@query("op13_negatives", SQL)
def op13_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", "embedding")
    turned = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(vectors.withColumn("label", turned), F.col("vec_id") % 50 == 0)
