"""op1_importance: every document's importance weight and whether the resampling keeps it."""

from __future__ import annotations

from daybook.llm import quality
from daybook.llm.registry import query, table


@query("op1_importance")
def op1_importance(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.resample(docs, table(spark, sf_dir, "labels")).select("doc_id", "log_weight", "gumbel_key", "kept")
