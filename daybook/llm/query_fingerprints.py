"""op9_omh: fingerprints of every document, of its edited text, and their likeness."""

from __future__ import annotations

from daybook.llm import order_minhash
from daybook.llm.registry import query, table


@query("op9_omh")
def op9_omh(spark, sf_dir):
    return order_minhash.compare_edits(table(spark, sf_dir, "documents").select("doc_id", "text"))
