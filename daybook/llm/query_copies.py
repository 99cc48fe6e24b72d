"""op5_dart: the near-copy class of every document."""

from __future__ import annotations

from daybook.llm import dart
from daybook.llm.registry import query, table


@query("op5_dart")
def op5_dart(spark, sf_dir):
    found, _ = dart.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "class_id")
