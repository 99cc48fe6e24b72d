"""op12_spelling: spelling variants among the words of all documents."""

from __future__ import annotations

from daybook.llm import spelling
from daybook.llm.registry import query, table


@query("op12_spelling")
def op12_spelling(spark, sf_dir):
    return spelling.groups(spelling.word_counts(table(spark, sf_dir, "documents"), "doc_id", "text"))
