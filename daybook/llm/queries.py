"""Queries of the operators over whole tables, with production parameters."""

from __future__ import annotations

from daybook.llm import (  # noqa: F401
    query_copies,
    query_fingerprints,
    query_licences,
    query_mixture,
    query_negatives,
    query_passages,
    query_pipeline,
    query_preference,
    query_quality,
    query_repeats,
    query_revisits,
    query_shards,
    query_spelling,
    query_tokens,
)
from daybook.llm.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
