"""Operators of a training-data pipeline: selection, near copies, benchmark passages, tokens, shards and records."""
