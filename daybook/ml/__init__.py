"""Spark ML training, evaluation and scoring."""
