"""Store-day sales analytics written as lazy Spark DataFrame transformations."""

from daybook.config import EngineConfig

__all__ = ["EngineConfig"]
