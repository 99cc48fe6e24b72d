"""Runnable queries over the order-line tables, each next to the SQL that must give the same rows."""

from daybook.plans.catalog import (  # noqa: F401 - importing registers the queries
    aggregates,
    answers,
    files,
    jobs,
    joins,
    modelling,
    projections,
    scalars,
    tables,
    windows,
)
from daybook.plans.catalog.base import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
