"""Composed studies and the queries registered for checking."""

from tidemark.plans import queries_entity, queries_ingest, queries_study  # noqa: F401
from tidemark.plans.registry import all_checks, all_queries

__all__ = ["all_checks", "all_queries"]
