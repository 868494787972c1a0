"""Registered queries, one or more per operator, each with reference SQL where SQL can say it."""

from care_episodes.queries import core, registry, statistics, study  # noqa: F401
from care_episodes.queries.base import QUERIES

__all__ = ["QUERIES"]
