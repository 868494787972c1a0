"""Pregnancy episodes from clinical event tables, as Spark DataFrame operators."""

from care_episodes.config import EpisodeConfig
from care_episodes.functions.rules import Rules

__all__ = ["EpisodeConfig", "Rules"]
