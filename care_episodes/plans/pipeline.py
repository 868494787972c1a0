"""The whole run: extraction, both episode sources, merge, dating."""

from __future__ import annotations

import warnings
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from care_episodes.config import EpisodeConfig
from care_episodes.functions.rules import Rules
from care_episodes.operators.dating import date_episodes, simple_start_dates
from care_episodes.operators.merge import merge_episodes
from care_episodes.operators.outcomes import outcome_episodes
from care_episodes.operators.progression import daily_outcomes, progression_episodes
from care_episodes.session import materialize
from care_episodes.sources.cdm import (
    Tables,
    extract_listed,
    filter_reproductive_age,
    outcome_rows,
    repair_epoch_shift,
    select_persons,
    timing_rows,
)
from care_episodes.sources.rule_files import enrich_domains, unmapped_concepts


@dataclass
class Cohort:
    """Extracted rows of a run."""

    persons: DataFrame
    events: DataFrame
    timing: DataFrame


def rules_with_domains(tables: Tables, rules: Rules) -> Rules:
    """The rules with the domains that the vocabulary table knows for listed concepts without one.

    A concept without a domain meets no table.  How many such concepts are left is a warning.
    """
    concepts = rules.outcome_concepts
    unknown = concepts.filter("domain_name IS NULL")
    if unknown.isEmpty():
        return rules
    if "concept" in tables:
        concepts = materialize(enrich_domains(concepts, tables["concept"]))
    left = unmapped_concepts(concepts).count()
    if left:
        warnings.warn(f"{left} outcome concepts have no domain; their events are not extracted", stacklevel=2)
    return replace(rules, outcome_concepts=concepts)


def extract_cohort(tables: Tables, rules: Rules, config: EpisodeConfig, store: bool = True) -> Cohort:
    """Extract in one pass over the clinical tables.  With `store` the extracted rows are written
    to the shared folder, because five later steps read them; what is written is the listed
    concepts only."""
    persons = select_persons(tables["person"], config)
    if store:
        persons = materialize(persons)
    rules = rules_with_domains(tables, rules)
    listed = extract_listed(tables, rules, persons, config)
    if store:
        listed = materialize(listed)
    return Cohort(persons, outcome_rows(listed), timing_rows(listed, config))


def outcome_stage(cohort: Cohort, rules: Rules, config: EpisodeConfig) -> DataFrame:
    return outcome_episodes(cohort.events, rules, config)


def progression_stage(cohort: Cohort, rules: Rules, config: EpisodeConfig) -> DataFrame:
    eligible = filter_reproductive_age(cohort.timing, cohort.persons, config)
    return progression_episodes(eligible, daily_outcomes(cohort.events), rules.timing_span_days(config.fractional_months), config)


def merge_stage(hip: DataFrame, pps: DataFrame, cohort: Cohort, config: EpisodeConfig) -> DataFrame:
    return merge_episodes(hip, pps, daily_outcomes(cohort.events), config)


def dating_stage(merged: DataFrame, cohort: Cohort, rules: Rules, config: EpisodeConfig) -> DataFrame:
    if config.dating == "simple":
        return simple_start_dates(merged)
    return repair_epoch_shift(date_episodes(merged, cohort.events, cohort.timing, rules, config))


def identify_episodes(tables: Tables, rules: Rules, config: EpisodeConfig) -> DataFrame:
    """Pregnancy episodes with refined dates, one non-overlapping history per person."""
    cohort = extract_cohort(tables, rules, config)
    hip = materialize(outcome_stage(cohort, rules, config))
    pps = materialize(progression_stage(cohort, rules, config))
    merged = materialize(merge_stage(hip, pps, cohort, config))
    return dating_stage(merged, cohort, rules, config)
