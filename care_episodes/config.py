"""Run-time choices of the episode pipeline."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# Concept ids of the female gender set.  8507 is kept although the
# vocabulary calls it male: it is part of the published default list.
FEMALE_CONCEPTS = (8532, 8507, 45878463)
# The gender set of the survey-based source.
SURVEY_GENDER_CONCEPTS = (45878463, 45880669, 903096, 903079, 1177221)

MONTH_DAYS = 30
REPORTED_MONTH_DAYS = 30.25
YEAR_DAYS = 365.25


@dataclass(frozen=True)
class EpisodeConfig:
    """Parameters of one run.  `as_of` stands for "today" so that runs repeat."""

    as_of: dt.date = field(default_factory=dt.date.today)
    min_age: int = 15
    max_age: int = 56
    gender_concepts: tuple[int, ...] = FEMALE_CONCEPTS
    # progression records are kept for 15 <= age < 56 whatever the cohort ages are
    timing_min_age: int = 15
    timing_max_age: int = 56
    # timing months are cut to whole months unless set
    fractional_months: bool = False
    # laboratory tests can be timing records too; off in the published method
    timing_from_measurement: bool = False
    # keep episodes that lose the one-to-one match instead of dropping them
    keep_unmatched: bool = False
    # date range-only episodes by the middle of their consensus range
    use_range_midpoint: bool = False
    # move a live or still birth back to an earlier delivery record
    move_birth_to_delivery: bool = False
    # 'timing' refines start dates from timing records, 'simple' uses typical lengths
    dating: str = "timing"
