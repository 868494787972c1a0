"""Small inputs for tests."""

from __future__ import annotations

import datetime as dt

from care_episodes import testmap as tm
from care_episodes.functions.rules import Rules

EVENT_SCHEMA = (
    "person_id long, concept_id long, event_date date, domain string, concept_name string, category string, "
    "gest_value double, value_as_number double, value_as_string string"
)
TIMING_SCHEMA = (
    "person_id long, concept_id long, event_date date, domain_name string, value_as_number double, "
    "value_as_string string, min_month double, max_month double"
)
EPISODE_SCHEMA = (
    "person_id long, episode_number int, episode_start_date date, episode_end_date date, outcome_category string, "
    "gestational_age_days double, algorithm_used string"
)


def d(text: str) -> dt.date:
    return dt.date.fromisoformat(text)


def events(spark, rows):
    """rows: (person, category, date[, gest_value[, value_as_number[, concept_id[, name]]]])"""
    full = []
    for person, category, date, *more in rows:
        gest, value, concept, name = (*more, None, None, None, None)[:4]
        date = d(date) if isinstance(date, str) else date
        full.append((person, concept or 1, date, "Condition", name or "name", category, gest, value, None))
    return spark.createDataFrame(full, EVENT_SCHEMA)


def timing(spark, rows):
    """rows: (person, date, min_month, max_month)"""
    full = []
    for person, date, low, high in rows:
        date = d(date) if isinstance(date, str) else date
        full.append((person, int(low * 100 + high), date, "Observation", None, None, float(low), float(high)))
    return spark.createDataFrame(full, TIMING_SCHEMA)


def episodes(spark, rows, source="HIP"):
    """rows: (person, number, start, end, outcome, days)"""
    full = [(p, n, d(s), d(e), o, float(g), source) for p, n, s, e, o, g in rows]
    return spark.createDataFrame(full, EPISODE_SCHEMA)


def rules(spark) -> Rules:
    return tm.rules(spark)


CONFIG = tm.CONFIG
EPOCH = dt.date(1970, 1, 1)


def day(n: int) -> dt.date:
    return dt.date(2000, 1, 1) + dt.timedelta(days=n)
