"""Rule tables: small look-ups turned into literals, code lists kept as DataFrames."""

from __future__ import annotations

import math
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from care_episodes.functions import fixed_values as fv
from care_episodes.session import small_table

Pair = tuple[str, str]

SPACING = {(first, nxt): days for first, nxt, days in fv.SPACING}
LOOKUP_SPACING = SPACING | fv.LOOKUP_SPACING_CHANGES
MAX_TERM = {category: max_term for category, _, max_term, _ in fv.TERM_LIMITS}

OUTCOME_CONCEPT_SCHEMA = (
    "concept_id long, concept_name string, domain_name string, category string, gest_value double"
)
TIMING_CONCEPT_SCHEMA = (
    "concept_id long, concept_name string, min_month double, max_month double, certainty string"
)


@dataclass
class Rules:
    """Everything the episode operators look up.

    `outcome_concepts` and `timing_concepts` are code lists of any size and stay DataFrames
    (Spark broadcasts them only when its own size estimate allows).  The spacing and term
    tables have one row per category (pair) and become literals inside expressions.
    """

    outcome_concepts: DataFrame
    timing_concepts: DataFrame
    spacing: Mapping[Pair, int] = field(default_factory=lambda: dict(SPACING))
    max_term: Mapping[str, int] = field(default_factory=lambda: dict(MAX_TERM))

    def timing_span_days(self, fractional_months: bool = False) -> int:
        """Longest time that two agreeing timing records can lie apart.

        Taken from the months that the records carry: whole ones unless `fractional_months`.
        """
        low, high = F.col("min_month"), F.col("max_month")
        if not fractional_months:
            low, high = F.floor(low).cast("double"), F.floor(high).cast("double")
        first, last = self.timing_concepts.agg(F.min(low), F.max(high)).first()
        return 0 if first is None else math.ceil((last - first + 2) * 30)


def default_timing_concepts(spark: SparkSession) -> DataFrame:
    rows = [(cid, name, low, high, "Medium") for cid, low, high, name in fv.TIMING_CONCEPTS]
    return small_table(spark, rows, TIMING_CONCEPT_SCHEMA)


def default_term_limits(spark: SparkSession) -> DataFrame:
    return small_table(
        spark, fv.TERM_LIMITS, "category string, min_term int, max_term int, hierarchy int"
    )


def default_spacing(spark: SparkSession) -> DataFrame:
    return small_table(
        spark, fv.SPACING, "first_preg_category string, outcome_preg_category string, min_days int"
    )


def default_term_durations(spark: SparkSession) -> DataFrame:
    return small_table(
        spark, fv.TERM_DURATIONS, "category string, max_term int, min_term int, retry int"
    )


def spacing_literals(spacing: DataFrame) -> dict[Pair, int]:
    """Spacing table as a dictionary; filtered and grouped first, so at most 7 x 7 rows come back."""
    rows = (
        spacing.filter(
            F.col("first_preg_category").isin(*fv.OUTCOME_CHOICE_ORDER)
            & F.col("outcome_preg_category").isin(*fv.OUTCOME_CHOICE_ORDER)
        )
        .groupBy("first_preg_category", "outcome_preg_category")
        .agg(F.min("min_days").alias("min_days"))
        .collect()
    )
    return {(r[0], r[1]): int(r[2]) for r in rows}


def max_term_literals(limits: DataFrame) -> dict[str, int]:
    rows = (
        limits.filter(F.col("category").isin(*fv.OUTCOME_CHOICE_ORDER))
        .groupBy("category")
        .agg(F.min("max_term").alias("max_term"))
        .collect()
    )
    return {r[0]: int(r[1]) for r in rows}


def is_in(col: Column, values) -> Column:
    """Membership that is false, not null, for a null value."""
    return F.coalesce(col.isin(*values), F.lit(False))


def lookup(key: Column, table: Mapping, default=None) -> Column:
    """Literal look-up of a small table as one CASE expression."""
    out = None
    for value, result in table.items():
        out = F.when(key == value, result) if out is None else out.when(key == value, result)
    if out is None:
        return F.lit(default)
    return out if default is None else out.otherwise(default)


def rank_of(category: Column, order=fv.OUTCOME_CHOICE_ORDER) -> Column:
    return lookup(category, {c: i for i, c in enumerate(order, 1)}, len(order) + 1)


def min_days_between(first: Column, second: Column) -> Column:
    """Minimum days between two outcomes, 28 for an unknown pair."""
    pairs = {f"{a}>{b}": days for (a, b), days in LOOKUP_SPACING.items()}
    return lookup(F.concat_ws(">", first, second), pairs, 28)


def term_bounds(category: Column) -> tuple[Column, Column]:
    """Shortest and longest term of an outcome, (0, 301) when unknown."""
    low = lookup(category, {c: lo for c, lo, _ in fv.LOOKUP_TERMS}, 0)
    high = lookup(category, {c: hi for c, _, hi in fv.LOOKUP_TERMS}, 301)
    return low, high


def is_valid_ga(ga_days: Column, category: Column) -> Column:
    """Is the gestational age possible for the outcome?"""
    low, high = term_bounds(category)
    return ga_days.between(low, high)


def concepts_of_domain(concepts: DataFrame, domain: str) -> DataFrame:
    """P5: the part of a code list that belongs to one domain."""
    return concepts.filter(F.col("domain_name") == domain)
