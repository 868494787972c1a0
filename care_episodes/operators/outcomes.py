"""Episodes from outcome codes.

Outcome records are reduced to one row per person, outcome group and day before any window, then
sessionized in all five groups at once.  The hierarchy (live birth, stillbirth, ectopic, abortion,
delivery record) runs over the same person-partitioned rows: each step looks only at rows of its
own or an earlier step, so the whole chain needs a single exchange by person.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.config import EpisodeConfig
from care_episodes.functions.dates import date_of, day_of
from care_episodes.functions.primitives import (
    clip_to_previous,
    neighbour_rule,
    number_groups,
    points_in_intervals,
)
from care_episodes.functions.rules import Rules, is_in, lookup, rank_of
from care_episodes.functions.scan import day_parts, neighbours, running_sums
from care_episodes.functions.fixed_values import OUTCOME_CHOICE_ORDER, WEEK_CONCEPTS
from care_episodes.sources.cdm import DOMAINS

# Order in which outcome groups enter the hierarchy.
STEPS = {"LB": 1, "SB": 2, "ECT": 3, "AB": 4, "SA": 4, "DELIV": 5}
DOMAIN_RANK = {d.name: d.rank for d in DOMAINS}


def same_group_spacing(rules: Rules) -> dict[int, int]:
    """Minimum days between two episodes of one group, by hierarchy step."""
    mixed = [rules.spacing[p] for p in (("AB", "SA"), ("SA", "AB")) if p in rules.spacing]
    days = {step: rules.spacing.get((c, c), 180) for c, step in STEPS.items() if step != 4}
    days[4] = min(mixed, default=56)
    return days


def _record_order() -> Column:
    """Order of records of one day as one number: domain, concept, and the category at the end.

    A number, because an aggregate over it keeps a fixed-size buffer and can be hashed.
    """
    domain = lookup(F.col("domain"), DOMAIN_RANK, 9).cast("bigint")
    return (domain * F.lit(1 << 48)) + F.col("concept_id") * 8 + rank_of(F.col("category"))


def outcome_sessions(events: DataFrame, rules: Rules, categories: tuple[str, ...] = tuple(STEPS)) -> DataFrame:
    """H1: episodes of each outcome group by the gap to the previous record.

    Returns person_id, step, session, outcome_day, outcome_category (of the first record) and
    n_visits (records).
    """
    step = lookup(F.col("category"), STEPS)
    daily = (
        events.filter(F.col("category").isin(*categories) & F.col("event_date").isNotNull())
        .groupBy("person_id", step.alias("step"), day_of(F.col("event_date")).alias("day"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(_record_order()).alias("first"))
        .repartition("person_id")
    )
    order = Window.partitionBy("person_id", "step").orderBy("day")
    gap = F.col("day") - F.lag("day").over(order)
    limit = lookup(F.col("step"), same_group_spacing(rules), 180)
    return (
        daily.withColumn("starts", gap.isNull() | (gap >= limit))
        .withColumn("session", number_groups(F.col("starts"), ["person_id", "step"], "day"))
        .groupBy("person_id", "step", "session")
        .agg(
            F.max("day").alias("outcome_day"),
            F.min_by("first", "day").alias("first"),
            F.sum("n").alias("n_visits"),
        )
        .withColumn("outcome_category", lookup(F.col("first") % 8, dict(enumerate(OUTCOME_CHOICE_ORDER, 1))))
        .drop("first")
    )


def _step_rule(step: int, rules: Rules) -> dict[str, tuple[dict[str, int], dict[str, int]]]:
    """Blocking categories with their minimum gap, before and after a candidate of the step."""
    s = rules.spacing
    if step == 2:
        return {"LB": s["LB", "SB"]}, {"LB": s["SB", "LB"]}
    if step == 4:
        after_birth, after_ectopic = s["LB", "AB"], s["ECT", "AB"]
        before = {"LB": after_birth, "SB": after_birth, "ECT": after_ectopic}
        return before, {c: s["AB", c] for c in ("LB", "SB", "ECT")}
    after_birth, after_loss, before_loss = s["LB", "DELIV"], s["ECT", "DELIV"], s["DELIV", "ECT"]
    losses = ("ECT", "AB", "SA")
    before = {"LB": after_birth, "SB": after_birth} | {c: after_loss for c in losses}
    after = {c: s["DELIV", c] for c in ("LB", "SB")} | {c: before_loss for c in losses}
    return before, after


def _ectopic_rule(prev_cat: Column, prev_gap: Column, next_cat: Column, next_gap: Column, rules: Rules) -> Column:
    """An ectopic episode stays if either side is free or far enough away."""
    s = rules.spacing
    after_birth = min(s["LB", "ECT"], s["SB", "ECT"])
    before_birth = min(s["ECT", "LB"], s["ECT", "SB"])
    births = ("LB", "SB")
    far = F.coalesce(prev_gap >= after_birth, F.lit(False)) | F.coalesce(next_gap >= before_birth, F.lit(False))
    return (
        prev_cat.isNull() | next_cat.isNull() | far
        | (~is_in(prev_cat, births) & ~is_in(next_cat, births))
    )


def apply_step(episodes: DataFrame, step: int, rules: Rules, config: EpisodeConfig | None = None) -> DataFrame:
    """H2-H5: decide the candidates of one step by their neighbours among the steps so far.

    Rows of earlier steps stay as they are; rows of later steps are not looked at.
    """
    # Offsets that skip the null of rows not looked at: one pass over the sorted rows for both.
    over = "IGNORE NULLS OVER (PARTITION BY person_id ORDER BY outcome_day, step, session)"
    seen = F.when(F.col("step") <= step, F.struct("outcome_category", "outcome_day"))
    df = episodes.withColumn("_seen", seen).withColumns(
        {"_prev": F.expr(f"lag(_seen) {over}"), "_next": F.expr(f"lead(_seen) {over}")}
    )
    prev_cat, next_cat = F.col("_prev.outcome_category"), F.col("_next.outcome_category")
    prev_gap = F.col("outcome_day") - F.col("_prev.outcome_day")
    next_gap = F.col("_next.outcome_day") - F.col("outcome_day")
    if step == 3:
        keep = _ectopic_rule(prev_cat, prev_gap, next_cat, next_gap, rules)
    else:
        keep = neighbour_rule(prev_cat, prev_gap, next_cat, next_gap, *_step_rule(step, rules))
    if step == 5 and config is not None and config.move_birth_to_delivery:
        limit = lookup(F.col("outcome_category"), {c: rules.spacing["DELIV", c] for c in ("LB", "SB")})
        earlier = (prev_cat == "DELIV") & (prev_gap < limit)
        df = df.withColumn(
            "outcome_day", F.when(earlier, F.col("_prev.outcome_day")).otherwise(F.col("outcome_day"))
        )
    return df.filter((F.col("step") != step) | keep).drop("_seen", "_prev", "_next")


def number_by_outcome(episodes: DataFrame) -> DataFrame:
    """Episode number per person by outcome date, then by how definite the outcome is."""
    ties = [c for c in ("gestational_weeks", "n_gest_records", "n_visits") if c in episodes.columns]
    order = Window.partitionBy("person_id").orderBy(
        "outcome_day", rank_of(F.col("outcome_category")), *ties
    )
    return episodes.withColumn("episode_number", F.row_number().over(order))


def outcome_hierarchy(events: DataFrame, rules: Rules, config: EpisodeConfig | None = None) -> DataFrame:
    """H6: outcome episodes of all groups after the spacing rules, numbered per person."""
    kept = outcome_sessions(events, rules)
    for step in (2, 3, 4, 5):
        kept = apply_step(kept, step, rules, config)
    return number_by_outcome(kept.drop("step", "session"))


def gestation_records(events: DataFrame) -> DataFrame:
    """Records that say something about gestation, with their number of weeks if stated."""
    says_so = (
        F.col("gest_value").isNotNull()
        | F.coalesce(F.col("category") == "GEST", F.lit(False))
        | is_in(F.col("concept_id"), WEEK_CONCEPTS)
        | F.coalesce(F.col("concept_name").rlike("(?i)gestation"), F.lit(False))
    )
    return events.filter(says_so).withColumn("weeks", F.coalesce("gest_value", "value_as_number"))


def attach_gestation(episodes: DataFrame, gestation: DataFrame) -> DataFrame:
    """H7: largest number of weeks recorded in the 280 days up to the outcome."""
    points = gestation.groupBy("person_id", day_of(F.col("event_date")).alias("gest_day")).agg(
        F.max("weeks").alias("day_weeks"), F.count(F.lit(1)).alias("day_records")
    )
    joined = points_in_intervals(
        episodes, points, ["person_id"], F.col("outcome_day") - 280, F.col("outcome_day"),
        "gest_day", 281, "left",
    )
    return (
        joined.groupBy(*episodes.columns)
        .agg(F.max("day_weeks").alias("gestational_weeks"), F.sum("day_records").alias("n_gest_records"))
        .withColumn("has_gestational_info", F.col("gestational_weeks").isNotNull())
    )


def gestation_only_episodes(gestation: DataFrame) -> DataFrame:
    """H8: episodes seen only through gestational weeks.

    A record starts a new episode if it is the first, if the weeks do not increase, if more than
    70 days have passed, or if the time passed exceeds the weeks gained by more than 28 days.
    Equal records of one day are counted, not listed: of n equal ones the first may continue an
    episode, the last may be continued, and each between is an episode of its own (`n_copies`).
    A person's records are ordered within their days; days hand over their last record and their count of starts.
    """
    valid = gestation.filter((F.col("weeks") > 0) & (F.col("weeks") <= 44) & F.col("event_date").isNotNull())
    daily = valid.groupBy(
        "person_id",
        day_of(F.col("event_date")).alias("day"),
        lookup(F.col("domain"), DOMAIN_RANK, 9).alias("domain_rank"),
        "concept_id",
        "weeks",
    ).agg(F.count(F.lit(1)).alias("n"))
    listed = daily.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.least("n", F.lit(3)))))
    order = ["domain_rank", "concept_id", "weeks", "copy"]
    by_day = neighbours(day_parts(listed, ["person_id"], F.col("day")), ["person_id"], order, {"prev_weeks": "weeks", "prev_day": "day"})
    gained, passed = F.col("weeks") - F.col("prev_weeks"), F.col("day") - F.col("prev_day")
    starts = gained.isNull() | (gained <= 0) | (passed > 70) | (passed > gained * 7 + 28)
    between = (F.col("n") > 2) & (F.col("copy") == 2)
    return (
        running_sums(by_day.withColumn("starts", starts.cast("int")), ["person_id"], order, {"group": F.col("starts")})
        .groupBy("person_id", "group")
        .agg(
            F.max("day").alias("last_day"),
            F.max("weeks").alias("gestational_weeks"),
            F.count(F.lit(1)).alias("n_gest_records"),
            F.max(F.when(between, F.col("n") - 2).otherwise(1)).alias("n_copies"),
        )
        .select(
            "person_id",
            (F.col("last_day") + (40 - F.col("gestational_weeks")) * 7).alias("outcome_day"),
            F.lit("PREG").alias("outcome_category"),
            "gestational_weeks",
            "n_gest_records",
            "n_copies",
        )
    )


def each_copy(episodes: DataFrame) -> DataFrame:
    """H8: one row per episode, where equal ones are carried as `n_copies`."""
    copies = F.sequence(F.lit(1).cast("bigint"), F.col("n_copies"))
    return episodes.withColumn("_copy", F.explode(copies)).drop("_copy", "n_copies")


def add_gestation_only(episodes: DataFrame, gestation_only: DataFrame) -> DataFrame:
    """H8: add gestation-only episodes whose date is not the outcome date of another episode."""
    known = episodes.select(
        "person_id", F.col("outcome_day").cast("double").alias("outcome_day"), "outcome_category",
        "gestational_weeks", "n_gest_records", F.lit(1).cast("bigint").alias("n_copies"),
        F.lit(True).alias("known"),
    )
    both = known.unionByName(gestation_only.withColumn("known", F.lit(False))).repartition("person_id")
    taken = F.bool_or("known").over(Window.partitionBy("person_id", "outcome_day"))
    return number_by_outcome(both.withColumn("taken", taken).filter("known OR NOT taken")).drop("known", "taken")


def start_from_gestation_or_term(episodes: DataFrame, rules: Rules) -> DataFrame:
    """H9: start by weeks at the outcome, else by the longest term of the outcome, else 280 days."""
    end = F.col("outcome_day").cast("double")
    longest = F.coalesce(lookup(F.col("outcome_category"), rules.max_term), F.lit(280))
    length = F.coalesce(F.col("gestational_weeks") * 7, longest.cast("double"))
    return episodes.withColumns(
        {"start_day": end - length, "end_day": end, "gestational_age_days": length}
    )


def validate_and_clip(episodes: DataFrame, config: EpisodeConfig) -> DataFrame:
    """Plausible lengths only, and no overlap with the previous episode."""
    today = F.unix_date(F.lit(config.as_of).cast("date"))
    plausible = episodes.filter(
        F.col("gestational_age_days").between(0, 320)
        & (F.col("start_day") <= today)
        & (F.col("end_day") >= F.col("start_day"))
    )
    clipped = clip_to_previous(plausible, "start_day", "end_day", "end_day", "episode_number")
    return (
        clipped.withColumn("gestational_age_days", F.col("end_day") - F.col("_start"))
        .filter("gestational_age_days > 0")
        .select(
            "person_id",
            "episode_number",
            date_of(F.col("_start")).alias("episode_start_date"),
            date_of(F.col("end_day")).alias("episode_end_date"),
            "outcome_category",
            "gestational_age_days",
            F.lit("HIP").alias("algorithm_used"),
        )
    )


def outcome_episodes(events: DataFrame, rules: Rules, config: EpisodeConfig) -> DataFrame:
    """Outcome-based episodes with start and end dates."""
    gestation = gestation_records(events)
    known = attach_gestation(outcome_hierarchy(events, rules, config), gestation)
    everything = add_gestation_only(known, gestation_only_episodes(gestation))
    return validate_and_clip(start_from_gestation_or_term(everything, rules), config)
