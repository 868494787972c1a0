"""Episodes from gestational-timing records.

A record can open an episode only after a gap of more than one month, and then only if no two
compatible records lie on both sides of that gap.  So instead of comparing records pairwise, the
records of a person are cut into runs (gaps of at most 30 days inside) and, within a run, into
blocks of equal month range with inner gaps of at most 120 days.

Blocks decide the same as records.  Two records with month ranges a (earlier) and b (later) are
compatible if their distance lies in [30(b.min - a.max - 2), 30(b.max - a.min + 2)], a range at
least 120 days wide.  The distances between two blocks change by at most 120 days from one pair of
records to the next, so they cannot jump over that range: some pair is compatible exactly if the
smallest and the largest distance enclose a part of it.

There are at most (days lived / 30) runs times the distinct month ranges of the timing list, for
however many records, and blocks meet only within the longest possible distance.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.config import MONTH_DAYS, EpisodeConfig
from care_episodes.functions.dates import date_of, day_of
from care_episodes.functions.fixed_values import OUTCOME_CHOICE_ORDER
from care_episodes.functions.primitives import best_point, join_growing, number_groups, points_in_intervals
from care_episodes.functions.rules import rank_of
from care_episodes.session import materialize

BLOCK_GAP = 120
LONG_GAP = 10 * MONTH_DAYS
LONGEST_EPISODE = 12 * MONTH_DAYS


def timing_blocks(timing: DataFrame) -> DataFrame:
    """Records of a person as blocks: run, month range, first and last day, records, concepts."""
    daily = timing.groupBy(
        "person_id", day_of(F.col("event_date")).alias("day"), "min_month", "max_month", "concept_id"
    ).agg(F.count(F.lit(1)).alias("n"))
    # Runs depend on days alone; a person has one row per day here.
    by_person = Window.partitionBy("person_id").orderBy("day")
    days = daily.select("person_id", "day").distinct().withColumn("gap", F.col("day") - F.lag("day").over(by_person))
    days = days.withColumn("starts", F.col("gap").isNull() | (F.col("gap") > MONTH_DAYS))
    days = days.withColumn("run", number_groups(F.col("starts"), ["person_id"], "day"))
    months = ["person_id", "run", "min_month", "max_month"]
    same_months = Window.partitionBy(*months).orderBy("day", "concept_id")
    inner_gap = F.col("day") - F.lag("day").over(same_months)
    return (
        join_growing(daily, days, ["person_id", "day"])
        .withColumn("cut", inner_gap > BLOCK_GAP)
        .withColumn("block", number_groups(F.col("cut"), months, "day", "concept_id"))
        .groupBy(*months, "block")
        .agg(
            F.min("day").alias("first_day"),
            F.max("day").alias("last_day"),
            F.max(F.when(F.col("starts"), F.col("gap"))).alias("run_gap"),
            F.sum("n").alias("n"),
            F.collect_set("concept_id").alias("concepts"),
        )
    )


def pair_compatibility(blocks: DataFrame, span_days: int) -> DataFrame:
    """G1: for each run, the furthest later run that holds a compatible record.

    `span_days` is the longest distance at which two records of the timing list can agree.
    """
    later = blocks.select(
        "person_id",
        F.col("run").alias("b_run"),
        F.col("min_month").alias("b_min"),
        F.col("max_month").alias("b_max"),
        F.col("first_day").alias("b_first"),
        F.col("last_day").alias("b_last"),
    )
    pairs = points_in_intervals(
        blocks.select("person_id", "run", "min_month", "max_month", "first_day", "last_day"),
        later, ["person_id"], F.col("last_day") + 1, F.col("last_day") + span_days, "b_first",
        max(span_days, 1),
    )
    nearest = F.col("b_first") - F.col("last_day")
    furthest = F.col("b_last") - F.col("first_day")
    return (
        pairs.filter(
            (F.col("b_run") > F.col("run"))
            & (nearest <= (F.col("b_max") - F.col("min_month") + 2) * MONTH_DAYS)
            & (furthest >= (F.col("b_min") - F.col("max_month") - 2) * MONTH_DAYS)
        )
        .groupBy("person_id", "run")
        .agg(F.max("b_run").alias("reaches_run"))
    )


def record_agreement(blocks: DataFrame, reach: DataFrame) -> DataFrame:
    """Runs of a person, and whether compatible records lie on both sides of their start.

    Agreement matters only for the first record of a run; every other record follows the one
    before it within a month and stays in its episode either way.
    """
    runs = blocks.groupBy("person_id", "run").agg(
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
        F.max("run_gap").alias("run_gap"),
        F.min("min_month").alias("min_month"),
        F.max("max_month").alias("max_month"),
        F.sum("n").alias("n"),
        F.array_distinct(F.flatten(F.collect_list("concepts"))).alias("concepts"),
    )
    before = Window.partitionBy("person_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    agrees = F.coalesce(F.max("reaches_run").over(before) >= F.col("run"), F.lit(False))
    return join_growing(runs, reach, ["person_id", "run"], "left").withColumn("agrees", agrees).drop("reaches_run")


def agreement_of_records(timing: DataFrame) -> DataFrame:
    """G2 per record: (person_id, concept_id, event_date, min_month, max_month, agrees, n records).

    A record agrees if a compatible pair of records encloses it: one before it, the other after it or the record itself.  Records of one
    day and month range are compatible with each other, so all but the first of such a group agree.  For a first one
    it takes the furthest group that is compatible with an earlier group; the furthest partner is, for each month range, the last group
    up to the longest distance, found as of that day.  Groups are one per day and month range, for however many records.
    """
    daily = timing.groupBy(
        "person_id", "concept_id", "event_date", day_of(F.col("event_date")).alias("day"), "min_month", "max_month"
    ).agg(F.count(F.lit(1)).alias("n"))
    groups = materialize(daily.groupBy("person_id", "day", "min_month", "max_month").agg(F.min("concept_id").alias("first_concept")))
    place = ["day", "min_month", "max_month"]
    ranges = groups.select("min_month", "max_month").distinct().collect()  # those of the timing list
    partners = F.explode(F.array(*[F.struct(F.lit(r["min_month"]).alias("b_min"), F.lit(r["max_month"]).alias("b_max")) for r in ranges])) if ranges else None
    if partners is None:
        return daily.select("person_id", "concept_id", "event_date", "min_month", "max_month", F.lit(False).alias("agrees"), "n")
    pairs = groups.select("person_id", *place, partners.alias("b")).select("person_id", *place, "b.*")
    pairs = pairs.withColumns({
        "nearest": (F.col("b_min") - F.col("max_month") - 2) * MONTH_DAYS,
        "until": F.floor(F.col("day") + (F.col("b_max") - F.col("min_month") + 2) * MONTH_DAYS),
    })
    points = groups.select("person_id", F.col("min_month").alias("b_min"), F.col("max_month").alias("b_max"), F.col("day").alias("b_day"))
    last = best_point(pairs, points, ["person_id", "b_min", "b_max"], "until", "b_day", F.struct((-F.col("b_day")).alias("order")), "before")
    met = join_growing(pairs, last.where("best is not null"), ["person_id", "b_min", "b_max", "until"]).withColumn("b_day", -F.col("best.order"))
    partner = F.struct(F.col("b_day").alias("day"), F.col("b_min").alias("min_month"), F.col("b_max").alias("max_month"))
    after = (F.col("b_day") - F.col("day") >= F.col("nearest")) & (partner > F.struct(*place))
    furthest = met.where(after).groupBy("person_id", *place).agg(F.max(partner).alias("reaches"))
    before = Window.partitionBy("person_id").orderBy(*place).rowsBetween(Window.unboundedPreceding, -1)
    agreeing = join_growing(groups, furthest, ["person_id", *place], "left").withColumn(
        "group_agrees", F.coalesce(F.max("reaches").over(before) >= F.struct(*place), F.lit(False))
    )
    both = join_growing(daily, agreeing.drop("reaches"), ["person_id", *place])
    is_first = F.col("concept_id") == F.col("first_concept")
    one = F.when(is_first, F.struct(F.col("group_agrees").alias("agrees"), F.lit(1).cast("bigint").alias("n")))
    rest = F.struct(F.lit(True).alias("agrees"), (F.col("n") - F.when(is_first, 1).otherwise(0)).alias("n"))
    listed = both.select("person_id", "concept_id", "event_date", "min_month", "max_month", F.explode(F.array(one, rest)).alias("r"))
    found = listed.where("r.n > 0").select("person_id", "concept_id", "event_date", "min_month", "max_month", "r.agrees", "r.n")
    return found.groupBy("person_id", "concept_id", "event_date", "min_month", "max_month", "agrees").agg(F.sum("n").alias("n"))


def assign_progression_episodes(runs: DataFrame) -> DataFrame:
    """A run opens an episode unless its records agree and the gap is at most ten months."""
    opens = F.col("run_gap").isNull() | ~F.col("agrees") | (F.col("run_gap") > LONG_GAP)
    return runs.withColumn("opens", opens).withColumn(
        "person_episode_number", number_groups(F.col("opens"), ["person_id"], "run")
    )


def drop_long_episodes(assigned: DataFrame) -> DataFrame:
    """Drop episodes of more than twelve months and number the others densely."""
    episode = Window.partitionBy("person_id", "person_episode_number")
    length = F.max("last_day").over(episode) - F.min("first_day").over(episode)
    dense = F.dense_rank().over(Window.partitionBy("person_id").orderBy("person_episode_number"))
    return (
        assigned.withColumn("length", length)
        .filter(F.col("length") <= LONGEST_EPISODE)
        .withColumn("person_episode_number", dense)
        .drop("length")
    )


def of_records(timing: DataFrame, runs: DataFrame, *columns: str) -> DataFrame:
    """G2-G4 per record: each timing record with `columns` of the run it lies in; records of dropped runs are left out.

    Runs of a person do not overlap, so a record has one at most.
    """
    bounds = runs.select("person_id", F.col("first_day").alias("_first"), F.col("last_day").alias("_last"), *columns)
    records = timing.withColumn("_day", day_of(F.col("event_date")))
    joined = points_in_intervals(bounds, records, ["person_id"], F.col("_first"), F.col("_last"), "_day", BLOCK_GAP)
    return joined.select(*timing.columns, *columns)


def progression_bounds(assigned: DataFrame) -> DataFrame:
    """Dates, month range, distinct concepts and records of each episode."""
    bounds = assigned.groupBy("person_id", "person_episode_number").agg(
        F.min("first_day").alias("min_day"),
        F.max("last_day").alias("max_day"),
        F.min("min_month").alias("earliest_month"),
        F.max("max_month").alias("latest_month"),
        F.size(F.array_distinct(F.flatten(F.collect_list("concepts")))).alias("n_GT_concepts"),
        F.sum("n").alias("n_records"),
    )
    left = F.coalesce((10 - F.col("latest_month")) * MONTH_DAYS, F.lit(60.0))
    return bounds.withColumn("expected_end_day", F.col("max_day") + left)


def daily_outcomes(events: DataFrame) -> DataFrame:
    """One row per person, day and outcome category."""
    return (
        events.filter(F.col("category").isin(*OUTCOME_CHOICE_ORDER))
        .select(
            "person_id", day_of(F.col("event_date")).alias("outcome_day"),
            rank_of(F.col("category")).alias("outcome_rank"), F.col("category").alias("found"),
        )
        .distinct()
    )


def best_outcome(episodes: DataFrame, outcomes: DataFrame, low: str, high: str) -> DataFrame:
    """The most definite, then earliest outcome in [low, high] of each episode (null if none)."""
    longest = 366
    joined = points_in_intervals(
        episodes, outcomes, ["person_id"], F.col(low), F.col(high), "outcome_day", longest, "left"
    )
    best = F.min(
        F.when(F.col("found").isNotNull(), F.struct("outcome_rank", "outcome_day", "found"))
    ).alias("best")
    return joined.groupBy(*episodes.columns).agg(best)


def progression_outcome(bounds: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Outcome found from 14 days before the last record to the expected end or next episode."""
    order = Window.partitionBy("person_id").orderBy("person_episode_number")
    until_next = F.lead("min_day").over(order) - 1
    windows = bounds.withColumns(
        {
            "lookback_day": F.col("max_day") - 14,
            "lookahead_day": F.least(until_next, F.col("expected_end_day")),
        }
    )
    found = best_outcome(windows, outcomes, "lookback_day", "lookahead_day")
    return found.withColumns(
        {
            "outcome_category": F.coalesce("best.found", F.lit("PREG")),
            "outcome_day": F.coalesce(F.col("best.outcome_day").cast("double"), F.col("expected_end_day")),
        }
    ).drop("best", "lookback_day", "lookahead_day")


def validate_progression(episodes: DataFrame, config: EpisodeConfig) -> DataFrame:
    """Start by the earliest month, plausible lengths only, renumbered."""
    today = F.unix_date(F.lit(config.as_of).cast("date"))
    start = F.col("min_day") - F.coalesce(F.col("earliest_month") * MONTH_DAYS, F.lit(90.0))
    order = Window.partitionBy("person_id").orderBy("person_episode_number")
    return (
        episodes.withColumn("start_day", start)
        .withColumn("gestational_age_days", F.col("outcome_day") - F.col("start_day"))
        .filter(
            (F.col("gestational_age_days") > 0)
            & (F.col("gestational_age_days") <= 320)
            & (F.col("start_day") <= today)
        )
        .select(
            "person_id",
            F.row_number().over(order).alias("episode_number"),
            date_of(F.col("start_day")).alias("episode_start_date"),
            date_of(F.col("outcome_day")).alias("episode_end_date"),
            "outcome_category",
            "gestational_age_days",
            "n_GT_concepts",
            "n_records",
            F.lit("PPS").alias("algorithm_used"),
        )
    )


def runs_with_agreement(timing: DataFrame, span_days: int) -> DataFrame:
    """G1 and G2 on timing records.  The compact block table feeds both and is written once."""
    blocks = materialize(timing_blocks(timing))
    return record_agreement(blocks, pair_compatibility(blocks, span_days))


def progression_episodes(
    timing: DataFrame, outcomes: DataFrame, span_days: int, config: EpisodeConfig
) -> DataFrame:
    """Timing-based episodes with start and end dates."""
    assigned = drop_long_episodes(assign_progression_episodes(runs_with_agreement(timing, span_days)))
    return validate_progression(progression_outcome(progression_bounds(assigned), outcomes), config)
