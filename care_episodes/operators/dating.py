"""Start dates refined from timing records, with a stated precision.

Timing records are classified one by one before they meet episodes and are then counted per
(person, day, implied dates).  An episode therefore sees at most its own days times the distinct
month ranges, however many records there are; quantiles take the counts as weights.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.config import MONTH_DAYS, EpisodeConfig
from care_episodes.functions.dates import date_of, day_of, precision_category
from care_episodes.functions.fixed_values import TIMING_CONCEPT_IDS, WEEK_CONCEPTS
from care_episodes.functions.primitives import join_growing, points_in_intervals, quartile_bounds
from care_episodes.functions.rules import Rules, is_in, lookup
from care_episodes.session import materialize

EPISODE = ["person_id", "episode_number"]


def per_episode() -> Window:
    return Window.partitionBy(*EPISODE)


def timing_records(events: DataFrame, timing: DataFrame, rules: Rules) -> DataFrame:
    """Every record that may date a pregnancy, with the months of the timing list.

    A concept on both lists counts twice, as event and as timing record.
    """
    months = rules.timing_concepts.select(
        "concept_id", F.col("min_month").alias("list_min"), F.col("max_month").alias("list_max")
    )
    named = F.coalesce(F.col("concept_name").rlike("(?i)gestation"), F.lit(False))
    from_events = (
        events.join(months, "concept_id", "left")
        .filter(
            F.col("list_min").isNotNull()
            | is_in(F.col("concept_id"), TIMING_CONCEPT_IDS)
            | named
            | F.coalesce(F.col("category") == "GEST", F.lit(False))
            | F.col("gest_value").isNotNull()
        )
        .select(
            "person_id", "concept_id", "event_date", "concept_name", "gest_value", "value_as_number",
            F.col("list_min").alias("min_month"), F.col("list_max").alias("max_month"),
        )
    )
    none = F.lit(None)
    from_timing = timing.select(
        "person_id", "concept_id", "event_date", none.cast("string").alias("concept_name"),
        none.cast("double").alias("gest_value"), "value_as_number", "min_month", "max_month",
    )
    return from_events.unionByName(from_timing)


def classify_timing(records: DataFrame) -> DataFrame:
    """GW states a week, GR3m a range of months; anything else is dropped."""
    name = F.col("concept_name")
    says_week = F.coalesce(name.rlike("(?i)gestation period,") | name.rlike("(?i)gestational age"), F.lit(False))
    kind = F.when(
        says_week | is_in(F.col("concept_id"), WEEK_CONCEPTS) | F.col("gest_value").isNotNull(), "GW"
    ).when(F.col("min_month").isNotNull() & F.col("max_month").isNotNull(), "GR3m")
    return records.withColumn("GT_type", kind).filter("GT_type IS NOT NULL")


def gestational_weeks(classified: DataFrame) -> DataFrame:
    """Stated weeks: the list's value, else a number below 50, else "N weeks" of the name."""
    in_name = F.regexp_extract("concept_name", r"(\d+) weeks?", 1)
    weeks = F.coalesce(
        F.col("gest_value"),
        F.when(F.col("value_as_number") < 50, F.col("value_as_number")),
        F.when(in_name != "", in_name.try_cast("double")),
    )
    return classified.withColumn("gestational_weeks", F.when(F.col("GT_type") == "GW", weeks))


def implied_dates(records: DataFrame) -> DataFrame:
    """E5: implied start of a week record, implied range of a month record, in epoch days."""
    day = day_of(F.col("event_date")).cast("double")
    month_record = F.col("GT_type") == "GR3m"
    return records.withColumns(
        {
            "implied_start": day - F.col("gestational_weeks") * 7,
            "range_start": F.when(month_record, day - F.col("max_month") * MONTH_DAYS),
            "range_end": F.when(month_record, day - F.col("min_month") * MONTH_DAYS),
        }
    )


def dated_records(records: DataFrame) -> DataFrame:
    """E3-E5 and counted: one row per person, day, type and implied dates."""
    dated = implied_dates(gestational_weeks(classify_timing(records)))
    return dated.groupBy(
        "person_id", day_of(F.col("event_date")).alias("event_day"), "GT_type",
        "implied_start", "range_start", "range_end",
    ).agg(F.count(F.lit(1)).alias("n"))


def timing_to_episode(dated: DataFrame, episodes: DataFrame) -> DataFrame:
    """Dated records in [start - 30, end + 30] of each episode, counted per implied dates."""
    windows = episodes.select(
        *EPISODE, day_of(F.col("episode_start_date")).alias("start_day"), day_of(F.col("episode_end_date")).alias("end_day")
    )
    joined = points_in_intervals(
        windows, dated, ["person_id"], F.col("start_day") - 30, F.col("end_day") + 30, "event_day", 384
    )
    return joined.groupBy(*EPISODE, "GT_type", "implied_start", "range_start", "range_end").agg(
        F.sum("n").alias("n")
    )


def overlap_counts(ranges: DataFrame) -> DataFrame:
    """E6, first part: how many other ranges of the episode each range overlaps.

    A range misses those that start after its end and those that end before its start, and no
    range does both.  Both numbers are running sums over the sorted bounds, so no pairs are built.
    """
    bounds = ranges.select(
        *EPISODE, "range_start", "range_end", "n",
        F.explode(
            F.array(
                F.struct(F.col("range_start").alias("at"), F.lit(0).alias("is_end")),
                F.struct(F.col("range_end").alias("at"), F.lit(1).alias("is_end")),
            )
        ).alias("bound"),
    )
    by_rows = (
        per_episode().orderBy("bound.at", "bound.is_end", "range_start", "range_end")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    is_end = F.col("bound.is_end") == 1
    started = F.sum(F.when(~is_end, F.col("n")).otherwise(0)).over(by_rows)
    ended = F.sum(F.when(is_end, F.col("n")).otherwise(0)).over(by_rows)
    return (
        bounds.withColumns({"started": started, "ended": ended, "is_end": is_end})
        .groupBy(*EPISODE, "range_start", "range_end", "n")
        .agg(
            F.max(F.when(F.col("is_end"), F.col("started"))).alias("started_by_end"),
            F.max(F.when(~F.col("is_end"), F.col("ended"))).alias("ended_before_start"),
        )
        .withColumn("overlaps", F.col("started_by_end") - F.col("ended_before_start") - 1)
        .drop("started_by_end", "ended_before_start")
    )


def interval_consensus(timing: DataFrame) -> DataFrame:
    """Common part of the month ranges of an episode, after dropping ranges with few overlaps.

    One row per episode that has ranges: consensus_start and consensus_end in epoch days.
    """
    ranges = (
        timing.filter("range_start IS NOT NULL AND range_end IS NOT NULL")
        .groupBy(*EPISODE, "range_start", "range_end")
        .agg(F.sum("n").alias("n"))
    )
    counted = overlap_counts(ranges)
    q1, q3 = quartile_bounds(F.col("overlaps"), F.col("n"), per_episode())
    kept = (
        counted.withColumns({"q1": q1, "q3": q3})
        .withColumn("limit", F.greatest(F.lit(0.0), F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))))
        .withColumn("keep", F.col("overlaps") >= F.col("limit"))
    )
    first = F.struct("range_start", "range_end")
    summary = kept.groupBy(*EPISODE).agg(
        F.max(F.when(F.col("keep"), F.col("range_start"))).alias("latest_start"),
        F.min(F.when(F.col("keep"), F.col("range_end"))).alias("earliest_end"),
        F.coalesce(F.min(F.when(F.col("keep"), first)), F.min(first)).alias("first_range"),
    )
    meets = F.coalesce(F.col("latest_start") <= F.col("earliest_end"), F.lit(False))
    return summary.select(
        *EPISODE,
        F.when(meets, F.col("latest_start")).otherwise(F.col("first_range.range_start")).alias("consensus_start"),
        F.when(meets, F.col("earliest_end")).otherwise(F.col("first_range.range_end")).alias("consensus_end"),
    )


def _implied_counts(timing: DataFrame) -> DataFrame:
    return (
        timing.filter("implied_start IS NOT NULL AND range_start IS NULL")
        .groupBy(*EPISODE, "implied_start")
        .agg(F.sum("n").alias("n"))
    )


def gw_outlier_filter(timing: DataFrame) -> DataFrame:
    """Implied starts whose distance to the median is not an outlier.

    A single value passes; if nothing passes, the first value does.
    """
    implied = _implied_counts(timing)
    middle = F.percentile("implied_start", 0.5, F.col("n")).over(per_episode())
    with_distance = implied.withColumn("distance", F.abs(F.col("implied_start") - middle))
    q1, q3 = quartile_bounds(F.col("distance"), F.col("n"), per_episode())
    bounded = with_distance.withColumns({"q1": q1, "q3": q3})
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("distance").between(F.col("q1") - spread, F.col("q3") + spread)
    judged = bounded.withColumn("keep", inside | (F.sum("n").over(per_episode()) <= 1))
    none_kept = ~F.bool_or("keep").over(per_episode())
    is_first = F.col("implied_start") == F.min("implied_start").over(per_episode())
    count = F.when(F.col("keep"), F.col("n")).otherwise(F.lit(1))
    return (
        judged.withColumns({"none_kept": none_kept, "is_first": is_first})
        .filter("keep OR (none_kept AND is_first)")
        .select(*EPISODE, "implied_start", count.alias("n"))
    )


def iqr_date_filter(timing: DataFrame) -> DataFrame:
    """Implied starts inside the quartiles plus 1.5 times their distance; up to two pass."""
    implied = _implied_counts(timing)
    q1, q3 = quartile_bounds(F.col("implied_start"), F.col("n"), per_episode())
    bounded = implied.withColumns({"q1": q1, "q3": q3, "total": F.sum("n").over(per_episode())})
    spread = 1.5 * (F.col("q3") - F.col("q1"))
    inside = F.col("implied_start").between(F.col("q1") - spread, F.col("q3") + spread)
    return bounded.filter(inside | (F.col("total") <= 2)).select(*EPISODE, "implied_start", "n")


def range_midpoint(timing: DataFrame) -> DataFrame:
    """Middle of the common part of all ranges, else the median of the middles (999 days)."""
    ranges = timing.filter("range_start IS NOT NULL AND range_end IS NOT NULL")
    half = ((F.col("range_end") - F.col("range_start")) / 2).cast("int")
    summary = ranges.groupBy(*EPISODE).agg(
        F.max("range_start").alias("low"),
        F.min("range_end").alias("high"),
        F.percentile(F.col("range_start") + half, 0.5, F.col("n")).alias("middle"),
    )
    meets = F.col("low") <= F.col("high")
    inner = F.col("low") + ((F.col("high") - F.col("low")) / 2).cast("int")
    return summary.select(
        *EPISODE,
        F.when(meets, inner).otherwise(F.col("middle")).alias("midpoint"),
        F.when(meets, F.col("high") - F.col("low")).otherwise(999.0).alias("range_days"),
    )


def refine_start(
    weeks: DataFrame, consensus: DataFrame, config: EpisodeConfig | None = None
) -> DataFrame:
    """Start and precision of each episode with dated records.

    Week records inside the consensus range are used if they are more than half of all, otherwise
    all are.  Episodes with ranges only stay undated unless the configuration asks otherwise.
    """
    inside = F.col("implied_start").between(F.col("consensus_start"), F.col("consensus_end"))
    joined = join_growing(weeks, consensus, EPISODE, "left").withColumn("inside", F.coalesce(inside, F.lit(False)))
    chosen = F.when(F.col("inside"), F.col("implied_start"))
    stats = joined.groupBy(*EPISODE).agg(
        F.sum("n").alias("total"),
        F.sum(F.when(F.col("inside"), F.col("n")).otherwise(0)).alias("n_inside"),
        F.bool_or(F.col("consensus_start").isNotNull()).alias("has_consensus"),
        F.percentile("implied_start", 0.5, F.col("n")).alias("median_all"),
        (F.max("implied_start") - F.min("implied_start")).alias("spread_all"),
        F.percentile(chosen, 0.5, F.col("n")).alias("median_inside"),
        (F.max(chosen) - F.min(chosen)).alias("spread_inside"),
    )
    use_inside = F.col("has_consensus") & (F.col("n_inside") / F.col("total") > 0.5)
    poor = ~F.col("has_consensus") & (F.col("total") == 1)
    refined = stats.select(
        *EPISODE,
        F.when(use_inside, F.col("median_inside")).otherwise(F.col("median_all")).alias("inferred_start"),
        F.when(poor, -1.0)
        .when(use_inside, F.col("spread_inside"))
        .otherwise(F.col("spread_all"))
        .alias("precision_days"),
    )
    if config is None or not config.use_range_midpoint:
        return refined
    width = F.col("consensus_end") - F.col("consensus_start")
    ranges_only = join_growing(consensus, refined.select(*EPISODE), EPISODE, "left_anti").select(
        *EPISODE,
        (F.col("consensus_start") + (width / 2).cast("int")).alias("inferred_start"),
        width.alias("precision_days"),
    )
    return refined.unionByName(ranges_only)


def apply_refinement(episodes: DataFrame, refined: DataFrame) -> DataFrame:
    """Refined start, length and precision; episodes without dated records get 999."""
    end = day_of(F.col("episode_end_date"))
    start = F.col("inferred_start")
    return (
        join_growing(episodes, refined, EPISODE, "left")
        .withColumns(
            {
                "episode_start_date": F.coalesce(date_of(start), F.col("episode_start_date")),
                "gestational_age_days": F.coalesce(end - start, F.col("gestational_age_days").cast("double")),
                "precision_days": F.coalesce("precision_days", F.lit(999.0)),
            }
        )
        .withColumn("precision_category", precision_category(F.col("precision_days")))
        .drop("inferred_start")
    )


def bound_refined_dates(episodes: DataFrame) -> DataFrame:
    """A start after the end or more than 320 days before it becomes end - 280."""
    start, end = F.col("episode_start_date"), F.col("episode_end_date")
    odd = (start > end) | (start < F.date_sub(end, 320))
    return episodes.withColumn(
        "episode_start_date", F.when(odd, F.date_sub(end, 280)).otherwise(start)
    ).withColumn(
        "gestational_age_days", F.datediff("episode_end_date", "episode_start_date").cast("double")
    )


# Typical length in days by outcome, and for any other outcome.
TYPICAL_LENGTH = {"LB": 280, "SB": 280, "DELIV": 280, "AB": 91, "SA": 91, "ECT": 63, "PREG": 140}
TYPICAL_LENGTH_OTHER = 200


def simple_start_dates(episodes: DataFrame) -> DataFrame:
    """Start by the stated length, else by the typical length of the outcome."""
    stated = F.when(F.col("gestational_age_days") > 0, F.col("gestational_age_days"))
    typical = lookup(F.col("outcome_category"), TYPICAL_LENGTH, TYPICAL_LENGTH_OTHER)
    length = F.coalesce(stated, typical.cast("double"))
    return episodes.withColumn(
        "episode_start_date", date_of(day_of(F.col("episode_end_date")) - length)
    )


def date_episodes(
    episodes: DataFrame, events: DataFrame, timing: DataFrame, rules: Rules, config: EpisodeConfig
) -> DataFrame:
    """Episodes with refined start dates and their precision."""
    matched = materialize(timing_to_episode(dated_records(timing_records(events, timing, rules)), episodes))
    refined = refine_start(gw_outlier_filter(matched), interval_consensus(matched), config)
    return apply_refinement(episodes, refined)
