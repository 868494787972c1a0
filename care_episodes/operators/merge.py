"""Merging outcome-based and timing-based episodes into one history per person.

Episodes of one source do not overlap or lie at least a month apart, so a person has at most a
few hundred per source.  All steps after the full join work on rows partitioned by person: the
match rounds are windows over (person, id), which that partitioning already satisfies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.config import MONTH_DAYS, REPORTED_MONTH_DAYS, EpisodeConfig
from care_episodes.functions.dates import date_of, day_of
from care_episodes.functions.primitives import clip_to_previous, join_growing
from care_episodes.functions.rules import is_in
from care_episodes.operators.progression import best_outcome
from care_episodes.session import materialize

MATCH_ROUNDS = 5
MATCHED_PPS_LIMIT = 310


def episode_windows(episodes: DataFrame) -> DataFrame:
    """M1: look-back and look-ahead dates, and the window they span with the episode."""
    start, end = day_of(F.col("episode_start_date")), day_of(F.col("episode_end_date"))
    by_outcome = (
        F.when(is_in(F.col("outcome_category"), ("LB", "SB", "DELIV")), end + MONTH_DAYS)
        .when(is_in(F.col("outcome_category"), ("ECT", "AB", "SA")), end + 60)
        .otherwise(end + 90)
    )
    expected = F.coalesce(start + F.col("gestational_age_days") + MONTH_DAYS, by_outcome)
    order = Window.partitionBy("person_id").orderBy("episode_start_date", "episode_end_date", "episode_number")
    until_next = day_of(F.lead("episode_start_date").over(order)) - 1
    return (
        episodes.withColumns({"_back": end - 14, "_ahead": F.least(until_next, expected), "_expected": expected})
        .withColumns(
            {
                "lookback_date": date_of(F.col("_back")),
                "expected_end_date": date_of(F.col("_expected")),
                "lookahead_date": date_of(F.col("_ahead")),
                "window_start": date_of(F.least(start, F.col("_back"))),
                "window_end": date_of(F.greatest(end, F.col("_ahead"))),
            }
        )
        .drop("_back", "_ahead", "_expected")
    )


def episode_overlaps(hip: DataFrame, pps: DataFrame) -> DataFrame:
    """M2: pairs of both sources whose windows meet, with the size of the overlap."""

    def side(df: DataFrame, p: str) -> DataFrame:
        return df.select(
            "person_id",
            F.col("episode_number").alias(f"{p}_episode_num"),
            F.col("episode_start_date").alias(f"{p}_start"),
            F.col("episode_end_date").alias(f"{p}_end"),
            F.col("window_start").alias(f"{p}_window_start"),
            F.col("window_end").alias(f"{p}_window_end"),
            F.col("outcome_category").alias(f"{p}_outcome"),
            F.col("gestational_age_days").alias(f"{p}_gest_days"),
        )

    h, p = side(hip, "hip"), side(pps, "pps").withColumnRenamed("person_id", "_person")
    pairs = join_growing(
        h, p,
        (F.col("person_id") == F.col("_person"))
        & (F.col("hip_window_start") <= F.col("pps_window_end"))
        & (F.col("hip_window_end") >= F.col("pps_window_start")),
    ).drop("_person")

    def days(a_start: str, a_end: str, b_start: str, b_end: str) -> Column:
        return F.datediff(F.least(a_end, b_end), F.greatest(a_start, b_start)) + 1

    core = F.greatest(days("hip_start", "hip_end", "pps_start", "pps_end"), F.lit(0))
    window = days("hip_window_start", "hip_window_end", "pps_window_start", "pps_window_end")
    return pairs.withColumns({"core_overlap_days": core, "window_overlap_days": window}).withColumns(
        {
            "hip_overlap_pct": F.col("core_overlap_days") / (F.datediff("hip_end", "hip_start") + 1),
            "pps_overlap_pct": F.col("core_overlap_days") / (F.datediff("pps_end", "pps_start") + 1),
            "overlap_type": F.when(F.col("core_overlap_days") > 0, "core")
            .when(F.col("window_overlap_days") > 0, "window")
            .otherwise("none"),
        }
    )


def _flag_duplicates(df: DataFrame) -> DataFrame:
    for flag, key in (("hip_dup", "hip_id"), ("pps_dup", "pps_id")):
        n = F.count(F.lit(1)).over(Window.partitionBy("person_id", key))
        df = df.withColumn(flag, F.when(F.col(key).isNotNull(), (n > 1).cast("int")))
    return df


def interval_full_join(hip: DataFrame, pps: DataFrame) -> DataFrame:
    """M3: all episodes of both sources, paired where [start, end] meets [start, end + 60 days]."""
    h = hip.select(
        F.col("person_id").alias("h_person"),
        F.col("episode_number").alias("hip_id"),
        F.col("episode_start_date").alias("hip_start"),
        F.col("episode_end_date").alias("hip_end"),
        F.col("outcome_category").alias("hip_category"),
        F.col("gestational_age_days").alias("hip_gest_days"),
    )
    p = pps.select(
        F.col("person_id").alias("p_person"),
        F.col("episode_number").alias("pps_id"),
        F.col("episode_start_date").alias("pps_start"),
        F.col("episode_end_date").alias("pps_end"),
        F.col("outcome_category").alias("pps_category"),
        F.col("gestational_age_days").alias("pps_gest_days"),
    )
    joined = join_growing(
        h, p,
        (F.col("h_person") == F.col("p_person"))
        & (F.col("hip_start") <= F.date_add("pps_end", 2 * MONTH_DAYS))
        & (F.col("hip_end") >= F.col("pps_start")),
        "full",
    )
    rows = joined.withColumn("person_id", F.coalesce("h_person", "p_person")).drop("h_person", "p_person")
    with_dates = rows.repartition("person_id").withColumns(
        {
            "merged_start": F.least("hip_start", "pps_start", "hip_end"),
            "merged_end": F.greatest("pps_end", "hip_end"),
        }
    )
    months = F.datediff("merged_end", "merged_start") / F.lit(REPORTED_MONTH_DAYS)
    return _flag_duplicates(with_dates.withColumn("merged_length_months", months))


def one_to_one_match(pairs: DataFrame, config: EpisodeConfig | None = None) -> DataFrame:
    """M4: keep one partner per episode, in up to five rounds.

    In a round every duplicated episode of either source names its best partner: the closest end
    date, then the longest timing episode of at most 310 days.  Named pairs stay, the others go.
    A pair that is unique on both sides is settled: no other pair shares its ids, so later rounds
    leave it alone.  Most pairs are settled from the start, and the rounds see only the contested
    ones; within a round nothing is shuffled.  Give stored pairs: both groups read them.
    """
    hip_dup, pps_dup = F.col("hip_dup") == 1, F.col("pps_dup") == 1
    has_both = F.col("hip_id").isNotNull() & F.col("pps_id").isNotNull()
    settled = pairs.filter((F.coalesce("hip_dup", F.lit(0)) == 0) & (F.coalesce("pps_dup", F.lit(0)) == 0))
    contested = pairs.filter((hip_dup | pps_dup) & has_both).repartition("person_id")
    apart = F.abs(F.datediff("hip_end", "pps_end"))
    length = F.abs(F.datediff("pps_end", "pps_start"))
    no_outcome = F.col("pps_category").isNull()
    for_hip = [
        F.when(no_outcome, 10000).otherwise(apart),
        F.when(no_outcome | (length > MATCHED_PPS_LIMIT), -1).otherwise(length).desc(),
        F.col("pps_id"),
    ]
    for_pps = [apart, F.when(length > MATCHED_PPS_LIMIT, -1).otherwise(length).desc(), F.col("hip_id")]
    for _ in range(MATCH_ROUNDS):
        named_by_hip = F.row_number().over(Window.partitionBy("person_id", "hip_id").orderBy(*for_hip)) == 1
        named_by_pps = F.row_number().over(Window.partitionBy("person_id", "pps_id").orderBy(*for_pps)) == 1
        stays = (~hip_dup & ~pps_dup) | (hip_dup & F.col("_by_hip")) | (pps_dup & F.col("_by_pps"))
        named = contested.withColumns({"_by_hip": named_by_hip, "_by_pps": named_by_pps}).filter(stays)
        contested = _flag_duplicates(named.drop("_by_hip", "_by_pps"))
    matched = settled.unionByName(contested)
    if config is None or not config.keep_unmatched:
        return matched
    return _with_losers(pairs, matched)


def _with_losers(pairs: DataFrame, matched: DataFrame) -> DataFrame:
    """Episodes that lost every round, back without a partner."""
    out = matched
    for own, other in (("hip", "pps"), ("pps", "hip")):
        key = ["person_id", f"{own}_id"]
        lost = join_growing(pairs.filter(F.col(f"{own}_id").isNotNull()), matched.select(*key), key, "left_anti")
        blank = {c: F.lit(None).cast(t) for c, t in pairs.dtypes if c.startswith(f"{other}_")}
        single = lost.withColumns(blank).withColumn(f"{own}_dup", F.lit(0))
        out = out.unionByName(single.dropDuplicates(key))
    return out


def format_merged(matched: DataFrame) -> DataFrame:
    """M5: dates, source, outcome and length of each merged episode, numbered per person."""
    both = F.col("hip_id").isNotNull() & F.col("pps_id").isNotNull()
    start = F.least("hip_start", "pps_start", "hip_end")
    end = F.greatest("pps_end", "hip_end")
    length = F.coalesce(
        (F.col("hip_gest_days") + F.col("pps_gest_days")) / 2,
        F.col("hip_gest_days").cast("double"),
        F.col("pps_gest_days").cast("double"),
        F.datediff(end, start).cast("double"),
    )
    order = Window.partitionBy("person_id").orderBy("episode_start_date", "hip_id", "pps_id")
    return (
        matched.withColumns(
            {
                "episode_start_date": start,
                "episode_end_date": end,
                "HIP_outcome_category": F.col("hip_category"),
                "PPS_outcome_category": F.when(
                    F.col("pps_id").isNotNull(), F.coalesce("pps_category", F.lit("PREG"))
                ),
                "HIP_end_date": F.col("hip_end"),
                "PPS_end_date": F.col("pps_end"),
                "outcome_category": F.coalesce("hip_category", "pps_category"),
                "gestational_age_days": length.cast("int").cast("double"),
                "algorithm_used": F.when(both, "MERGED").when(F.col("hip_id").isNotNull(), "HIP").otherwise("PPS"),
            }
        )
        .withColumn("episode_number", F.row_number().over(order))
        .select(*MERGED_COLUMNS)
    )


MERGED_COLUMNS = (
    "person_id", "episode_number", "episode_start_date", "episode_end_date", "HIP_outcome_category",
    "PPS_outcome_category", "HIP_end_date", "PPS_end_date", "outcome_category",
    "gestational_age_days", "algorithm_used", "hip_id", "pps_id",
)


def no_overlap_union(hip: DataFrame, pps: DataFrame) -> DataFrame:
    """M6: both sources side by side, when nothing overlaps.  Takes the output of M1."""

    def one(df: DataFrame, source: str) -> DataFrame:
        is_hip = source == "HIP"
        none_text, none_date = F.lit(None).cast("string"), F.lit(None).cast("date")
        none_id = F.lit(None).cast("int")
        outcome, end, number = F.col("outcome_category"), F.col("episode_end_date"), F.col("episode_number")
        return df.select(
            "person_id", "episode_number", "episode_start_date", "episode_end_date",
            (outcome if is_hip else none_text).alias("HIP_outcome_category"),
            (none_text if is_hip else outcome).alias("PPS_outcome_category"),
            (end if is_hip else none_date).alias("HIP_end_date"),
            (none_date if is_hip else end).alias("PPS_end_date"),
            "outcome_category",
            F.col("gestational_age_days").cast("double").alias("gestational_age_days"),
            F.lit(source).alias("algorithm_used"),
            (number if is_hip else none_id).alias("hip_id"),
            (none_id if is_hip else number).alias("pps_id"),
            "lookback_date", "lookahead_date",
        )

    return one(hip, "HIP").unionByName(one(pps, "PPS"))


def window_outcome_update(episodes: DataFrame, outcomes: DataFrame) -> DataFrame:
    """M7: the best outcome inside the look-back/look-ahead window replaces outcome and end.

    Does nothing to episodes that carry no window (the matched ones).
    """
    if "lookback_date" not in episodes.columns:
        return episodes
    windows = episodes.withColumns(
        {"_low": day_of(F.col("lookback_date")), "_until": day_of(F.col("lookahead_date"))}
    ).withColumnRenamed("_low", "_from")
    found = best_outcome(windows, outcomes, "_from", "_until")
    end = F.coalesce(date_of(F.col("best.outcome_day")), F.col("episode_end_date"))
    return (
        found.withColumns(
            {"outcome_category": F.coalesce("best.found", "outcome_category"), "episode_end_date": end}
        )
        .withColumn(
            "gestational_age_days",
            F.datediff("episode_end_date", "episode_start_date").cast("double"),
        )
        .drop("best", "_from", "_until")
    )


def finalize_episodes(episodes: DataFrame) -> DataFrame:
    """M8: number by start, remove overlaps with the previous episode, keep 1 to 320 days."""
    ties = ["episode_start_date", "hip_id", "pps_id"]
    order = Window.partitionBy("person_id").orderBy(*ties)
    numbered = episodes.withColumn("episode_number", F.row_number().over(order)).withColumns(
        {"start_day": day_of(F.col("episode_start_date")), "end_day": day_of(F.col("episode_end_date"))}
    )
    return (
        clip_to_previous(numbered, "start_day", "end_day", "hip_id", "pps_id")
        .withColumn("gestational_age_days", (F.col("end_day") - F.col("_start")).cast("double"))
        .filter("gestational_age_days > 0 AND gestational_age_days <= 320")
        .withColumn("episode_start_date", date_of(F.col("_start")))
        .drop("start_day", "end_day", "_start", "lookback_date", "lookahead_date")
    )


def episode_output(episodes: DataFrame) -> DataFrame:
    """M9: the 16 output columns."""
    have = set(episodes.columns)
    used = F.col("algorithm_used") if "algorithm_used" in have else F.lit("HIP")
    hip = is_in(used, ("HIP", "MERGED", "HIP_chosen", "HIP_only"))
    pps = is_in(used, ("PPS", "MERGED", "PPS_chosen", "PPS_only"))

    def given(name: str, flag: Column, fallback: str) -> Column:
        return (F.col(name) if name in have else F.when(flag, F.col(fallback))).alias(name)

    months = F.datediff("episode_end_date", "episode_start_date") / F.lit(REPORTED_MONTH_DAYS)
    return episodes.select(
        "person_id",
        "episode_number",
        F.col("episode_start_date").alias("recorded_episode_start"),
        F.col("episode_end_date").alias("recorded_episode_end"),
        months.alias("recorded_episode_length"),
        "episode_start_date",
        "episode_end_date",
        given("HIP_outcome_category", hip, "outcome_category"),
        given("PPS_outcome_category", pps, "outcome_category"),
        given("HIP_end_date", hip, "episode_end_date"),
        given("PPS_end_date", pps, "episode_end_date"),
        hip.cast("int").alias("HIP_flag"),
        pps.cast("int").alias("PPS_flag"),
        "outcome_category",
        F.col("gestational_age_days").cast("double").alias("gestational_age_days"),
        used.alias("algorithm_used"),
    )


def merge_matched(hip: DataFrame, pps: DataFrame, config: EpisodeConfig | None = None) -> DataFrame:
    """M3-M5, M8, M9: the merge when the sources overlap somewhere (M7 has no window to use)."""
    return _merge_pairs(materialize(interval_full_join(hip, pps)), config)


def _merge_pairs(pairs: DataFrame, config: EpisodeConfig | None) -> DataFrame:
    return episode_output(finalize_episodes(format_merged(one_to_one_match(pairs, config))))


def merge_disjoint(hip: DataFrame, pps: DataFrame, outcomes: DataFrame) -> DataFrame:
    """M6-M9: the merge when the sources overlap nowhere."""
    union = no_overlap_union(episode_windows(hip), episode_windows(pps))
    return episode_output(finalize_episodes(window_outcome_update(union, outcomes)))


def merge_episodes(
    hip: DataFrame, pps: DataFrame, outcomes: DataFrame, config: EpisodeConfig | None = None
) -> DataFrame:
    """One history per person.

    Which way to go depends on facts about the whole input.  Empty sources show in the first row.
    A pair whose episodes themselves meet proves that windows overlap; only if the stored pairs
    hold none is the window join (M2) run to find out.
    """
    if pps.isEmpty():
        return episode_output(hip.withColumn("algorithm_used", F.lit("HIP")))
    if hip.isEmpty():
        return episode_output(pps.withColumn("algorithm_used", F.lit("PPS")))
    pairs = materialize(interval_full_join(hip, pps))
    meets = (F.col("hip_start") <= F.col("pps_end")) & (F.col("hip_end") >= F.col("pps_start"))
    if pairs.filter(meets).isEmpty() and episode_overlaps(episode_windows(hip), episode_windows(pps)).isEmpty():
        return merge_disjoint(hip, pps, outcomes)
    return _merge_pairs(pairs, config)
