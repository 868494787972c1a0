"""Cohort building on finished episodes.

Episodes of one person do not overlap and last at least a day, so windows over the episodes of a
person are bounded by the calendar.  Clinical events are not: they are restricted to the wanted
concepts, joined by (person, time bucket) and, where rows are not asked for, counted per day first.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from care_episodes.functions import study_values as sv
from care_episodes.functions.dates import day_of
from care_episodes.functions.primitives import best_point, join_growing, points_in_intervals
from care_episodes.functions.rules import is_in, lookup
from care_episodes.functions.scan import PART, neighbours, ordered_parts, running_sums
from care_episodes.sources.cdm import Tables, with_codes

EPISODE_KEY = ("person_id", "inferred_episode_end")


# ---- survey and demographics ----------------------------------------------------------------
def survey_wide(answers: DataFrame, questions: Sequence[str]) -> DataFrame:
    """K1: first answer and date of each question, one row per person, and the earliest date.

    `answers` has person_id, question, answer, survey_date, response_id.
    """
    answer = F.when(F.col("answer").isin(*sv.SKIPPED_ANSWERS), "Skip").otherwise(F.col("answer"))
    order = F.struct("survey_date", "response_id")
    columns = []
    for q in questions:
        asked = F.col("question") == q
        columns.append(F.min_by(answer, F.when(asked, order)).alias(q))
        columns.append(F.min(F.when(asked, F.col("survey_date"))).alias(f"{q}_date"))
    wide = answers.groupBy("person_id").agg(*columns)
    dates = [f"{q}_date" for q in questions]
    earliest = F.least(*dates) if len(dates) > 1 else F.col(dates[0])
    return wide.withColumn("min_svy_date", earliest)


def closest_episode_to_survey(episodes: DataFrame) -> DataFrame:
    """K2: flag the episode that holds the survey date, else the one with the nearest edge.

    If several are flagged, only a single longest one stays, and only when no other episode of the
    person is unflagged; when that leaves none, all nearest ones are flagged.  The facts per person
    come from aggregates joined back, so a person with very many rows is not gathered in one place.
    """
    start, end, survey = F.col("inferred_episode_start"), F.col("inferred_episode_end"), F.col("min_svy_date")
    days = F.col("gestational_age_days")
    df = episodes.withColumns(
        {
            "time_from_end": F.datediff(survey, end),
            "time_to_start": F.datediff(start, survey),
            "_holds": F.coalesce(survey.between(start, end), F.lit(False)),
        }
    ).withColumn("min_time", F.least(F.abs("time_from_end"), F.abs("time_to_start")))
    nearest = df.groupBy("person_id").agg(
        F.min("min_time").alias("_least"), F.bool_or("_holds").alias("_any_holds")
    )
    df = join_growing(df, nearest, "person_id").withColumn("_nearest", F.col("min_time") == F.col("_least"))
    flagged = F.col("_holds") | (F.col("_nearest") & ~F.col("_any_holds"))
    df = df.withColumn("_flagged", F.coalesce(flagged, F.lit(False)))
    by_length = df.groupBy("person_id", days.alias("_days")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if("_flagged").alias("_n_flagged")
    )
    facts = by_length.groupBy("person_id").agg(
        F.sum("_n").alias("_rows"), F.sum("_n_flagged").alias("_flags"),
        F.max("_days").alias("_longest"), F.max_by("_n", "_days").alias("_n_longest"),
    )
    single_longest = (F.col("_flags") == F.col("_rows")) & (F.col("_n_longest") == 1)
    is_longest = F.col("_flagged") & (days == F.col("_longest"))
    closest = (
        F.when(F.col("_flags") == 1, F.col("_flagged"))
        .when((F.col("_flags") > 1) & single_longest, is_longest)
        .otherwise(F.col("_nearest"))
    )
    out = join_growing(df, facts, "person_id").withColumn("closest_pregnancy", F.coalesce(closest, F.lit(False)).cast("int"))
    return out.drop(*[c for c in out.columns if c.startswith("_")])


def survey_timing(episodes: DataFrame) -> DataFrame:
    """K3: was the survey taken before, during or after the episode?"""
    start, end = F.col("inferred_episode_start"), F.col("inferred_episode_end")
    survey, asked, answer = F.col("min_svy_date"), F.col("pregnancy_date"), F.col("pregnancy")
    not_yes = is_in(answer, ("No", "Skip")) | answer.isNull()
    holds = survey.between(start, end)
    label = (
        F.when((F.date_sub(end, 30) < asked) & not_yes, "After")
        .when((start > asked) & not_yes, "Before")
        .when((answer == "Yes") & holds, "During")
        .when((answer == "Yes") & (F.col("closest_pregnancy") == 1), "During")
        .when(is_in(answer, ("No", "Skip")) & survey.between(start, F.date_add(start, 84)), "During")
        .when(holds & (answer.isNull() | (answer == "Skip")), "During")
        .when(end < survey, "After")
        .when(start > survey, "Before")
        .otherwise("Unclear")
    )
    return episodes.withColumn("took_the_survey", label)


def _recode(col: Column, table: Mapping[str, str]) -> Column:
    """Named values replaced, others kept, non-answers to null."""
    value = F.coalesce(lookup(col, table), col)
    return F.when(~is_in(value, sv.NO_ANSWER), value)


def recode_demographics(df: DataFrame) -> DataFrame:
    """K4: category columns for whichever survey columns are present."""
    c = F.col
    race = (
        F.when(c("race_eth").contains("Hispanic"), "Hispanic")
        .when(c("race_eth").contains(","), "Multiple")
        .when(c("race_eth") == "RaceEthnicityNoneOfThese", "Other")
        .otherwise(c("race_eth"))
    )
    gender = F.when(
        is_in(c("gender"), ("NonBinary", "Transgender", "AdditionalOptions")) | c("gender").contains(","),
        "Other/multiple",
    ).otherwise(c("gender"))
    orientation = (
        F.when(is_in(c("sexual_orientation"), ("Gay", "Lesbian")), "Gay/lesbian")
        .when(c("sexual_orientation").contains("Bisexual"), "Bisexual")
        .when(c("sexual_orientation").rlike("Gay|Lesbian"), "Gay/lesbian")
        .otherwise(c("sexual_orientation"))
    )
    made = {
        "race_eth": ("race_eth_cat", _recode(race, sv.RACE)),
        "gender": ("gender_cat", _recode(gender, {})),
        "sexual_orientation": ("orientation_cat", _recode(orientation, {})),
        "income": ("income_cat", _recode(c("income"), sv.INCOME)),
        "education": ("edu_cat", _recode(c("education"), sv.EDUCATION)),
        "marital_status": ("marital_status_cat", _recode(c("marital_status"), sv.MARITAL_STATUS)),
        "state_of_residence": ("state_cat", lookup(c("state_of_residence"), sv.STATES)),
        "final_outcome_category": ("outcome_label", lookup(c("final_outcome_category"), sv.OUTCOME_LABELS)),
        **{source: (name, _recode(c(source), {})) for source, name in sv.PLAIN_ANSWERS.items() if source in df.columns},
    }
    out = df.withColumns({name: col for source, (name, col) in made.items() if source in df.columns})
    if "race_eth" in df.columns:
        out = out.withColumn("race_eth_5cat", lookup(c("race_eth_cat"), sv.RACE_FIVE))
    return out


def age_band(age: Column) -> Column:
    """Five-year band of an age in years; below 15 and from 50 on are one band each."""
    low = (F.floor(age / 5) * 5).cast("int")
    text = F.concat_ws("", low.cast("string"), F.lit("-"), (low + 4).cast("string"), F.lit(" years"))
    return (
        F.when(age < 0, F.lit(None))
        .when(age < 15, "0-14 years")
        .when(age < 50, text)
        .when(age <= 55, "50 years and over")
    )


def year_band(date: Column) -> Column:
    year = F.year(date)
    return F.when(year <= 2015, "2015 and earlier").when(year <= 2022, year.cast("string"))


def resolution(precision: Column) -> Column:
    """Dating precision in four levels."""
    return (
        F.when(precision.isin("week", "two-week", "three-week"), "Week-level")
        .when(precision.isin("month", "two-month", "three-month"), "Month-level")
        .when(precision == "week_poor-support", "Week-level (1 concept)")
        .when(precision == "non-specific", "Non-specific")
    )


def bands(df: DataFrame) -> DataFrame:
    """K5: age, year, length and precision bands.  Needs `dob` for the ages."""
    start, end = F.col("inferred_episode_start"), F.col("inferred_episode_end")
    age = F.datediff(end, F.col("dob")) / F.lit(365.25)
    band = age_band(F.col("mom_age"))
    older = F.when(is_in(F.col("mom_age_cat"), ("45-49 years", "50 years and over")), "45 years and over")
    return (
        df.withColumns(
            {
                "year_start": F.year(start),
                "year_end": F.year(end),
                "gestational_age_weeks": F.col("gestational_age_days") / F.lit(7.0),
                "mom_age": age,
                "year_start_cat": year_band(start),
                "year_end_cat": year_band(end),
                "resolution": resolution(F.col("precision_category")),
            }
        )
        .withColumn("mom_age_cat", band)
        .withColumn("mom_age_cat_table", F.coalesce(older, F.col("mom_age_cat")))
    )


def lump_rare(df: DataFrame, column: str, least: int = 20, other: str = "Other") -> DataFrame:
    """K6: levels with fewer than `least` rows become one level; `<column>_rank` is the order by
    frequency.  Levels are counted first, so a level with most of the rows costs nothing extra; ranks go over ranges of levels."""
    counts = df.groupBy(F.col(column).alias("_level")).agg(F.count(F.lit(1)).alias("_n"))
    named = counts.filter("_level IS NOT NULL").withColumn(
        "_new", F.when(F.col("_n") < least, other).otherwise(F.col("_level"))
    )
    order = [F.desc("_total"), "_as"]
    totals = named.groupBy(F.col("_new").alias("_as")).agg(F.sum("_n").alias("_total"))
    ranked = running_sums(ordered_parts(totals, [], order), [], order, {"_rank": F.lit(1)})
    levels = named.join(ranked.select("_as", F.col("_rank").cast("int").alias("_rank")), F.col("_new") == F.col("_as"))
    joined = df.join(levels, F.col(column) == F.col("_level"), "left")
    return joined.withColumns({column: F.col("_new"), f"{column}_rank": F.col("_rank")}).drop(
        "_level", "_n", "_new", "_as", "_total", "_rank"
    )


def suppress_small_cells(df: DataFrame, columns: Sequence[str], least: int = 20) -> DataFrame:
    """K7: counts from 1 to `least` - 1 are shown as "<least"."""
    def shown(name: str) -> Column:
        n = F.col(name)
        return F.when((n > 0) & (n < least), f"<{least}").otherwise(n.cast("string"))

    return df.withColumns({c: shown(c) for c in columns})


def cross_tab(df: DataFrame, rows: str, columns: str, levels: Sequence) -> DataFrame:
    """K8: counts by two columns, wide; `levels` of the second one are given."""
    cells = [F.count_if(F.col(columns) == v).alias(f"{columns}_{v}") for v in levels]
    return df.groupBy(rows).agg(*cells)


def proportions(df: DataFrame, by: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """K8: counts by some columns and their share within others."""
    counts = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy(*within) if within else Window.partitionBy(F.lit(1))
    return counts.withColumn("prop", F.col("n") / F.sum("n").over(group))


def concordance_table(df: DataFrame, rich_from: dt.date) -> DataFrame:
    """K8: share of concordant episodes by precision and outcome, all beside data-rich episodes.

    Data-rich: seen by both sources, longer than zero days, started after `rich_from`.
    """
    start, end = F.col("inferred_episode_start"), F.col("inferred_episode_end")
    rich = (start < end) & (F.col("HIP_flag") == 1) & (F.col("PPS_flag") == 1) & (start > F.lit(rich_from))
    level = F.when(F.col("precision_category") == "week_poor-support", "Week (poor support)").otherwise(
        resolution(F.col("precision_category"))
    )
    low_score = F.col("outcome_concordance_score").isin(0, 1)
    counts = (
        df.withColumns({"resolution": level, "rich": F.coalesce(rich, F.lit(False)), "low": low_score})
        .groupBy("resolution", "outcome_category")
        .agg(
            F.count(F.lit(1)).alias("n_All"),
            F.count_if("low").alias("low_all"),
            F.count_if("rich").alias("n_rich"),
            F.count_if(F.col("rich") & F.col("low")).alias("low_rich"),
        )
    )

    def share(low: str, n: str) -> Column:
        return F.when(F.col(low) > 0, 1 - F.col(low) / F.col(n))

    return counts.filter("low_all > 0").select(
        "resolution", "outcome_category", "n_All", share("low_all", "n_All").alias("prop_All"),
        F.when(F.col("low_rich") > 0, F.col("n_rich")).alias("n_rich"), share("low_rich", "n_rich").alias("prop_rich"),
    )


def ga_distribution(df: DataFrame, by: str = "outcome_category") -> DataFrame:
    """K9: gestational age in weeks by outcome.  Ages are whole days, so quantiles stay small."""
    days = F.col("gestational_age_days")
    q = F.percentile(days, F.array(F.lit(0.05), F.lit(0.5), F.lit(0.95)))
    stats = df.groupBy(by).agg(
        F.count(days).alias("n"), F.count_if(days < 140).alias("short"), F.avg(days).alias("mean"),
        q.alias("q"), F.min(days).alias("min"), F.max(days).alias("max"),
    )
    week = F.lit(7.0)
    return stats.select(
        by, "n", F.try_divide(F.col("short") * 100.0, F.col("n")).alias("pct_less_20wks"),
        (F.col("mean") / week).alias("mean"), (F.col("q")[1] / week).alias("median"),
        (F.col("min") / week).alias("min"), (F.col("max") / week).alias("max"),
        (F.col("q")[0] / week).alias("q5"), (F.col("q")[2] / week).alias("q95"),
    )


# ---- exclusions, vocabularies, concept sets -------------------------------------------------
def exclusion_steps(first_start: dt.date) -> dict[str, Column]:
    weeks = F.col("gestational_age_days") / 7
    return {
        "delivery_outcome": is_in(F.col("outcome_category"), ("LB", "DELIV", "SB")),
        "plausible_length": F.coalesce((weeks >= 20) & (weeks <= 45), F.lit(False)),
        "start_in_period": F.coalesce(F.col("inferred_episode_start") >= F.lit(first_start), F.lit(False)),
    }


def apply_exclusions(df: DataFrame, first_start: dt.date = dt.date(2007, 1, 31)) -> DataFrame:
    """Delivery outcomes of 20 to 45 weeks that start in the study period."""
    for condition in exclusion_steps(first_start).values():
        df = df.filter(condition)
    return df


def attrition(df: DataFrame, first_start: dt.date = dt.date(2007, 1, 31)) -> DataFrame:
    """Episodes left after each exclusion, one row from one pass."""
    kept, columns = F.lit(True), [F.count(F.lit(1)).alias("all_episodes")]
    for name, condition in exclusion_steps(first_start).items():
        kept = kept & condition
        columns.append(F.count_if(kept).alias(name))
    persons = F.count_distinct(F.when(kept, F.col("person_id"))).alias("persons_left")
    return df.agg(*columns, persons)


def map_icd_to_standard(codes: DataFrame, concept: DataFrame, relationship: DataFrame) -> DataFrame:
    """ICD9/10 codes to the standard concepts they map to.  `codes` has `concept_code`."""
    sources = (
        concept.filter(F.col("vocabulary_id").isin("ICD9CM", "ICD10CM"))
        .join(codes.select("concept_code").distinct(), "concept_code")
        .select(
            F.col("concept_id").alias("concept_id_1"), F.col("concept_code").alias("icd_code"),
            F.col("concept_name").alias("icd_name"),
        )
    )
    targets = concept.select(
        F.col("concept_id").alias("concept_id_2"), "concept_code", "concept_name", "vocabulary_id", "domain_id"
    )
    maps = relationship.filter("relationship_id = 'Maps to'").select("concept_id_1", "concept_id_2")
    return maps.join(sources, "concept_id_1").join(targets, "concept_id_2", "left")


def descendants(concepts: DataFrame, ancestor: DataFrame) -> DataFrame:
    """The concepts themselves and all their descendants."""
    wanted = concepts.select("concept_id").distinct()
    below = ancestor.join(wanted, F.col("ancestor_concept_id") == F.col("concept_id")).select(
        F.col("descendant_concept_id").alias("concept_id")
    )
    return wanted.unionByName(below).distinct()


# Table, concept column, date column of the domains a concept set can look in.
DOMAIN_TABLES = {
    "condition": ("condition_occurrence", "condition_concept_id", "condition_start_date"),
    "measurement": ("measurement", "measurement_concept_id", "measurement_date"),
    "visit": ("visit_occurrence", "visit_concept_id", "visit_start_date"),
    "device": ("device_exposure", "device_concept_id", "device_exposure_start_date"),
    "observation": ("observation", "observation_concept_id", "observation_date"),
    "procedure": ("procedure_occurrence", "procedure_concept_id", "procedure_date"),
}

#: Days that stand for an open side.
FIRST_DAY, LAST_DAY = -(10**7), 10**7


def set_events(tables: Tables, concepts: DataFrame, domains: Sequence[str] = ("condition",)) -> DataFrame:
    """Events of a concept set: person_id, concept_id, concept_date, value_as_number."""
    wanted = concepts.select("concept_id").distinct()
    out = None
    for domain in domains:
        table, concept, date = DOMAIN_TABLES[domain]
        source = tables[table]
        value = F.col("value_as_number") if "value_as_number" in source.columns else F.lit(None)
        part = with_codes(source.select(
            "person_id", F.col(concept).cast("bigint").alias("concept_id"),
            F.col(date).cast("date").alias("concept_date"), value.cast("double").alias("value_as_number"),
        ), wanted)
        out = part if out is None else out.unionByName(part)
    return out


def events_in_window(
    cohort: DataFrame,
    events: DataFrame,
    start: str | None,
    end: str | None,
    key: Sequence[str] = ("person_id", "episode_id"),
    bucket_days: int = 366,
) -> DataFrame:
    """Events inside [start, end] of each cohort row, with the key of the row.

    An open start or end takes every earlier or later event of the person.
    """
    bounds = [c for c in (start, end) if c]
    rows = cohort.select(*dict.fromkeys([*key, "person_id", *bounds]))
    points = events.withColumn("_day", day_of(F.col("concept_date")))
    if not (start and end):
        # An open side reaches to the person's first or last event, so that a heavy person still spreads over buckets.
        rows = join_growing(rows, event_edges(events), "person_id")
    from_day = day_of(F.col(start)) if start else day_of(F.col("_first"))
    to_day = day_of(F.col(end)) if end else day_of(F.col("_last"))
    joined = points_in_intervals(rows.filter(from_day <= to_day), points, ["person_id"], from_day, to_day, "_day", bucket_days)
    return joined.drop("_day", "_first", "_last", *[b for b in bounds if b not in key])


def event_edges(events: DataFrame) -> DataFrame:
    """First and last event date of each person."""
    return events.groupBy("person_id").agg(F.min("concept_date").alias("_first"), F.max("concept_date").alias("_last"))


def concept_set_events(
    cohort: DataFrame,
    events: DataFrame,
    start: str | None,
    end: str | None,
    output: str = "all",
    name: str = "indicator",
    key: Sequence[str] = ("person_id", "episode_id"),
    bucket_days: int = 366,
) -> DataFrame:
    """Events of a set in a window of each cohort row.

    output='all' gives one row per event and keeps cohort rows without events; 'indicator' gives
    the cohort with a 0/1 column.  `events` comes from `set_events`.
    """
    key = list(key)
    if output == "all":
        # Rows with events come straight from the window join (an inner join, so a very heavy
        # person or day can be split); rows without are found by days, or by the person's first or last one.
        found = events_in_window(cohort, events, start, end, cohort.columns, bucket_days)
        seen = window_indicator(cohort, events, start, end, "_seen", key, bucket_days).drop("_seen")
        none = {c: F.lit(None).cast(t) for c, t in found.dtypes if c not in cohort.columns}
        return found.unionByName(join_growing(cohort, seen, key, "left_anti").withColumns(none))
    found = window_indicator(cohort, events, start, end, name, key, bucket_days)
    return join_growing(cohort, found, key, "left").fillna(0, [name])


def window_indicator(
    cohort: DataFrame,
    events: DataFrame,
    start: str | None,
    end: str | None,
    name: str,
    key: Sequence[str] = ("person_id", "episode_id"),
    bucket_days: int = 366,
) -> DataFrame:
    """The keys of cohort rows with an event in the window, `name` = 1.

    With one open side the earliest or latest event of the person decides.
    """
    key = list(key)
    if start and end:
        daily = events.select("person_id", "concept_date").distinct()
        found = events_in_window(cohort, daily, start, end, key, bucket_days)
        return found.select(*key).distinct().withColumn(name, F.lit(1))
    inside = F.lit(True)
    if end:
        inside = F.col("_first") <= F.col(end)
    if start:
        inside = F.col("_last") >= F.col(start)
    return join_growing(cohort, event_edges(events), "person_id").filter(inside).select(*key).distinct().withColumn(name, F.lit(1))


def collapse_indicator(found: DataFrame, prefix: str, key: Sequence[str] = EPISODE_KEY) -> DataFrame:
    """Earliest and latest date, 0/1 indicator and count (null if none) per episode."""
    n = F.count("concept_date")
    return found.groupBy(*key).agg(
        F.min("concept_date").alias(f"{prefix}_date_earliest"),
        F.max("concept_date").alias(f"{prefix}_date_latest"),
        (n > 0).cast("int").alias(f"{prefix}_indicator"),
        F.when(n > 0, n).alias(f"{prefix}_concept_count"),
    )


def set_summary(
    cohort: DataFrame, events: DataFrame, start: str, end: str, prefix: str,
    key: Sequence[str] = EPISODE_KEY, bucket_days: int = 366,
) -> DataFrame:
    """K13 and K14 in one: events are counted per person and day before they meet the windows."""
    daily = events.groupBy("person_id", "concept_date").agg(F.count(F.lit(1)).alias("_n"))
    windows = cohort.select(*dict.fromkeys([*key, "person_id", start, end])).distinct()
    points = daily.withColumn("_day", day_of(F.col("concept_date")))
    from_day, to_day = day_of(F.col(start)), day_of(F.col(end))
    found = points_in_intervals(
        windows.filter(F.col(start) <= F.col(end)), points, ["person_id"], from_day, to_day, "_day", bucket_days
    ).groupBy(*key).agg(
        F.min("concept_date").alias(f"{prefix}_date_earliest"),
        F.max("concept_date").alias(f"{prefix}_date_latest"),
        F.sum("_n").alias(f"{prefix}_concept_count"),
    )
    flag = F.col(f"{prefix}_concept_count").isNotNull().cast("int")
    episodes = cohort.select(*key).distinct()
    return join_growing(episodes, found, list(key), "left").withColumn(f"{prefix}_indicator", flag)


def many_set_events(tables: Tables, concepts: DataFrame, domains: Mapping[str, Sequence[str]]) -> DataFrame:
    """Events of many concept sets, one scan per table: person_id, set_name, concept_id, concept_date, value_as_number.

    `concepts` has set_name and concept_id; `domains` says for each set where it looks.
    """
    out = None
    for domain in dict.fromkeys(d for own in domains.values() for d in own):
        names = [name for name, own in domains.items() if domain in own]
        table, concept, date = DOMAIN_TABLES[domain]
        source = tables[table]
        value = F.col("value_as_number") if "value_as_number" in source.columns else F.lit(None)
        wanted = concepts.where(F.col("set_name").isin(names)).select("set_name", "concept_id").distinct()
        part = with_codes(source.select(
            "person_id", F.col(concept).cast("bigint").alias("concept_id"), F.col(date).cast("date").alias("concept_date"),
            value.cast("double").alias("value_as_number"),
        ), wanted).select("person_id", "set_name", "concept_id", "concept_date", "value_as_number")
        out = part if out is None else out.unionByName(part)
    return out


def window_summaries(
    cohort: DataFrame, events: DataFrame, windows: Mapping[str, tuple[str, str | None, str | None]],
    key: Sequence[str] = EPISODE_KEY, bucket_days: int = 366,
) -> DataFrame:
    """K13, K14 and K18 for many windows at once: {prefix: (set name, start column, end column)}, an open side is None.

    Events are counted per person, set and day; a row becomes one row per window; both meet in one join by (person, set, time bucket),
    and one aggregate per row of the cohort puts the windows side by side: earliest and latest date, indicator, count.
    """
    day = day_of(F.col("concept_date"))
    daily = events.groupBy("person_id", "set_name", day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    asked = []
    for prefix, (name, start, end) in windows.items():
        low = day_of(F.col(start)) if start else F.lit(FIRST_DAY)
        high = day_of(F.col(end)) if end else F.lit(LAST_DAY)
        asked.append(F.struct(F.lit(prefix).alias("_window"), F.lit(name).alias("set_name"), low.alias("_from"), high.alias("_to")))
    bounds = [c for _, start, end in windows.values() for c in (start, end) if c]
    rows = cohort.select(*dict.fromkeys([*key, "person_id", *bounds])).distinct()
    rows = rows.select(*dict.fromkeys([*key, "person_id"]), F.explode(F.array(*asked)).alias("w")).select("*", "w.*").drop("w").where("_from <= _to")
    if any(not (start and end) for _, start, end in windows.values()):
        spans = daily.groupBy("person_id", "set_name").agg(F.min("_day").alias("_first"), F.max("_day").alias("_last"))
        rows = join_growing(rows, spans, ["person_id", "set_name"]).withColumns({"_from": F.greatest("_from", "_first"), "_to": F.least("_to", "_last")})
        rows = rows.where("_from <= _to").drop("_first", "_last")
    met = points_in_intervals(rows, daily, ["person_id", "set_name"], F.col("_from"), F.col("_to"), "_day", bucket_days)
    found = []
    for prefix in windows:
        mine = F.col("_window") == prefix
        found += [
            F.date_from_unix_date(F.min(F.when(mine, F.col("_day"))).cast("int")).alias(f"{prefix}_date_earliest"),
            F.date_from_unix_date(F.max(F.when(mine, F.col("_day"))).cast("int")).alias(f"{prefix}_date_latest"),
            F.coalesce(F.max(F.when(mine, 1)), F.lit(0)).alias(f"{prefix}_indicator"),
            F.sum(F.when(mine, F.col("_n"))).alias(f"{prefix}_concept_count"),
        ]
    joined = join_growing(cohort, met.groupBy(*key).agg(*found), list(key), "left")
    return joined.fillna(0, [f"{prefix}_indicator" for prefix in windows])


def episode_buffers(df: DataFrame) -> DataFrame:
    """Dates around an episode: weeks, years, first trimester."""
    start, end = F.col("inferred_episode_start"), F.col("inferred_episode_end")
    return df.withColumns(
        {
            "start_minus_6wks": F.date_sub(start, 42),
            "end_plus_6wks": F.date_add(end, 42),
            "start_minus_12wks": F.date_sub(start, 84),
            "end_plus_12wks": F.date_add(end, 84),
            "year_before_preg": F.add_months(start, -12),
            "year_two_before_preg": F.add_months(start, -24),
            "year_after_preg": F.add_months(end, 12),
            "first_trimester": F.date_add(start, 91),
        }
    )


def join_observation_period(df: DataFrame, periods: DataFrame) -> DataFrame:
    """First and last observed date of the person."""
    spans = periods.groupBy("person_id").agg(
        F.min("observation_period_start_date").alias("observation_period_start_date"),
        F.max("observation_period_end_date").alias("observation_period_end_date"),
    )
    return join_growing(df, spans, "person_id")


def observed_throughout(df: DataFrame, periods: DataFrame, start: str, end: str) -> DataFrame:
    """Rows whose [start, end] lies inside one observation period of the person."""
    p = periods.select(
        F.col("person_id").alias("_person"), F.col("observation_period_start_date").alias("_from"),
        F.col("observation_period_end_date").alias("_to"),
    ).distinct()
    inside = (F.col("person_id") == F.col("_person")) & (F.col(start) >= F.col("_from")) & (F.col(end) <= F.col("_to"))
    return join_growing(df, p, inside, "left_semi")


def assemble_analysis(cohort: DataFrame, parts: Sequence[DataFrame], key: Sequence[str] = EPISODE_KEY) -> DataFrame:
    """The cohort with all collapsed sets beside it.  All joins share one key.

    Build the parts from one stored cohort, not from each other: a part built on a joined result
    repeats all earlier joins inside its own plan.
    """
    for part in parts:
        cohort = join_growing(cohort, part, list(key), "left")
    return cohort


# ---- analysis columns -----------------------------------------------------------------------
def _any(columns: Sequence[str]) -> Column:
    """1 if any is 1, 0 if none is and all are known, null otherwise."""
    cond = F.col(columns[0]) == 1
    for c in columns[1:]:
        cond = cond | (F.col(c) == 1)
    return F.when(cond, 1).when(~cond, 0)


def composites(df: DataFrame, outcomes: Sequence[str], adverse: Sequence[str]) -> DataFrame:
    """Any of the outcomes with its earliest date, any adverse pregnancy outcome.

    `outcomes` are prefixes of collapsed sets, `adverse` 0/1 columns.
    """
    dates = [f"{o}_date_earliest" for o in outcomes]
    return df.withColumns(
        {
            "any_outcome": _any([f"{o}_indicator" for o in outcomes]),
            "any_adverse": _any(list(adverse)),
            "any_date_earliest": F.least(*dates) if len(dates) > 1 else F.col(dates[0]),
        }
    )


def time_to_event(df: DataFrame, outcomes: Sequence[str]) -> DataFrame:
    """Days and years from the end of the episode to the event or the end of observation."""
    end = F.col("inferred_episode_end")
    censoring = F.datediff("observation_period_end_date", end)
    new = {}
    for o in outcomes:
        event = F.datediff(f"{o}_date_earliest", end)
        days = F.coalesce(event, censoring)
        new |= {
            f"time_to_{o}_event": event, f"time_to_{o}_days": days,
            f"time_to_{o}_years": days / F.lit(365.25), f"{o}_event": event.isNotNull().cast("int"),
        }
    return df.withColumns(new)


def censor_at(df: DataFrame, outcomes: Sequence[str], days: int, suffix: str) -> DataFrame:
    """Times cut at `days` (3652 for ten years, 4383 for twelve); later events do not count."""
    new = {}
    for o in outcomes:
        cut = F.when(F.col(f"time_to_{o}_days").isNotNull(), F.least(F.col(f"time_to_{o}_days"), F.lit(days)))
        event = F.col(f"time_to_{o}_event")
        new |= {
            f"time_to_{o}_days_{suffix}": cut, f"time_to_{o}_years_{suffix}": cut / F.lit(365.25),
            f"{o}_event_{suffix}": F.coalesce(event <= days, F.lit(False)).cast("int"),
        }
    return df.withColumns(new)


def first_episode(df: DataFrame, tie: str = "episode_id") -> DataFrame:
    """The episode with the earliest start of each person."""
    first = ["inferred_episode_start", tie]
    rest = [c for c in df.columns if c not in (*first, "person_id")]
    best = df.groupBy("person_id").agg(F.min(F.struct(*first, F.struct(*rest).alias("rest"))).alias("b"))
    flat = best.select("person_id", *[f"b.{c}" for c in first], *[f"b.rest.{c}" for c in rest])
    return flat.select(*df.columns)


def _pregnancies(df: DataFrame, indicator: str, tie: str) -> tuple[DataFrame, list[str]]:
    order = ["inferred_episode_end", tie]
    return ordered_parts(df.select("person_id", *order, indicator), ["person_id"], order), order


def exposure_pattern(df: DataFrame, indicator: str, tie: str = "episode_id") -> DataFrame:
    """The 0/1 values of a person's episodes in order, as text, and their number.

    Texts of ranges of episodes are put together first; the person's text is the result itself.
    """
    parts, order = _pregnancies(df, indicator, tie)
    steps = F.array_sort(F.collect_list(F.struct(*order, indicator)))
    values = F.transform(steps, lambda s: F.coalesce(s[indicator].cast("string"), F.lit("NA")))
    texts = parts.groupBy("person_id", PART).agg(F.array_join(values, " → ").alias("text"), F.count(F.lit(1)).alias("n"))
    in_order = F.transform(F.array_sort(F.collect_list(F.struct(PART, "text"))), lambda s: s["text"])
    return texts.groupBy("person_id").agg(F.array_join(in_order, " → ").alias("pattern"), F.sum("n").alias("n_pregnancies"))


def exposure_transitions(df: DataFrame, indicator: str, tie: str = "episode_id") -> DataFrame:
    """How often one value follows another, by pregnancy number."""
    parts, order = _pregnancies(df, indicator, tie)
    numbered = running_sums(parts, ["person_id"], order, {"preg_number": F.lit(1)})
    steps = neighbours(numbered, ["person_id"], order, {}, {"to_value": indicator, "_next": tie})
    return (
        steps.filter("_next IS NOT NULL")
        .groupBy(F.col("preg_number").cast("int").alias("preg_number"), F.col(indicator).alias("from_value"), "to_value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def concept_frequency(found: DataFrame, name: str = "concept_id") -> DataFrame:
    """Rows and persons per concept among the events found."""
    return found.filter("concept_date IS NOT NULL").groupBy(name).agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("person_id").alias("unique_persons")
    )


def nearest_measurement(
    cohort: DataFrame, events: DataFrame, prefix: str, latest_day: int | None = None,
    low: float | None = None, high: float | None = None,
) -> DataFrame:
    """The measurement nearest to the start of the (single) episode of each person.

    `latest_day` limits how long after the start it may be taken; `low` and `high` bound the value.
    """
    if low is not None:
        events = events.filter(F.col("value_as_number") >= low)
    if high is not None:
        events = events.filter(F.col("value_as_number") <= high)
    # Per person and day the smallest value is enough to know the nearest day's first value.
    daily = events.groupBy("person_id", day_of(F.col("concept_date")).alias("day")).agg(F.min("value_as_number").alias("value"))
    start = day_of(F.col("inferred_episode_start"))
    rows = cohort.select("person_id", start.alias("at"))
    latest = F.lit(None).cast("int") if latest_day is None else F.lit(latest_day)
    until = rows.withColumn("at", F.col("at") + F.least(F.coalesce(latest, F.lit(0)), F.lit(0)))
    earlier = best_point(until, daily, ["person_id"], "at", "day", F.struct((-F.col("day")).alias("order"), "day", "value"), "before")
    later = best_point(rows.withColumn("at", F.col("at") + 1), daily, ["person_id"], "at", "day", F.struct(F.col("day").alias("order"), "day", "value"), "after")
    both = join_growing(earlier.select("person_id", F.col("best").alias("earlier")), later.select("person_id", F.col("best").alias("later")), "person_id")
    linked = join_growing(rows, both, "person_id")

    def candidate(side: str) -> Column:
        diff = F.col(f"{side}.day") - F.col("at")
        usable = F.col(side).isNotNull() & (F.lit(True) if latest_day is None else diff <= latest_day)
        return F.when(usable, F.struct(F.abs(diff).alias("apart"), F.col(f"{side}.day").alias("day"), F.col(f"{side}.value").alias("value"), diff.alias("diff")))

    return linked.withColumn("b", F.least(candidate("earlier"), candidate("later"))).filter("b IS NOT NULL").select(
        "person_id", F.date_from_unix_date("b.day").alias(f"{prefix}_date"), F.col("b.value").alias(f"{prefix}_value"),
        F.col("b.diff").alias(f"{prefix}_days_from_start"),
    )


def closest_measurement(cohort: DataFrame, events: DataFrame, prefix: str, **limits) -> DataFrame:
    """The cohort with its nearest measurements beside it."""
    return join_growing(cohort, nearest_measurement(cohort, events, prefix, **limits), "person_id", "left")


def weight_timing(df: DataFrame, date: str) -> DataFrame:
    """When the weight was taken."""
    start, taken = F.col("inferred_episode_start"), F.col(date)
    label = F.when(taken <= start, "pre-pregnancy").when(taken <= F.date_add(start, 91), "first_trimester")
    return df.withColumn("weight_timing", label)


def body_mass_index(weight_kg: Column, height_cm: Column) -> Column:
    return weight_kg / F.pow(height_cm / 100, 2)


def max_measurement_after(cohort: DataFrame, events: DataFrame, prefix: str, from_day: int = 42) -> DataFrame:
    """The highest value at least `from_day` days after the start (earliest date on ties)."""
    daily = events.groupBy("person_id", day_of(F.col("concept_date")).alias("day")).agg(F.max("value_as_number").alias("value")).filter("value IS NOT NULL")
    rows = cohort.select("person_id", (day_of(F.col("inferred_episode_start")) + from_day).alias("at"))
    found = best_point(rows, daily, ["person_id"], "at", "day", F.struct((-F.col("value")).alias("order"), "day", "value"), "after")
    return found.filter("best IS NOT NULL").select(
        "person_id", F.date_from_unix_date("best.day").alias(f"{prefix}_date"), F.col("best.value").alias(f"{prefix}_value"),
        (F.col("best.day") - F.col("at") + from_day).alias(f"{prefix}_days_from_start"),
    )


def obese_by_bmi(bmi: Column, race: Column) -> Column:
    """Body mass index of 30 and more, 27.5 for Asian persons."""
    asian = race == "Asian"
    return (
        F.when(bmi.isNull(), F.lit(None)).when(asian & (bmi >= 27.5), 1).when(~asian & (bmi >= 30), 1).otherwise(0)
    )


def obesity_flags(df: DataFrame) -> DataFrame:
    """Obesity before and after, by index and combined with codes.

    Needs bmi_prepreg, bmi_postpartum_max, prepreg_obesity, postpartum_obesity, race_eth_5cat.
    """
    race = F.col("race_eth_5cat")
    df = df.withColumns(
        {
            "prepreg_obesity_bmi_based": obese_by_bmi(F.col("bmi_prepreg"), race),
            "postpartum_obesity_bmi_based": obese_by_bmi(F.col("bmi_postpartum_max"), race),
        }
    )
    before = (F.col("prepreg_obesity") == 1) | (F.col("prepreg_obesity_bmi_based") == 1)
    coded, measured = F.col("postpartum_obesity"), F.col("postpartum_obesity_bmi_based")
    after = F.when((coded == 1) | (measured == 1), 1).when((coded == 0) & F.coalesce(measured == 0, F.lit(True)), 0)
    return df.withColumns(
        {
            "prepreg_obesity_bmi_codes": F.when(before, 1).when(~before, 0),
            "postpartum_obesity_bmi_codes": after,
        }
    )


def incident(before: Column, after: Column) -> Column:
    """Null if present before, else whether it appeared."""
    return F.when(before == 1, F.lit(None)).when((before == 0) & (after == 1), 1).when((before == 0) & (after == 0), 0)


def without_prevalent(indicator: Column, prevalent: Column) -> Column:
    """An indicator that is unknown where the prior condition explains it."""
    return F.when((prevalent == 1) & (indicator == 1), F.lit(None)).when(indicator == 1, 1).when(indicator == 0, 0)


def weeks_dot_days(weeks: Column) -> Column:
    whole = F.floor(weeks)
    return whole + (weeks - whole) * 7


def risk_strata(df: DataFrame, prior: Sequence[str], adverse: Sequence[str], exposure: str) -> DataFrame:
    """Any prior risk, joint strata with the exposure, any adverse outcome, stillbirth."""
    any_prior, exposed = F.col("any_prior_risk"), F.col(exposure)
    joint = F.when(any_prior.isin(0, 1) & exposed.isin(0, 1), any_prior * 2 + exposed)
    any_adverse, no_adverse = F.col(adverse[0]) == 1, F.col(adverse[0]) == 0
    for a in adverse[1:]:
        any_adverse, no_adverse = any_adverse | (F.col(a) == 1), no_adverse & (F.col(a) == 0)
    return df.withColumn("any_prior_risk", _any(list(prior))).withColumns(
        {
            "joint_strata": joint,
            "apo_status_cat": F.when(any_adverse, "Any APO").when(no_adverse, "No APO"),
            "stillbirth": (F.col("outcome_category") == "SB").cast("int"),
            "gestational_age_weeks_days": weeks_dot_days(F.col("gestational_age_days") / F.lit(7.0)),
        }
    )


def engaged_subset(df: DataFrame, before: str, after: str) -> DataFrame:
    """Persons with a visit in the year before and in the year after."""
    return df.filter((F.col(before) == 1) & (F.col(after) == 1))


def remove_prevalent(df: DataFrame, prevalent: str) -> DataFrame:
    """Persons without the condition before."""
    return df.filter(F.col(prevalent) != 1)


def split_by_enrollment(df: DataFrame, event_date: str = "any_date_earliest") -> DataFrame:
    """Was the event, or the end of observation, before the survey?  Adds enrollment_split."""
    survey, event = F.col("min_svy_date"), F.col(event_date)
    before = F.coalesce(event < survey, F.lit(False)) | (
        event.isNull() & (F.col("observation_period_end_date") <= survey)
    )
    after = (event >= survey)
    return df.withColumn("enrollment_split", F.when(before, "pre").when(after, "post"))


def follow_up_stats(df: DataFrame, days: str) -> DataFrame:
    """Shortest, median, mean and longest follow-up."""
    d = F.col(days)
    return df.agg(
        F.count(d).alias("n"), F.min(d).alias("min_days"), F.percentile(d, 0.5).alias("median_days"),
        F.avg(d).alias("mean_days"), F.max(d).alias("max_days"),
    )
