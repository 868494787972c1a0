"""Queries for cohort building on episodes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_episodes import oracle
from care_episodes import testmap as tm
from care_episodes.functions import study_values as sv
from care_episodes.functions.primitives import join_growing
from care_episodes.operators import study
from care_episodes.queries.base import r6, register, stages
from care_episodes.session import materialize, small_table

V = oracle.VIEWS
QUESTIONS = list(tm.QUESTIONS.values())
FIRST_START = dt.date(1998, 1, 31)
KEY = ("person_id", "episode_id")
OUTPATIENT = (9201, 9202)

# ---- SQL views ------------------------------------------------------------------------------
_ANSWER = " ".join(
    f"WHEN o_orderkey % 4 = {q} AND (o_orderkey // 4) % 4 = {i} THEN '{a}'"
    for q, answers in tm.ANSWERS.items() for i, a in enumerate(answers)
)
V["survey_rows"] = f"""
SELECT o_custkey person_id, {oracle._case('(o_orderkey % 4)', tm.QUESTIONS)} question,
  CASE {_ANSWER} END answer, o_orderdate::DATE survey_date, o_orderkey response_id FROM orders"""
V["survey_person"] = f"""
SELECT *, least({', '.join(q + '_date' for q in QUESTIONS)}) min_svy_date FROM (SELECT person_id, {', '.join(
    f"arg_min(clean, (survey_date, response_id)) FILTER (question = '{q}') {q}, min(survey_date) FILTER (question = '{q}') {q}_date"
    for q in QUESTIONS)}
FROM (SELECT *, CASE WHEN answer IN ('PreferNotToAnswer', 'DontKnow') THEN 'Skip' ELSE answer END AS clean FROM survey_rows) GROUP BY 1)"""
V["surveyed"] = """
SELECT *, least(abs(time_from_end), abs(time_to_start)) min_time, coalesce(min_svy_date BETWEEN inferred_episode_start AND inferred_episode_end, false) holds FROM (
  SELECT e.*, s.* EXCLUDE (person_id), s.min_svy_date - inferred_episode_end time_from_end, inferred_episode_start - s.min_svy_date time_to_start
  FROM study_eps e JOIN survey_person s USING (person_id))"""
V["closest1"] = """
SELECT *, min_time = min(min_time) OVER w AS nearest, CASE WHEN holds OR (min_time = min(min_time) OVER w AND NOT bool_or(holds) OVER w) THEN 1 ELSE 0 END c1
FROM surveyed WINDOW w AS (PARTITION BY person_id)"""
V["closest2"] = """
SELECT *, CASE WHEN sum(c1) OVER w > 1 AND c1 = 1 AND len <> max(len) OVER w THEN 0 ELSE c1 END c2
FROM (SELECT *, CASE WHEN c1 = 1 THEN gestational_age_days ELSE 10000000 END len FROM closest1) WINDOW w AS (PARTITION BY person_id)"""
V["closest3"] = "SELECT *, CASE WHEN sum(c2) OVER (PARTITION BY person_id) > 1 AND c2 = 1 THEN 0 ELSE c2 END c3 FROM closest2"
V["closest"] = """
SELECT *, CASE WHEN sum(c3) OVER (PARTITION BY person_id) = 0 AND nearest THEN 1 ELSE c3 END::INT closest_pregnancy FROM closest3"""
V["tagged"] = """
SELECT *, CASE WHEN inferred_episode_end - 30 < pregnancy_date AND (pregnancy IN ('No', 'Skip') OR pregnancy IS NULL) THEN 'After'
  WHEN inferred_episode_start > pregnancy_date AND (pregnancy IN ('No', 'Skip') OR pregnancy IS NULL) THEN 'Before'
  WHEN pregnancy = 'Yes' AND min_svy_date BETWEEN inferred_episode_start AND inferred_episode_end THEN 'During'
  WHEN pregnancy = 'Yes' AND closest_pregnancy = 1 THEN 'During'
  WHEN pregnancy IN ('No', 'Skip') AND min_svy_date BETWEEN inferred_episode_start AND inferred_episode_start + 84 THEN 'During'
  WHEN min_svy_date BETWEEN inferred_episode_start AND inferred_episode_end AND (pregnancy IS NULL OR pregnancy = 'Skip') THEN 'During'
  WHEN inferred_episode_end < min_svy_date THEN 'After' WHEN inferred_episode_start > min_svy_date THEN 'Before' ELSE 'Unclear' END took_the_survey
FROM closest"""
V["outcome_eps"] = """
SELECT e.* EXCLUDE (final_outcome_category), final_outcome_category outcome_category, (episode_id % 3 <> 0)::INT "HIP_flag", (episode_id % 4 <> 1)::INT "PPS_flag" FROM study_eps e"""
V["buffered"] = """
SELECT c.*, observation_period_start_date, observation_period_end_date, inferred_episode_end + 42 end_plus_6wks,
  (inferred_episode_start - INTERVAL 1 YEAR)::DATE year_before_preg, (inferred_episode_end + INTERVAL 1 YEAR)::DATE year_after_preg
FROM outcome_eps c JOIN observation_period USING (person_id)"""
V["phenotype"] = """
SELECT person_id, condition_concept_id concept_id, condition_start_date concept_date FROM condition_occurrence"""
V["first_eps"] = f"""
SELECT * FROM buffered WHERE outcome_category IN ('LB', 'DELIV', 'SB') AND gestational_age_days / 7 BETWEEN 20 AND 45
  AND inferred_episode_start >= DATE '{FIRST_START}' QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY inferred_episode_start, episode_id) = 1"""


def _found(concept: int, low: str, high: str) -> str:
    return f"p.person_id = f.person_id AND p.concept_id = {concept} AND p.concept_date BETWEEN f.{low} AND f.{high}"


def _flag(concept: int, low: str, high: str) -> str:
    return f"(EXISTS (SELECT 1 FROM phenotype p WHERE {_found(concept, low, high)}))::INT"


def _earliest(concept: int, low: str, high: str) -> str:
    return f"(SELECT min(p.concept_date) FROM phenotype p WHERE {_found(concept, low, high)})"


def _visit(low: str, high: str) -> str:
    return (
        "(EXISTS (SELECT 1 FROM visit_occurrence v WHERE v.person_id = f.person_id AND v.visit_concept_id IN (9201, 9202) "
        f"AND v.visit_start_date BETWEEN f.{low} AND f.{high}))::INT"
    )


_START, _END, _OBS0, _OBS1 = "inferred_episode_start", "inferred_episode_end", "observation_period_start_date", "observation_period_end_date"
V["weights"] = """
SELECT person_id, measurement_date concept_date, value_as_number AS kg FROM measurement WHERE measurement_concept_id = 3025315"""
V["heights"] = """
SELECT person_id, measurement_date concept_date, value_as_number AS cm FROM measurement WHERE measurement_concept_id = 3036277"""
V["near_weight"] = """
SELECT f.person_id, w.concept_date weight_date, w.kg weight_value, (w.concept_date - inferred_episode_start)::INT weight_days_from_start
FROM first_eps f JOIN weights w ON w.person_id = f.person_id AND w.concept_date - inferred_episode_start <= 91
QUALIFY row_number() OVER (PARTITION BY f.person_id ORDER BY abs(w.concept_date - inferred_episode_start), w.concept_date, w.kg) = 1"""
V["near_height"] = """
SELECT f.person_id, w.concept_date height_date, w.cm height_value, (w.concept_date - inferred_episode_start)::INT height_days_from_start
FROM first_eps f JOIN heights w ON w.person_id = f.person_id AND w.cm BETWEEN 90 AND 210
QUALIFY row_number() OVER (PARTITION BY f.person_id ORDER BY abs(w.concept_date - inferred_episode_start), w.concept_date, w.cm) = 1"""
V["top_weight"] = """
SELECT f.person_id, w.concept_date top_date, w.kg top_value, (w.concept_date - inferred_episode_start)::INT top_days_from_start
FROM first_eps f JOIN weights w ON w.person_id = f.person_id AND w.concept_date - inferred_episode_start >= 42
QUALIFY row_number() OVER (PARTITION BY f.person_id ORDER BY w.kg DESC, w.concept_date) = 1"""
V["analysis_base"] = f"""
SELECT f.*, s.min_svy_date,
  CASE WHEN s.race_eth LIKE '%Hispanic%' THEN 'Hispanic or Latino' WHEN s.race_eth LIKE '%,%' THEN 'Other'
    WHEN s.race_eth = 'Black' THEN 'Black or African American' WHEN s.race_eth = 'White' THEN 'White' END race_eth_5cat,
  (inferred_episode_end - make_date(year_of_birth, coalesce(month_of_birth, 1), coalesce(day_of_birth, 1))) / 365.25 mom_age,
  {_flag(1016, _START, 'end_plus_6wks')} hdp_indicator,
  {_earliest(1017, _END, _OBS1)} mi_date_earliest, {_earliest(1018, _END, _OBS1)} stroke_date_earliest, {_earliest(1019, _END, _OBS1)} hf_date_earliest,
  {_flag(1014, _OBS0, _START)} htn_before, {_flag(1014, _END, _OBS1)} htn_after,
  {_flag(1013, _OBS0, _START)} dm_before, {_flag(1013, _END, _OBS1)} dm_after,
  {_visit('year_before_preg', _START)} outpt_before, {_visit(_END, 'year_after_preg')} outpt_after,
  weight_value, height_value, top_value,
  weight_value / pow(height_value / 100, 2) bmi_prepreg, top_value / pow(height_value / 100, 2) bmi_postpartum_max
FROM first_eps f JOIN person USING (person_id) LEFT JOIN survey_person s USING (person_id)
LEFT JOIN near_weight USING (person_id) LEFT JOIN near_height USING (person_id) LEFT JOIN top_weight USING (person_id)"""
V["analysis"] = """
SELECT *, (mi_date_earliest IS NOT NULL)::INT mi_indicator, (stroke_date_earliest IS NOT NULL)::INT stroke_indicator, (hf_date_earliest IS NOT NULL)::INT hf_indicator,
  (coalesce(mi_date_earliest, stroke_date_earliest, hf_date_earliest) IS NOT NULL)::INT any_outcome, greatest(hdp_indicator, preterm)::INT any_adverse,
  least(mi_date_earliest, stroke_date_earliest, hf_date_earliest) any_date_earliest FROM analysis_base"""


def _times(outcome: str) -> str:
    event = f"({outcome}_date_earliest - inferred_episode_end)"
    days = f"coalesce({event}, observation_period_end_date - inferred_episode_end)::INT"
    return (
        f"{event}::INT time_to_{outcome}_event, {days} time_to_{outcome}_days, "
        f"({outcome}_date_earliest IS NOT NULL)::INT {outcome}_event"
    )


def _censored(outcome: str, days: int, suffix: str) -> str:
    return (
        f"least(time_to_{outcome}_days, {days}) time_to_{outcome}_days_{suffix}, "
        f"coalesce(time_to_{outcome}_event <= {days}, false)::INT {outcome}_event_{suffix}"
    )


OUTCOMES = ("mi", "stroke", "hf", "any")
V["timed_analysis"] = f"SELECT *, {', '.join(_times(o) for o in OUTCOMES)} FROM analysis"
V["censored_analysis"] = f"SELECT *, {', '.join(_censored(o, 1461, '4y') for o in OUTCOMES)} FROM timed_analysis"


# ---- Spark helpers --------------------------------------------------------------------------
def outcome_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        tm.study_episodes(spark, sf_dir)
        .withColumnRenamed("final_outcome_category", "outcome_category")
        .withColumn("HIP_flag", (F.col("episode_id") % 3 != 0).cast("int"))
        .withColumn("PPS_flag", (F.col("episode_id") % 4 != 1).cast("int"))
    )


def buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    observed = study.join_observation_period(outcome_episodes(spark, sf_dir), tm.observation_period(spark, sf_dir))
    return study.episode_buffers(observed)


def events(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    tables = {"condition_occurrence": tm.condition_occurrence(spark, sf_dir)}
    return study.set_events(tables, tm.concept_set(spark, name))


def measurements(spark: SparkSession, sf_dir: str, concept: int) -> DataFrame:
    wanted = small_table(spark, [(concept,)], "concept_id long")
    return study.set_events({"measurement": tm.measurement(spark, sf_dir)}, wanted, ["measurement"])


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    wanted = small_table(spark, [(c,) for c in OUTPATIENT], "concept_id long")
    return study.set_events({"visit_occurrence": tm.visit_occurrence(spark, sf_dir)}, wanted, ["visit"])


def survey_person(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.survey_wide(tm.survey(spark, sf_dir), QUESTIONS)


def study_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First eligible episode of each person."""
    return study.first_episode(study.apply_exclusions(buffered(spark, sf_dir), FIRST_START))


def build_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis row of the study: first episode of each person with exposures, outcomes, risks."""
    df = study_cohort(spark, sf_dir)
    survey = study.recode_demographics(survey_person(spark, sf_dir)).select("person_id", "min_svy_date", "race_eth_5cat")
    person = tm.person(spark, sf_dir)
    birth = F.make_date("year_of_birth", F.coalesce("month_of_birth", F.lit(1)), F.coalesce("day_of_birth", F.lit(1)))
    df = join_growing(join_growing(df, person.select("person_id", birth.alias("dob")), "person_id"), survey, "person_id", "left")
    df = df.withColumn("mom_age", F.datediff("inferred_episode_end", "dob") / F.lit(365.25))
    df = materialize(df)

    obs0, obs1 = "observation_period_start_date", "observation_period_end_date"
    start, end = "inferred_episode_start", "inferred_episode_end"
    sets = [(n, c) for n in ("hdp", "mi", "stroke", "hf", "htn", "dm") for c in tm.PHENOTYPES[n]] + [("outpt", c) for c in OUTPATIENT]
    concepts = small_table(spark, sets, "set_name string, concept_id long")
    tables = {"condition_occurrence": tm.condition_occurrence(spark, sf_dir), "visit_occurrence": tm.visit_occurrence(spark, sf_dir)}
    domains = {n: ("visit",) if n == "outpt" else ("condition",) for n, _ in sets}
    windows = {
        "mi": ("mi", end, obs1), "stroke": ("stroke", end, obs1), "hf": ("hf", end, obs1),
        "hdp": ("hdp", start, "end_plus_6wks"),
        "htn_before": ("htn", obs0, start), "htn_after": ("htn", end, obs1),
        "dm_before": ("dm", obs0, start), "dm_after": ("dm", end, obs1),
        "outpt_before": ("outpt", "year_before_preg", start), "outpt_after": ("outpt", end, "year_after_preg"),
    }
    flags = [n for n in windows if n not in ("mi", "stroke", "hf")]
    out = study.window_summaries(df, study.many_set_events(tables, concepts, domains), windows, KEY)
    out = out.drop(*[f"{n}_{c}" for n in windows for c in ("date_latest", "concept_count")], *[f"{n}_date_earliest" for n in flags])
    out = out.withColumnsRenamed({f"{n}_indicator": n for n in flags if n != "hdp"})
    values = small_table(spark, [(3025315,), (3036277,)], "concept_id long")
    # Both measurements are read once; three look-ups follow.
    measured = materialize(study.set_events({"measurement": tm.measurement(spark, sf_dir)}, values, ["measurement"]))
    weights, heights = measured.where("concept_id = 3025315"), measured.where("concept_id = 3036277")
    values = [
        study.nearest_measurement(df, weights, "weight", latest_day=91),
        study.nearest_measurement(df, heights, "height", low=90, high=210),
        study.max_measurement_after(df, weights, "top"),
    ]
    out = study.assemble_analysis(out, values, ["person_id"])
    out = out.withColumns(
        {
            "bmi_prepreg": study.body_mass_index(F.col("weight_value"), F.col("height_value")),
            "bmi_postpartum_max": study.body_mass_index(F.col("top_value"), F.col("height_value")),
        }
    )
    out = study.composites(out, ("mi", "stroke", "hf"), ("hdp_indicator", "preterm"))
    out = study.time_to_event(out, OUTCOMES)
    return study.censor_at(out, OUTCOMES, 1461, "4y")


def analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analysis rows, stored once per session and folder."""
    return stages(spark, sf_dir).once("analysis", lambda: build_analysis(spark, sf_dir))


# ---- queries --------------------------------------------------------------------------------
_WIDE = ", ".join(f"{q}, {q}_date" for q in QUESTIONS)


@register("k1_survey_wide", f"SELECT person_id, {_WIDE}, min_svy_date FROM survey_person")
def k1_survey_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survey_person(spark, sf_dir)


def _closest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.closest_episode_to_survey(join_growing(tm.study_episodes(spark, sf_dir), survey_person(spark, sf_dir), "person_id"))


@register(
    "k2_closest_episode_to_survey",
    "SELECT episode_id, time_from_end::INT time_from_end, time_to_start::INT time_to_start, min_time::INT min_time, closest_pregnancy FROM closest",
)
def k2_closest_episode_to_survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _closest(spark, sf_dir).select("episode_id", "time_from_end", "time_to_start", "min_time", "closest_pregnancy")


@register("k3_survey_timing", "SELECT episode_id, took_the_survey FROM tagged")
def k3_survey_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.survey_timing(_closest(spark, sf_dir)).select("episode_id", "took_the_survey")


GENDERS = ("Woman", "Man", "NonBinary", "Woman, Man", "Skip")
ORIENTATIONS = ("Straight", "Gay", "Lesbian", "Bisexual, Gay", "Gay, Straight", "PMI: Skip")
MARITAL = ("Married", "LivingWithPartner", "Divorced", "NeverMarried", "Widowed", "PreferNotToAnswer", "Separated")
STATE_CODES = ("NY", "CA", "TX", "DC", "PR", "FM", "XX")
ADVICE = ("Yes", "No", "Skip", "DontKnow")
OUTCOME_CODES = ("LB", "SB", "ECT", "AB", "SA", "DELIV", "PREG")


def _pick(key: str, values: tuple[str, ...]) -> str:
    return oracle._case(f"({key} % {len(values)})", dict(enumerate(values)))


def _mapped(expression: str, table: dict[str, str]) -> str:
    value = f"coalesce({oracle._case(expression, table)}, {expression})"
    return f"CASE WHEN {value} NOT IN ({oracle._strings(sv.NO_ANSWER)}) THEN {value} END"


_RACE = "(CASE WHEN race_eth LIKE '%Hispanic%' THEN 'Hispanic' WHEN race_eth LIKE '%,%' THEN 'Multiple' ELSE race_eth END)"
_GENDER = "(CASE WHEN g IN ('NonBinary', 'Transgender', 'AdditionalOptions') OR g LIKE '%,%' THEN 'Other/multiple' ELSE g END)"
_ORIENTATION = "(CASE WHEN o LIKE '%Bisexual%' THEN 'Bisexual' WHEN o LIKE '%Gay%' OR o LIKE '%Lesbian%' THEN 'Gay/lesbian' ELSE o END)"


@register(
    "k4_recode_demographics",
    f"""SELECT person_id, {_mapped(_RACE, sv.RACE)} race_eth_cat, {oracle._case('(' + _mapped(_RACE, sv.RACE) + ')', sv.RACE_FIVE)} race_eth_5cat,
  {_mapped('income', sv.INCOME)} income_cat, {_mapped('education', sv.EDUCATION)} edu_cat, {_mapped(_GENDER, {'-': '-'})} gender_cat,
  {_mapped(_ORIENTATION, {'-': '-'})} orientation_cat, {_mapped('m', sv.MARITAL_STATUS)} marital_status_cat, {oracle._case('st', sv.STATES)} state_cat,
  {oracle._case('oc', sv.OUTCOME_LABELS)} outcome_label, {', '.join(f"{_mapped('adv', {'-': '-'})} {c}" for c in sv.PLAIN_ANSWERS.values())}
FROM (SELECT *, {_pick('person_id', ADVICE)} AS adv, {_pick('person_id', OUTCOME_CODES)} AS oc, {_pick('person_id', GENDERS)} AS g, {_pick('person_id', ORIENTATIONS)} AS o, {_pick('person_id', MARITAL)} AS m,
  {_pick('person_id', STATE_CODES)} AS st FROM survey_person)""",
)
def k4_recode_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    def pick(values: tuple[str, ...]):
        return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col("person_id") % len(values) + 1).cast("int"))

    wide = survey_person(spark, sf_dir).withColumns(
        {
            "gender": pick(GENDERS), "sexual_orientation": pick(ORIENTATIONS), "marital_status": pick(MARITAL),
            "state_of_residence": pick(STATE_CODES), "final_outcome_category": pick(OUTCOME_CODES),
            **{c: pick(ADVICE) for c in sv.PLAIN_ANSWERS},
        }
    )
    return study.recode_demographics(wide).select(
        "person_id", "race_eth_cat", "race_eth_5cat", "income_cat", "edu_cat", "gender_cat", "orientation_cat",
        "marital_status_cat", "state_cat", "outcome_label", *sv.PLAIN_ANSWERS.values(),
    )


@register(
    "k5_bands",
    """SELECT episode_id, year_start, year_end, round(gestational_age_weeks, 6) gestational_age_weeks, round(mom_age, 6) mom_age,
  CASE WHEN year_start <= 2015 THEN '2015 and earlier' WHEN year_start <= 2022 THEN year_start::VARCHAR END year_start_cat,
  CASE WHEN year_end <= 2015 THEN '2015 and earlier' WHEN year_end <= 2022 THEN year_end::VARCHAR END year_end_cat,
  CASE WHEN precision_category IN ('week', 'two-week', 'three-week') THEN 'Week-level' WHEN precision_category IN ('month', 'two-month', 'three-month') THEN 'Month-level'
    WHEN precision_category = 'week_poor-support' THEN 'Week-level (1 concept)' WHEN precision_category = 'non-specific' THEN 'Non-specific' END resolution,
  mom_age_cat, CASE WHEN mom_age_cat IN ('45-49 years', '50 years and over') THEN '45 years and over' ELSE mom_age_cat END mom_age_cat_table
FROM (SELECT *, CASE WHEN mom_age < 0 THEN NULL WHEN mom_age < 15 THEN '0-14 years'
    WHEN mom_age < 50 THEN ((floor(mom_age / 5) * 5)::INT)::VARCHAR || '-' || ((floor(mom_age / 5) * 5)::INT + 4)::VARCHAR || ' years'
    WHEN mom_age <= 55 THEN '50 years and over' END mom_age_cat FROM (
  SELECT e.*, year(inferred_episode_start)::INT year_start, year(inferred_episode_end)::INT year_end, gestational_age_days / 7.0 gestational_age_weeks,
    (inferred_episode_end - make_date(year_of_birth, coalesce(month_of_birth, 1), coalesce(day_of_birth, 1))) / 365.25 mom_age
  FROM study_eps e JOIN person USING (person_id)))""",
)
def k5_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    person = tm.person(spark, sf_dir)
    birth = F.make_date("year_of_birth", F.coalesce("month_of_birth", F.lit(1)), F.coalesce("day_of_birth", F.lit(1)))
    df = join_growing(tm.study_episodes(spark, sf_dir), person.select("person_id", birth.alias("dob")), "person_id")
    return study.bands(df).select(
        "episode_id", "year_start", "year_end", r6("gestational_age_weeks"), r6("mom_age"), "year_start_cat", "year_end_cat",
        "resolution", "mom_age_cat", "mom_age_cat_table",
    )


@register(
    "k6_lump_rare",
    """SELECT c_custkey, new_level AS level, dense_rank() OVER (ORDER BY total DESC, new_level)::INT level_rank FROM (
  SELECT *, count(*) OVER (PARTITION BY new_level) total FROM (
    SELECT c_custkey, CASE WHEN count(*) OVER (PARTITION BY named) < 20 THEN 'Other' ELSE named END new_level
    FROM (SELECT c_custkey, CASE WHEN c_custkey % 100 = 0 THEN 'key ' || c_custkey % 10000 ELSE c_nationkey || ' ' || c_mktsegment END named FROM customer)))""",
)
def k6_lump_rare(spark: SparkSession, sf_dir: str) -> DataFrame:
    (customer,) = tm.read(spark, sf_dir, "customer")
    rare = F.concat(F.lit("key "), (F.col("c_custkey") % 10000).cast("string"))
    level = F.when(F.col("c_custkey") % 100 == 0, rare).otherwise(F.concat_ws(" ", "c_nationkey", "c_mktsegment"))
    return study.lump_rare(customer.select("c_custkey", level.alias("level")), "level")


@register(
    "k7_suppress_small_cells",
    """SELECT person_id % 200 AS grp, CASE WHEN a > 0 AND a < 20 THEN '<20' ELSE a::VARCHAR END lb, CASE WHEN b > 0 AND b < 20 THEN '<20' ELSE b::VARCHAR END sb
FROM (SELECT person_id % 200 person_id, count(*) FILTER (outcome_category = 'LB') a, count(*) FILTER (outcome_category = 'SB') b FROM outcome_eps GROUP BY 1)""",
)
def k7_suppress_small_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = outcome_episodes(spark, sf_dir).withColumn("grp", F.col("person_id") % 200)
    table = study.cross_tab(df, "grp", "outcome_category", ["LB", "SB"])
    named = table.select("grp", F.col("outcome_category_LB").alias("lb"), F.col("outcome_category_SB").alias("sb"))
    return study.suppress_small_cells(named, ["lb", "sb"])


@register(
    "k8_cross_tab",
    f"""SELECT outcome_category, {', '.join(f"count(*) FILTER (precision_category = '{p}') " + '"precision_category_' + p + '"' for p in tm.PRECISION_OF_ORDER)}
FROM outcome_eps GROUP BY 1""",
)
def k8_cross_tab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.cross_tab(outcome_episodes(spark, sf_dir), "outcome_category", "precision_category", tm.PRECISION_OF_ORDER)


@register(
    "k8_proportions",
    """SELECT outcome_category, outcome_concordance_score, count(*) n, round(count(*) / sum(count(*)) OVER (PARTITION BY outcome_category), 6) prop
FROM outcome_eps GROUP BY 1, 2""",
)
def k8_proportions(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = study.proportions(
        outcome_episodes(spark, sf_dir), ["outcome_category", "outcome_concordance_score"], ["outcome_category"]
    )
    return out.withColumn("prop", F.round("prop", 6))


@register(
    "k8_concordance_table",
    """SELECT resolution, outcome_category, max(n) FILTER (conc = 'All') "n_All", round(max(p) FILTER (conc = 'All'), 6) "prop_All",
  max(n) FILTER (conc = 'rich') n_rich, round(max(p) FILTER (conc = 'rich'), 6) prop_rich FROM (
  SELECT conc, resolution, outcome_category, score, 1 - n / sum(n) OVER w p, (sum(n) OVER w)::BIGINT n FROM (
    SELECT conc, CASE WHEN precision_category IN ('week', 'two-week', 'three-week') THEN 'Week-level' WHEN precision_category IN ('month', 'two-month', 'three-month') THEN 'Month-level'
        WHEN precision_category = 'non-specific' THEN 'Non-specific' ELSE 'Week (poor support)' END resolution, outcome_category,
      CASE WHEN outcome_concordance_score IN (0, 1) THEN 1 ELSE outcome_concordance_score END score, count(*) n
    FROM (SELECT 'All' AS conc, * FROM outcome_eps UNION ALL SELECT 'rich', * FROM outcome_eps WHERE inferred_episode_start < inferred_episode_end
      AND "HIP_flag" = 1 AND "PPS_flag" = 1 AND inferred_episode_start > DATE '1997-01-01') GROUP BY ALL)
  WINDOW w AS (PARTITION BY conc, resolution, outcome_category)) WHERE score = 1 GROUP BY 1, 2""",
)
def k8_concordance_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = study.concordance_table(outcome_episodes(spark, sf_dir), dt.date(1997, 1, 1))
    return out.select("resolution", "outcome_category", "n_All", r6("prop_All"), "n_rich", r6("prop_rich"))


_GA = ["pct_less_20wks", "mean", "median", "min", "max", "q5", "q95"]


@register(
    "k9_ga_distribution",
    """SELECT outcome_category, count(*) n, round(count(*) FILTER (d < 140) / count(*) * 100, 6) pct_less_20wks, round(avg(d) / 7, 6) AS "mean",
  round(median(d) / 7, 6) AS "median", round(min(d) / 7, 6) AS "min", round(max(d) / 7, 6) AS "max", round(quantile_cont(d, 0.05) / 7, 6) q5,
  round(quantile_cont(d, 0.95) / 7, 6) q95 FROM (SELECT *, gestational_age_days::DOUBLE d FROM outcome_eps) GROUP BY 1""",
)
def k9_ga_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.ga_distribution(outcome_episodes(spark, sf_dir)).select("outcome_category", "n", *[r6(c) for c in _GA])


_FIRST = f"DATE '{FIRST_START}'"


@register(
    "k10_apply_exclusions",
    f"""SELECT episode_id, outcome_category, gestational_age_days, inferred_episode_start FROM outcome_eps
WHERE outcome_category IN ('LB', 'DELIV', 'SB') AND gestational_age_days / 7 >= 20 AND gestational_age_days / 7 <= 45 AND inferred_episode_start >= {_FIRST}""",
)
def k10_apply_exclusions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.apply_exclusions(outcome_episodes(spark, sf_dir), FIRST_START).select(
        "episode_id", "outcome_category", "gestational_age_days", "inferred_episode_start"
    )


@register(
    "k10_attrition",
    f"""SELECT count(*) all_episodes, count(*) FILTER (a) delivery_outcome, count(*) FILTER (a AND b) plausible_length,
  count(*) FILTER (a AND b AND c) start_in_period, count(DISTINCT CASE WHEN a AND b AND c THEN person_id END) persons_left
FROM (SELECT *, outcome_category IN ('LB', 'DELIV', 'SB') a, gestational_age_days / 7 BETWEEN 20 AND 45 b, inferred_episode_start >= {_FIRST} c FROM outcome_eps)""",
)
def k10_attrition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.attrition(outcome_episodes(spark, sf_dir), FIRST_START)


CODES = tuple(f"C{i}" for i in range(0, 40, 3))


@register(
    "k11_map_icd_to_standard",
    f"""SELECT r.concept_id_1, r.concept_id_2, s.concept_code icd_code, s.concept_name icd_name, t.concept_code, t.concept_name, t.vocabulary_id, t.domain_id
FROM concept_relationship r JOIN concept s ON s.concept_id = r.concept_id_1 AND s.vocabulary_id IN ('ICD9CM', 'ICD10CM') AND s.concept_code IN ({oracle._strings(CODES)})
LEFT JOIN concept t ON t.concept_id = r.concept_id_2 WHERE relationship_id = 'Maps to'""",
)
def k11_map_icd_to_standard(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = small_table(spark, [(c,) for c in CODES], "concept_code string")
    return study.map_icd_to_standard(codes, tm.concept(spark, sf_dir), tm.concept_relationship(spark, sf_dir))


@register(
    "k12_descendants",
    """SELECT concept_id FROM (VALUES (1016::BIGINT), (1017), (5)) t(concept_id)
UNION SELECT descendant_concept_id FROM concept_ancestor WHERE ancestor_concept_id IN (1016, 1017, 5)""",
)
def k12_descendants(spark: SparkSession, sf_dir: str) -> DataFrame:
    roots = small_table(spark, [(1016,), (1017,), (5,)], "concept_id long")
    return study.descendants(roots, tm.concept_ancestor(spark, sf_dir))


_HDP_ROWS = """buffered b LEFT JOIN phenotype p ON p.person_id = b.person_id AND p.concept_id = 1016
  AND p.concept_date BETWEEN b.inferred_episode_start AND b.end_plus_6wks"""


@register(
    "k13_concept_set_events_all",
    f"SELECT b.person_id, b.episode_id, b.inferred_episode_start, b.inferred_episode_end, p.concept_id, p.concept_date FROM {_HDP_ROWS}",
)
def k13_concept_set_events_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = study.concept_set_events(
        buffered(spark, sf_dir), events(spark, sf_dir, "hdp"), "inferred_episode_start", "end_plus_6wks"
    )
    return found.select("person_id", "episode_id", "inferred_episode_start", "inferred_episode_end", "concept_id", "concept_date")


@register(
    "k13_concept_set_indicator",
    f"SELECT episode_id, {_flag(1017, _END, _OBS1)} mi FROM buffered f",
)
def k13_concept_set_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.concept_set_events(
        buffered(spark, sf_dir), events(spark, sf_dir, "mi"), "inferred_episode_end", "observation_period_end_date",
        "indicator", "mi",
    ).select("episode_id", "mi")


@register(
    "k13_visit_ever_before",
    """SELECT episode_id, (EXISTS (SELECT 1 FROM visit_occurrence v WHERE v.person_id = f.person_id AND v.visit_concept_id IN (9201, 9202)
  AND v.visit_start_date <= f.inferred_episode_start))::INT outpt_ever_before FROM buffered f""",
)
def k13_visit_ever_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.concept_set_events(
        buffered(spark, sf_dir), visits(spark, sf_dir), None, "inferred_episode_start", "indicator", "outpt_ever_before"
    ).select("episode_id", "outpt_ever_before")


@register(
    "k13_measurements_before",
    """SELECT f.episode_id, w.concept_date, w.kg value_as_number FROM buffered f JOIN weights w ON w.person_id = f.person_id AND w.concept_date <= f.inferred_episode_start""",
)
def k13_measurements_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Open start: all earlier weights of each episode's person."""
    weights = measurements(spark, sf_dir, 3025315)
    found = study.events_in_window(buffered(spark, sf_dir), weights, None, "inferred_episode_start", KEY)
    return found.select("episode_id", "concept_date", "value_as_number")


@register(
    "k14_collapse_indicator",
    f"""SELECT b.person_id, b.inferred_episode_end, min(p.concept_date) hdp_date_earliest, max(p.concept_date) hdp_date_latest,
  (count(p.concept_date) > 0)::INT hdp_indicator, nullif(count(p.concept_date), 0) hdp_concept_count FROM {_HDP_ROWS} GROUP BY 1, 2""",
)
def k14_collapse_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = study.concept_set_events(
        buffered(spark, sf_dir), events(spark, sf_dir, "hdp"), "inferred_episode_start", "end_plus_6wks"
    )
    return study.collapse_indicator(found, "hdp")


@register(
    "k14_set_summary",
    """SELECT f.person_id, f.inferred_episode_end, min(p.concept_date) hf_date_earliest, max(p.concept_date) hf_date_latest,
  (count(p.concept_date) > 0)::INT hf_indicator, nullif(count(p.concept_date), 0) hf_concept_count
FROM (SELECT DISTINCT person_id, inferred_episode_end, observation_period_end_date FROM buffered) f
LEFT JOIN phenotype p ON p.person_id = f.person_id AND p.concept_id = 1019
  AND p.concept_date BETWEEN f.inferred_episode_end AND f.observation_period_end_date GROUP BY 1, 2""",
)
def k14_set_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.set_summary(
        buffered(spark, sf_dir), events(spark, sf_dir, "hf"), "inferred_episode_end", "observation_period_end_date", "hf"
    )


@register(
    "k15_episode_buffers",
    """SELECT episode_id, inferred_episode_start - 42 start_minus_6wks, inferred_episode_end + 42 end_plus_6wks, inferred_episode_start - 84 start_minus_12wks,
  inferred_episode_end + 84 end_plus_12wks, (inferred_episode_start - INTERVAL 1 YEAR)::DATE year_before_preg,
  (inferred_episode_start - INTERVAL 2 YEAR)::DATE year_two_before_preg, (inferred_episode_end + INTERVAL 1 YEAR)::DATE year_after_preg,
  inferred_episode_start + 91 first_trimester FROM study_eps""",
)
def k15_episode_buffers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.episode_buffers(tm.study_episodes(spark, sf_dir)).select(
        "episode_id", "start_minus_6wks", "end_plus_6wks", "start_minus_12wks", "end_plus_12wks", "year_before_preg",
        "year_two_before_preg", "year_after_preg", "first_trimester",
    )


@register(
    "k16_join_observation_period",
    "SELECT episode_id, observation_period_start_date, observation_period_end_date FROM buffered",
)
def k16_join_observation_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = study.join_observation_period(tm.study_episodes(spark, sf_dir), tm.observation_period(spark, sf_dir))
    return joined.select("episode_id", "observation_period_start_date", "observation_period_end_date")


@register(
    "k17_observed_throughout",
    """SELECT episode_id FROM study_eps e WHERE EXISTS (SELECT 1 FROM observation_period o WHERE o.person_id = e.person_id
  AND inferred_episode_start >= observation_period_start_date AND inferred_episode_end <= observation_period_end_date)""",
)
def k17_observed_throughout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.observed_throughout(
        tm.study_episodes(spark, sf_dir), tm.observation_period(spark, sf_dir), "inferred_episode_start", "inferred_episode_end"
    ).select("episode_id")


_EVENT_DATES = "mi_date_earliest, stroke_date_earliest, hf_date_earliest"
_ASSEMBLED = f"""person_id, episode_id, hdp_indicator, mi_indicator, stroke_indicator, hf_indicator, {_EVENT_DATES}, htn_before, htn_after,
  dm_before, dm_after, outpt_before, outpt_after"""


def _names(columns: str) -> list[str]:
    return [c.strip() for c in columns.split(",")]


@register("k18_assemble_analysis", f"SELECT {_ASSEMBLED} FROM analysis")
def k18_assemble_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_analysis(spark, sf_dir).select(*_names(_ASSEMBLED))


@register("k19_composites", "SELECT person_id, any_outcome, any_adverse, any_date_earliest FROM analysis")
def k19_composites(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = analysis(spark, sf_dir).drop("any_outcome", "any_adverse", "any_date_earliest")
    return study.composites(base, ("mi", "stroke", "hf"), ("hdp_indicator", "preterm")).select(
        "person_id", "any_outcome", "any_adverse", "any_date_earliest"
    )


@register(
    "k20_time_to_event",
    f"""SELECT person_id, {', '.join(f'time_to_{o}_event, time_to_{o}_days, round(time_to_{o}_days / 365.25, 6) time_to_{o}_years, {o}_event' for o in OUTCOMES)}
FROM timed_analysis""",
)
def k20_time_to_event(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = study.time_to_event(analysis(spark, sf_dir), OUTCOMES)
    columns = []
    for o in OUTCOMES:
        columns += [f"time_to_{o}_event", f"time_to_{o}_days", r6(f"time_to_{o}_years"), f"{o}_event"]
    return df.select("person_id", *columns)


@register(
    "k21_censor_at",
    f"""SELECT person_id, {', '.join(f'time_to_{o}_days_4y, round(time_to_{o}_days_4y / 365.25, 6) time_to_{o}_years_4y, {o}_event_4y' for o in OUTCOMES)}
FROM censored_analysis""",
)
def k21_censor_at(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = study.censor_at(analysis(spark, sf_dir), OUTCOMES, 1461, "4y")
    columns = []
    for o in OUTCOMES:
        columns += [f"time_to_{o}_days_4y", r6(f"time_to_{o}_years_4y"), f"{o}_event_4y"]
    return df.select("person_id", *columns)


@register("k22_first_episode", "SELECT person_id, episode_id, inferred_episode_start, inferred_episode_end, outcome_category FROM first_eps")
def k22_first_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.first_episode(study.apply_exclusions(buffered(spark, sf_dir), FIRST_START)).select(
        "person_id", "episode_id", "inferred_episode_start", "inferred_episode_end", "outcome_category"
    )


@register(
    "k23_exposure_pattern",
    """SELECT person_id, string_agg(preterm::VARCHAR, ' → ' ORDER BY inferred_episode_end, episode_id) pattern, count(*) n_pregnancies FROM study_eps GROUP BY 1""",
)
def k23_exposure_pattern(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.exposure_pattern(tm.study_episodes(spark, sf_dir), "preterm")


@register(
    "k23_exposure_transitions",
    """SELECT preg_number, from_value, to_value, count(*) n FROM (SELECT row_number() OVER w::INT preg_number, preterm from_value, lead(preterm) OVER w to_value
  FROM study_eps WINDOW w AS (PARTITION BY person_id ORDER BY inferred_episode_end, episode_id)) WHERE to_value IS NOT NULL GROUP BY 1, 2, 3""",
)
def k23_exposure_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.exposure_transitions(tm.study_episodes(spark, sf_dir), "preterm")


@register(
    "k23_pregnancy_counts",
    "SELECT n_pregnancies, count(*) persons FROM (SELECT count(*) n_pregnancies FROM study_eps GROUP BY person_id) GROUP BY 1",
)
def k23_pregnancy_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = tm.study_episodes(spark, sf_dir).groupBy("person_id").agg(F.count(F.lit(1)).alias("n_pregnancies"))
    return counts.groupBy("n_pregnancies").agg(F.count(F.lit(1)).alias("persons"))


@register(
    "k24_concept_frequency",
    """SELECT p.concept_id, count(*) n, count(DISTINCT p.person_id) unique_persons FROM buffered b JOIN phenotype p ON p.person_id = b.person_id
  AND p.concept_id BETWEEN 1016 AND 1019 AND p.concept_date BETWEEN b.inferred_episode_end AND b.observation_period_end_date GROUP BY 1""",
)
def k24_concept_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = {"condition_occurrence": tm.condition_occurrence(spark, sf_dir)}
    found = study.set_events(tables, tm.concept_set(spark, "hdp", "mi", "stroke", "hf"))
    return study.concept_frequency(
        study.concept_set_events(buffered(spark, sf_dir), found, "inferred_episode_end", "observation_period_end_date")
    )


_NEAR = "person_id, {0}_date, {0}_value, {0}_days_from_start"


@register(
    "k25_closest_measurement",
    """SELECT f.person_id, weight_date, weight_value, weight_days_from_start, height_value, round(weight_value / pow(height_value / 100, 2), 6) bmi_prepreg,
  CASE WHEN weight_date <= inferred_episode_start THEN 'pre-pregnancy' WHEN weight_date <= inferred_episode_start + 91 THEN 'first_trimester' END weight_timing
FROM first_eps f LEFT JOIN near_weight USING (person_id) LEFT JOIN near_height USING (person_id)""",
)
def k25_closest_measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = materialize(study_cohort(spark, sf_dir))  # each look-up reads it more than once
    df = study.closest_measurement(first, measurements(spark, sf_dir, 3025315), "weight", latest_day=91)
    height = study.nearest_measurement(first, measurements(spark, sf_dir, 3036277), "height", low=90, high=210)
    df = study.assemble_analysis(df, [height], ["person_id"])
    bmi = study.body_mass_index(F.col("weight_value"), F.col("height_value"))
    return study.weight_timing(df, "weight_date").select(
        *_names(_NEAR.format("weight")), "height_value", r6(bmi, "bmi_prepreg"), "weight_timing"
    )


@register("k26_max_measurement_after", "SELECT f.person_id, top_date, top_value, top_days_from_start FROM first_eps f LEFT JOIN top_weight USING (person_id)")
def k26_max_measurement_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = study_cohort(spark, sf_dir)
    top = study.max_measurement_after(first, measurements(spark, sf_dir, 3025315), "top")
    return join_growing(first, top, "person_id", "left").select(*_names(_NEAR.format("top")))


_ASIAN = "CASE WHEN person_id % 3 = 0 THEN 'Asian' WHEN person_id % 17 <> 0 THEN 'White' END"
V["obesity_base"] = f"""
SELECT person_id, bmi_prepreg, bmi_postpartum_max, dm_before prepreg_obesity, dm_after postpartum_obesity, {_ASIAN} race FROM analysis"""
V["obesity_flagged"] = """
SELECT *, CASE WHEN bmi_prepreg IS NULL THEN NULL WHEN race = 'Asian' AND bmi_prepreg >= 27.5 THEN 1 WHEN race <> 'Asian' AND bmi_prepreg >= 30 THEN 1 ELSE 0 END a,
  CASE WHEN bmi_postpartum_max IS NULL THEN NULL WHEN race = 'Asian' AND bmi_postpartum_max >= 27.5 THEN 1 WHEN race <> 'Asian' AND bmi_postpartum_max >= 30 THEN 1 ELSE 0 END b
FROM obesity_base"""


@register(
    "k27_obesity_flags",
    """SELECT person_id, a::INT prepreg_obesity_bmi_based, b::INT postpartum_obesity_bmi_based,
  CASE WHEN prepreg_obesity = 1 OR a = 1 THEN 1 WHEN prepreg_obesity = 0 AND a = 0 THEN 0 END::INT prepreg_obesity_bmi_codes,
  CASE WHEN postpartum_obesity = 1 OR b = 1 THEN 1 WHEN postpartum_obesity = 0 AND (b IS NULL OR b = 0) THEN 0 END::INT postpartum_obesity_bmi_codes
FROM obesity_flagged""",
)
def k27_obesity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    asian = F.when(F.col("person_id") % 3 == 0, "Asian").when(F.col("person_id") % 17 != 0, "White")
    df = analysis(spark, sf_dir).withColumns(
        {"race_eth_5cat": asian, "prepreg_obesity": F.col("dm_before"), "postpartum_obesity": F.col("dm_after")}
    )
    return study.obesity_flags(df).select(
        "person_id", "prepreg_obesity_bmi_based", "postpartum_obesity_bmi_based", "prepreg_obesity_bmi_codes",
        "postpartum_obesity_bmi_codes",
    )


@register(
    "k28_incident_condition",
    """SELECT person_id, CASE WHEN htn_before = 1 THEN NULL WHEN htn_after = 1 THEN 1 ELSE 0 END::INT incident_htn,
  CASE WHEN dm_before = 1 THEN NULL WHEN dm_after = 1 THEN 1 ELSE 0 END::INT incident_dm,
  CASE WHEN dm_before = 1 AND hdp_indicator = 1 THEN NULL ELSE hdp_indicator END::INT updated_indicator FROM analysis""",
)
def k28_incident_condition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return analysis(spark, sf_dir).select(
        "person_id", study.incident(F.col("htn_before"), F.col("htn_after")).alias("incident_htn"),
        study.incident(F.col("dm_before"), F.col("dm_after")).alias("incident_dm"),
        study.without_prevalent(F.col("hdp_indicator"), F.col("dm_before")).alias("updated_indicator"),
    )


@register(
    "k29_risk_strata",
    """SELECT person_id, greatest(htn_before, dm_before) any_prior_risk, greatest(htn_before, dm_before) * 2 + hdp_indicator joint_strata,
  CASE WHEN hdp_indicator = 1 OR preterm = 1 THEN 'Any APO' ELSE 'No APO' END apo_status_cat, (outcome_category = 'SB')::INT stillbirth,
  round(floor(gestational_age_days / 7) + (gestational_age_days / 7 - floor(gestational_age_days / 7)) * 7, 6) gestational_age_weeks_days FROM analysis""",
)
def k29_risk_strata(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = study.risk_strata(
        analysis(spark, sf_dir), ("htn_before", "dm_before"), ("hdp_indicator", "preterm"), "hdp_indicator"
    )
    return df.select(
        "person_id", "any_prior_risk", "joint_strata", "apo_status_cat", "stillbirth", r6("gestational_age_weeks_days")
    )


@register("k30_engaged_subset", "SELECT person_id FROM analysis WHERE outpt_before = 1 AND outpt_after = 1")
def k30_engaged_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.engaged_subset(analysis(spark, sf_dir), "outpt_before", "outpt_after").select("person_id")


@register("k30_remove_prevalent", "SELECT person_id FROM analysis WHERE dm_before <> 1")
def k30_remove_prevalent(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.remove_prevalent(analysis(spark, sf_dir), "dm_before").select("person_id")


@register(
    "k30_split_by_enrollment",
    """SELECT person_id, CASE WHEN any_date_earliest < min_svy_date OR (any_date_earliest IS NULL AND observation_period_end_date <= min_svy_date) THEN 'pre'
  WHEN any_date_earliest >= min_svy_date THEN 'post' END enrollment_split FROM analysis""",
)
def k30_split_by_enrollment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.split_by_enrollment(analysis(spark, sf_dir)).select("person_id", "enrollment_split")


@register(
    "k31_follow_up_stats",
    """SELECT count(d) n, min(d) min_days, median(d) median_days, round(avg(d), 6) mean_days, max(d) max_days FROM (SELECT time_to_any_days d FROM timed_analysis)""",
)
def k31_follow_up_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return study.follow_up_stats(analysis(spark, sf_dir), "time_to_any_days").withColumn("mean_days", F.round("mean_days", 6))


V["found_eps"] = """
SELECT f.person_id, f.episode_number episode_id, f.episode_start_date inferred_episode_start, f.episode_end_date inferred_episode_end,
  f.outcome_category, f.gestational_age_days, f.precision_category, observation_period_start_date, observation_period_end_date
FROM final f JOIN observation_period USING (person_id)"""


@register(
    "pipeline_first_episodes",
    f"""SELECT person_id, episode_id, inferred_episode_start, inferred_episode_end, outcome_category, precision_category, {_flag(1017, _END, _OBS1)} mi
FROM (SELECT * FROM found_eps WHERE outcome_category IN ('LB', 'DELIV', 'SB') AND gestational_age_days / 7 BETWEEN 20 AND 45
    AND inferred_episode_start >= DATE '{FIRST_START}'
  QUALIFY row_number() OVER (PARTITION BY person_id ORDER BY inferred_episode_start, episode_id) = 1) f""",
)
def pipeline_first_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study on the pipeline's own episodes: exclusions, first episode, outcome afterwards."""
    found = stages(spark, sf_dir).final.select(
        "person_id", F.col("episode_number").alias("episode_id"),
        F.col("episode_start_date").alias("inferred_episode_start"), F.col("episode_end_date").alias("inferred_episode_end"),
        "outcome_category", "gestational_age_days", "precision_category",
    )
    observed = study.join_observation_period(found, tm.observation_period(spark, sf_dir))
    first = study.first_episode(study.apply_exclusions(observed, FIRST_START))
    return study.concept_set_events(
        first, events(spark, sf_dir, "mi"), "inferred_episode_end", "observation_period_end_date", "indicator", "mi"
    ).select(
        "person_id", "episode_id", "inferred_episode_start", "inferred_episode_end", "outcome_category", "precision_category", "mi"
    )
