"""Queries for the study statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_episodes import oracle
from care_episodes.operators import regression, stats, study
from care_episodes.queries.base import r6, register
from care_episodes.queries.model_sql import cox_sql, logistic_sql, ph_test_sql, poisson_limits_sql, profile_sql
from care_episodes.queries.study import analysis

V = oracle.VIEWS
TIME, EVENT, EXPOSURE = "time_to_any_days_4y", "any_event_4y", "hdp_indicator"
CATEGORIES = ("outcome_category", "precision_category", "htn_before", "race_eth_5cat")
NUMBERS = ("mom_age", "gestational_age_days", "bmi_prepreg")
RACE = regression.Levels("race_eth_5cat", ("White", "Black or African American", "Hispanic or Latino", "Other"))


@register(
    "t1_table_one_categories",
    f"""SELECT variable, grp AS "group", level, n, CASE WHEN level IS NOT NULL THEN round(n / sum(CASE WHEN level IS NOT NULL THEN n END) OVER (PARTITION BY variable, grp) * 100, 6) END pct
FROM ({' UNION ALL '.join(f"SELECT '{v}' variable, {EXPOSURE}::VARCHAR grp, {v}::VARCHAR AS level, count(*) n FROM analysis GROUP BY 2, 3" for v in CATEGORIES)})""",
)
def t1_table_one_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.table_one_categories(analysis(spark, sf_dir), CATEGORIES, EXPOSURE)
    return out.withColumn("pct", F.round("pct", 6))


@register(
    "t1_table_one_numbers",
    f"""SELECT variable, grp AS "group", count(v) n, count(*) - count(v) missing, round(median(v), 6) AS "median", round(quantile_cont(v, 0.25), 6) q1, round(quantile_cont(v, 0.75), 6) q3
FROM ({' UNION ALL '.join(f"SELECT '{v}' variable, {EXPOSURE}::VARCHAR grp, {v}::DOUBLE v FROM analysis" for v in NUMBERS)}) GROUP BY 1, 2""",
)
def t1_table_one_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.table_one_numbers(analysis(spark, sf_dir), NUMBERS, EXPOSURE)
    return out.select("variable", "group", "n", "missing", r6("median"), r6("q1"), r6("q3"))


V["at_times"] = f"""
SELECT {EXPOSURE} grp, {TIME} t, sum({EVENT}) events, count(*) leaving FROM censored_analysis WHERE {TIME} IS NOT NULL GROUP BY 1, 2"""
V["km"] = """
SELECT *, CASE WHEN max((events = at_risk)::INT) OVER w = 1 THEN 0 ELSE exp(sum(CASE WHEN events < at_risk THEN ln(1 - events / at_risk) END) OVER w) END survival
FROM (SELECT *, sum(leaving) OVER (PARTITION BY grp ORDER BY t DESC) at_risk FROM at_times) WINDOW w AS (PARTITION BY grp ORDER BY t)"""


@register(
    "t2_kaplan_meier",
    """SELECT grp AS "group", t AS "time", at_risk::BIGINT at_risk, events::BIGINT events, (leaving - events)::BIGINT censored, round(survival, 6) survival,
  round(1 - survival, 6) cumulative_incidence FROM km""",
)
def t2_kaplan_meier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.kaplan_meier(analysis(spark, sf_dir), TIME, EVENT, EXPOSURE)
    return out.withColumns({c: F.round(c, 6) for c in ("survival", "cumulative_incidence")})


@register(
    "t2_risk_table",
    f"""SELECT {EXPOSURE} AS "group", count(*) FILTER ({TIME} >= 0) at_0, count(*) FILTER ({TIME} >= 365) at_365, count(*) FILTER ({TIME} >= 1000) at_1000
FROM censored_analysis WHERE {TIME} IS NOT NULL GROUP BY 1""",
)
def t2_risk_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.risk_table(analysis(spark, sf_dir), TIME, EXPOSURE, (0, 365, 1000))


V["lr_times"] = f"""
SELECT t, d0, d1, (SELECT count(*) FROM censored_analysis a WHERE a.{EXPOSURE} = 0 AND a.{TIME} >= t) n0,
  (SELECT count(*) FROM censored_analysis a WHERE a.{EXPOSURE} = 1 AND a.{TIME} >= t) n1
FROM (SELECT {TIME} t, sum({EVENT}) FILTER ({EXPOSURE} = 0) d0, sum({EVENT}) FILTER ({EXPOSURE} = 1) d1 FROM censored_analysis
  WHERE {EVENT} = 1 GROUP BY 1)"""
V["lr_sums"] = """
SELECT sum(coalesce(d0, 0)) o0, sum(coalesce(d1, 0)) o1, sum(d * n0 / n) e0, sum(d * n1 / n) e1,
  sum(CASE WHEN n > 1 THEN d * (n - d) / (n - 1) * n0 / n * (1 - n0 / n) ELSE 0 END) v
FROM (SELECT *, coalesce(d0, 0) + coalesce(d1, 0) d, (n0 + n1)::DOUBLE n FROM lr_times)"""


@register(
    "t3_log_rank",
    """SELECT grp AS "group", CASE grp WHEN '0' THEN o0 ELSE o1 END::DOUBLE observed, round(CASE grp WHEN '0' THEN e0 ELSE e1 END, 6) expected,
  round((o0 - e0) * (o0 - e0) / v, 6) chisq, 1 AS df FROM lr_sums, (VALUES ('0'), ('1')) g(grp)""",
)
def t3_log_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.log_rank(analysis(spark, sf_dir), TIME, EVENT, EXPOSURE)
    return out.select("group", "observed", r6("expected"), r6("chisq"), "df")


@register(
    "t3_log_rank_p_value",
    f"""SELECT * FROM (WITH a AS (SELECT outcome_category grp, {TIME} t, {EVENT} e FROM censored_analysis WHERE {TIME} IS NOT NULL AND outcome_category IS NOT NULL),
g AS (
  SELECT n.grp, k.t, (SELECT count(*) FROM a WHERE a.grp = n.grp AND a.t >= k.t)::DOUBLE n, (SELECT count(*) FROM a WHERE a.grp = n.grp AND a.t = k.t AND e = 1) d
  FROM (SELECT DISTINCT grp FROM a) n, (SELECT DISTINCT t FROM a WHERE e = 1) k),
total AS (SELECT t, sum(n) n, sum(d)::DOUBLE d FROM g GROUP BY t),
s AS (SELECT grp, sum(g.d)::DOUBLE o, sum(total.d * g.n / total.n) e, row_number() OVER (ORDER BY grp) k FROM g JOIN total USING (t) GROUP BY grp),
v AS (
  SELECT i.grp gi, j.grp gj, sum(CASE WHEN total.n > 1 THEN total.d * (total.n - total.d) / (total.n - 1) ELSE 0 END
    * i.n / total.n * ((i.grp = j.grp)::INT - j.n / total.n)) v
  FROM g i JOIN g j USING (t) JOIN total USING (t) GROUP BY 1, 2),
m AS (
  SELECT a.o - a.e x, b.o - b.e y, (SELECT v FROM v WHERE gi = a.grp AND gj = a.grp) xx, (SELECT v FROM v WHERE gi = a.grp AND gj = b.grp) xy,
    (SELECT v FROM v WHERE gi = b.grp AND gj = b.grp) yy FROM s a, s b WHERE a.k = 1 AND b.k = 2),
c AS (SELECT (yy * x * x - 2 * xy * x * y + xx * y * y) / (xx * yy - xy * xy) chisq FROM m)
SELECT grp AS "group", o observed, round(e, 6) expected, round(chisq, 6) chisq, 2 AS df, round(exp(-chisq / 2), 9) p_value FROM s, c)""",
)
def t3_log_rank_p_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three groups: with two degrees of freedom the tail has a closed form to compare with."""
    out = stats.log_rank(analysis(spark, sf_dir), TIME, EVENT, "outcome_category")
    return out.withColumns({"expected": r6("expected"), "chisq": r6("chisq"), "p_value": F.round("p_value", 9)})


@register(
    "t4_incidence_rate",
    f"""SELECT {EXPOSURE}, htn_before, count(*) n, sum({EVENT})::BIGINT events, round(sum({TIME} / 365.25), 6) person_years,
  round(sum({EVENT}) * 1000 / sum({TIME} / 365.25), 6) rate_per_1000 FROM censored_analysis GROUP BY 1, 2""",
)
def t4_incidence_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = stats.incidence_rate(analysis(spark, sf_dir), EVENT, "time_to_any_years_4y", [EXPOSURE, "htn_before"])
    return rates.withColumns({c: F.round(c, 6) for c in ("person_years", "rate_per_1000")})


@register(
    "t4_incidence_rate_ci",
    poisson_limits_sql(
        f"SELECT {EXPOSURE}, count(*) n, sum({EVENT})::BIGINT events, sum({TIME} / 365.25) person_years FROM censored_analysis GROUP BY 1",
        f"{EXPOSURE}, n, events, round(person_years, 6) person_years, round(events * 1000 / person_years, 6) rate_per_1000",
    ),
)
def t4_incidence_rate_ci(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = stats.incidence_rate(analysis(spark, sf_dir), EVENT, "time_to_any_years_4y", [EXPOSURE])
    found = stats.incidence_rate_ci(rates)
    return found.withColumns({c: F.round(c, 6) for c in ("person_years", "rate_per_1000", "rate_low", "rate_high")})


def _r4(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 4) for c in columns})


MODEL_COLUMNS = ("coefficient", "std_error", "ratio", "low", "high", "p_value")


def _cases(time: str, event: str, columns: dict[str, str], where: str = "true") -> str:
    """Complete rows (t, e, columns) of a model."""
    known = " AND ".join(f"({c}) IS NOT NULL" for c in (time, event, *columns.values()))
    return f"SELECT {time}::DOUBLE t, {event} e, {', '.join(f'{c} AS {n}' for n, c in columns.items())} FROM censored_analysis WHERE {known} AND {where}"


RACE_TERMS = [f"(race = '{v}')::INT" for v in RACE.levels[1:]]
RACE_NAMES = [f"race_eth_5cat={v}" for v in RACE.levels[1:]]


@register(
    "t5_cox_ph",
    cox_sql(_cases(TIME, EVENT, {"x": EXPOSURE, "age": "mom_age", "race": "race_eth_5cat"}), ["x", "age - 30", *RACE_TERMS], [EXPOSURE, "mom_age", *RACE_NAMES]),
)
def t5_cox_ph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposure, age and race, with ties."""
    return _r4(regression.cox_ph(analysis(spark, sf_dir), TIME, EVENT, [EXPOSURE, "mom_age", RACE]), *MODEL_COLUMNS)


@register(
    "t5_cox_interaction",
    cox_sql(_cases(TIME, EVENT, {"x": EXPOSURE, "h": "htn_before"}), ["x", "h", "x * h"], [EXPOSURE, "htn_before", f"{EXPOSURE}:htn_before"]),
)
def t5_cox_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r4(regression.cox_ph(analysis(spark, sf_dir), TIME, EVENT, [EXPOSURE, "htn_before", f"{EXPOSURE}:htn_before"]), *MODEL_COLUMNS)


@register(
    "t5_cox_intervals",
    cox_sql(
        _cases(TIME, EVENT, {"x": EXPOSURE, "y": f"({TIME} / 365.25)"}),
        ["x * (y <= 1)::INT", "x * (y > 1 AND y <= 2)::INT", "x * (y > 2)::INT"], [f"{EXPOSURE}_{part}" for part in ("early", "mid", "late")],
    ),
)
def t5_cox_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = regression.follow_up_intervals(analysis(spark, sf_dir), "time_to_any_years_4y", EXPOSURE, (1, 2))
    return _r4(regression.cox_ph(df, TIME, EVENT, [f"{EXPOSURE}_{part}" for part in ("early", "mid", "late")]), *MODEL_COLUMNS)


_ENGAGED = "outpt_before = 1 AND outpt_after = 1"


@register(
    "t5_cox_table",
    " UNION ALL ".join(
        f"SELECT '{o}' outcome, '{model}' model, * FROM ({cox_sql(_cases(f'time_to_{o}_days_4y', f'{o}_event_4y', columns, _ENGAGED), x, names)}) WHERE term = '{EXPOSURE}'"
        for o in ("any", "mi")
        for model, columns, x, names in (
            ("unadjusted", {"x": EXPOSURE}, ["x"], [EXPOSURE]), ("adjusted", {"x": EXPOSURE, "age": "mom_age"}, ["x", "age - 30"], [EXPOSURE, "mom_age"]),
        )
    ),
)
def t5_cox_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Plain and adjusted hazard ratios for two outcomes in persons engaged in care."""
    engaged = study.engaged_subset(analysis(spark, sf_dir), "outpt_before", "outpt_after")
    outcomes = {o: (f"time_to_{o}_days_4y", f"{o}_event_4y") for o in ("any", "mi")}
    return _r4(regression.cox_table(engaged, outcomes, [EXPOSURE], ["mom_age"]), *MODEL_COLUMNS)


@register("t5_ph_test", ph_test_sql(_cases(TIME, EVENT, {"x": EXPOSURE}), "x", EXPOSURE))
def t5_ph_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the exposure's hazard ratio stays the same over time."""
    return _r4(regression.cox_ph_test(analysis(spark, sf_dir), TIME, EVENT, [EXPOSURE]), "chisq", "p_value")


@register(
    "t5_time_varying",
    cox_sql(_cases(f"(CASE WHEN {TIME} = 0 THEN 0.001 ELSE {TIME} END)", EVENT, {"x": EXPOSURE}), ["x", "x * ln(ev.t)"], [EXPOSURE, f"{EXPOSURE}:log({TIME})"]),
)
def t5_time_varying(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exposure, and exposure times the log of time."""
    return _r4(regression.cox_log_time(analysis(spark, sf_dir), TIME, EVENT, EXPOSURE), *MODEL_COLUMNS)


def _incident(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = analysis(spark, sf_dir)
    return df.withColumn("incident_htn", study.incident(F.col("htn_before"), F.col("htn_after")))


_INCIDENT = f"""SELECT CASE WHEN htn_before = 1 THEN NULL ELSE htn_after END y, {EXPOSURE}, mom_age, race_eth_5cat race FROM analysis"""
_INCIDENT_KNOWN = f"SELECT * FROM ({_INCIDENT}) WHERE y IS NOT NULL AND {EXPOSURE} IS NOT NULL"


@register(
    "t6_logistic_or",
    logistic_sql(
        f"{_INCIDENT_KNOWN} AND mom_age IS NOT NULL AND race IS NOT NULL", [EXPOSURE, "mom_age", *RACE_TERMS], [EXPOSURE, "mom_age", *RACE_NAMES]
    ),
)
def t6_logistic_or(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _r4(regression.logistic_or(_incident(spark, sf_dir), "incident_htn", [EXPOSURE, "mom_age", RACE]), *MODEL_COLUMNS)


@register("t6_logistic_profile", profile_sql(_INCIDENT_KNOWN, EXPOSURE))
def t6_logistic_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Odds ratio of the exposure with profile-likelihood limits."""
    return _r4(regression.logistic_profile(_incident(spark, sf_dir), "incident_htn", [EXPOSURE]), "coefficient", "ratio", "low", "high")


_EACH = {EXPOSURE: ("0", "1"), "preterm": ("0", "1"), "race_eth_5cat": RACE.levels}
V["two_by_two"] = " UNION ALL ".join(
    f"""SELECT '{v}' variable, {i} AS pos, '{v if levels == ('0', '1') else f'{v}={level}'}' term,
  count(*) FILTER (y = 1) a, count(*) FILTER (y = 0) b
FROM (SELECT {v}::VARCHAR x, CASE WHEN htn_before = 1 THEN NULL ELSE htn_after END y FROM analysis) WHERE x = '{level}'"""
    for v, levels in _EACH.items() for i, level in enumerate(levels)
)
V["single_fits"] = """
SELECT t.variable, t.term, ln(t.a / t.b) - ln(r.a / r.b) coef, sqrt(1 / t.a + 1 / t.b + 1 / r.a + 1 / r.b) se
FROM two_by_two t JOIN two_by_two r ON r.variable = t.variable AND r.pos = 0 AND t.pos > 0
UNION ALL SELECT variable, '(Intercept)', ln(a / b), sqrt(1 / a + 1 / b) FROM two_by_two WHERE pos = 0"""


@register(
    "t6_logistic_each",
    """SELECT variable, term, round(coef, 4) coefficient, round(se, 4) std_error, round(exp(coef), 4) ratio,
  round(exp(coef - 1.959963984540054 * se), 4) low, round(exp(coef + 1.959963984540054 * se), 4) high FROM single_fits""",
)
def t6_logistic_each(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model per variable; with one categorical variable the odds ratios have a closed form."""
    out = regression.logistic_each(_incident(spark, sf_dir), "incident_htn", [EXPOSURE, "preterm", RACE])
    numbers = [F.round(c, 4).alias(c) for c in ("coefficient", "std_error", "ratio", "low", "high")]
    return out.select("variable", "term", *numbers)


@register(
    "t7_exposure_tables",
    f"""SELECT variable, v AS "value", x AS exposure, count(*) n FROM ({' UNION ALL '.join(
        f"SELECT '{v}' variable, {v}::INT v, {EXPOSURE} x FROM censored_analysis" for v in ('mi_event_4y', 'stroke_event_4y', 'htn_after', 'dm_after'))}) GROUP BY 1, 2, 3""",
)
def t7_exposure_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.exposure_tables(analysis(spark, sf_dir), EXPOSURE, ("mi_event_4y", "stroke_event_4y", "htn_after", "dm_after"))


@register(
    "t7_events_per_variable",
    """SELECT variable, events, predictors, round(events / predictors, 6) events_per_variable FROM (
  SELECT 'htn_after' variable, sum(htn_after)::BIGINT events, 4 predictors FROM censored_analysis
  UNION ALL SELECT 'mi_event_4y', sum(mi_event_4y)::BIGINT, 5 FROM censored_analysis)""",
)
def t7_events_per_variable(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = stats.events_per_variable(analysis(spark, sf_dir), {"htn_after": 4, "mi_event_4y": 5})
    return out.withColumn("events_per_variable", F.round("events_per_variable", 6))
