"""Queries for the comparison with a registry."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from care_episodes import oracle
from care_episodes import testmap as tm
from care_episodes.operators import agreement
from care_episodes.queries.base import r6, register, stages

V = oracle.VIEWS
_KIND = oracle._case("(o_orderkey % 20)", dict(enumerate(tm.OUTCOME_OF_ORDER)))


def _running(*names: str) -> str:
    listed = ", ".join(f"'{n}'" for n in names)
    return f"sum((kind IN ({listed}))::INT) OVER w"


V["registry_rows"] = f"""
SELECT o_custkey + 500000 emrn, o_orderdate::DATE - 280 estimated_start, o_orderdate::DATE + (o_orderkey % 41 - 20)::INT estimated_end,
  row_number() OVER w gravida_count, {_running('LB', 'SB', 'DELIV')} para_count, {_running('AB', 'SA')} abortion_count,
  0 therapeutic_count, {_running('SA')} spontaneous_count, {_running('ECT')} ectopic_count
FROM (SELECT *, {_KIND} AS kind FROM orders) WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)"""
V["delivery_rows"] = f"""
SELECT o_custkey + 500000 emrn, o_orderkey delivery_id, CASE WHEN o_orderkey % 11 <> 0 THEN (140 + o_orderkey % 160)::DOUBLE END ga,
  CASE WHEN o_orderkey % 9 <> 0 THEN (o_orderkey % 5 <> 0)::INT END born_alive,
  CASE WHEN o_orderkey % 13 = 0 THEN 'Stillborn' END living_status FROM orders WHERE {_KIND} IN ('LB', 'SB', 'DELIV')"""
V["mothers"] = """
SELECT emrn, first(ga ORDER BY delivery_id) FILTER (ga IS NOT NULL) ga, first(born_alive ORDER BY delivery_id) FILTER (born_alive IS NOT NULL) born_alive,
  first(living_status ORDER BY delivery_id) FILTER (living_status IS NOT NULL) living_status FROM delivery_rows GROUP BY 1"""
V["known_pregnancies"] = """
SELECT emrn - 500000 person_id, emrn, gravida_count gt_episode_num, estimated_start gt_start, estimated_end gt_end,
  CASE WHEN dp > 0 AND born_alive = 1 THEN 'LB' WHEN dp > 0 AND born_alive = 0 THEN 'SB'
    WHEN dp > 0 AND lower(living_status) IN ('stillborn', 'fetal demise') THEN 'SB' WHEN de > 0 THEN 'ECT' WHEN dt > 0 THEN 'AB'
    WHEN ds > 0 THEN 'SA' WHEN da > 0 AND dt = 0 AND ds = 0 THEN 'AB' WHEN dp > 0 THEN 'DELIV' ELSE 'PREG' END gt_outcome,
  ga gt_ga_days, born_alive::DOUBLE born_alive, living_status FROM (
  SELECT r.*, m.ga, m.born_alive, m.living_status, para_count - lag(para_count, 1, 0) OVER w dp, abortion_count - lag(abortion_count, 1, 0) OVER w da,
    therapeutic_count - lag(therapeutic_count, 1, 0) OVER w dt, spontaneous_count - lag(spontaneous_count, 1, 0) OVER w ds,
    ectopic_count - lag(ectopic_count, 1, 0) OVER w de
  FROM registry_rows r LEFT JOIN mothers m USING (emrn) WINDOW w AS (PARTITION BY emrn ORDER BY gravida_count))"""
V["algo_side"] = """
SELECT person_id, episode_number algo_episode_num, episode_start_date algo_start, episode_end_date algo_end, outcome_category algo_outcome,
  gestational_age_days algo_ga_days, row_number() OVER (PARTITION BY person_id ORDER BY episode_end_date, episode_number)::INT algo_order FROM hip"""
V["gt_side"] = """
SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY gt_end, gt_episode_num)::INT gt_order FROM known_pregnancies"""
V["matched_episodes"] = """
SELECT a.*, g.* EXCLUDE (person_id), a.algo_end - g.gt_end end_date_diff FROM algo_side a JOIN gt_side g
ON a.person_id = g.person_id AND abs(a.algo_end - g.gt_end) <= 30
QUALIFY row_number() OVER (PARTITION BY a.person_id, algo_episode_num ORDER BY abs(a.algo_end - g.gt_end), gt_order) = 1"""
V["match_stats"] = """
SELECT *, matched / total_algo match_rate_algo, matched / total_gt match_rate_gt FROM (SELECT
  (SELECT count(*) FROM matched_episodes) matched,
  (SELECT count(*) FROM algo_side a WHERE NOT EXISTS (SELECT 1 FROM matched_episodes m WHERE m.person_id = a.person_id AND m.algo_episode_num = a.algo_episode_num)) unmatched_algo,
  (SELECT count(*) FROM gt_side g WHERE NOT EXISTS (SELECT 1 FROM matched_episodes m WHERE m.person_id = g.person_id AND m.gt_episode_num = g.gt_episode_num)) unmatched_gt,
  (SELECT count(*) FROM algo_side) total_algo, (SELECT count(*) FROM gt_side) total_gt)"""
V["cells"] = """
SELECT a.c algo_outcome, g.c gt_outcome, (SELECT count(*) FROM matched_episodes m WHERE m.algo_outcome = a.c AND m.gt_outcome = g.c) n
FROM (VALUES ('LB'), ('SB'), ('ECT'), ('AB'), ('SA'), ('DELIV'), ('PREG')) a(c), (VALUES ('LB'), ('SB'), ('ECT'), ('AB'), ('SA'), ('DELIV'), ('PREG')) g(c)"""
V["metrics"] = """
SELECT *, tp / nullif(tp + fp, 0) prec, tp / nullif(tp + fn, 0) rec FROM (
  SELECT c category, (SELECT count(*) FROM matched_episodes WHERE algo_outcome = c AND gt_outcome = c) tp,
    (SELECT count(*) FROM matched_episodes WHERE algo_outcome = c AND gt_outcome <> c) fp,
    (SELECT count(*) FROM matched_episodes WHERE algo_outcome <> c AND gt_outcome = c) fn,
    (SELECT count(*) FROM matched_episodes WHERE algo_outcome <> c AND gt_outcome <> c) tn
  FROM (VALUES ('LB'), ('SB'), ('ECT'), ('AB'), ('SA'), ('DELIV'), ('PREG')) t(c))"""
V["ga_pairs"] = """
SELECT *, algo_ga_days - gt_ga_days d FROM matched_episodes WHERE algo_ga_days BETWEEN 0 AND 320 AND gt_ga_days BETWEEN 0 AND 320"""
V["ga_summary"] = """
SELECT count(*) n, avg(d) mean_diff, median(d) median_diff, stddev_samp(d) sd_diff, avg(abs(d)) mae, sqrt(avg(d * d)) rmse,
  avg((abs(d) <= 7)::INT) * 100 pct_within_7d, avg((abs(d) <= 14)::INT) * 100 pct_within_14d, avg((abs(d) <= 21)::INT) * 100 pct_within_21d,
  corr(algo_ga_days, gt_ga_days) correlation, avg(d) - 1.96 * stddev_samp(d) lower_limit, avg(d) + 1.96 * stddev_samp(d) upper_limit FROM ga_pairs"""
V["per_person"] = """
SELECT coalesce(a.person_id, g.person_id) person_id, coalesce(a.total, 0) algo_total, coalesce(a.lb, 0) algo_lb, coalesce(a.sb, 0) algo_sb,
  coalesce(a.ab, 0) algo_ab, coalesce(a.ect, 0) algo_ect, coalesce(g.total, 0) gt_total, coalesce(g.lb, 0) gt_lb, coalesce(g.sb, 0) gt_sb,
  coalesce(g.ab, 0) gt_ab, coalesce(g.ect, 0) gt_ect FROM (
  SELECT person_id, count(*) total, count(*) FILTER (algo_outcome = 'LB') lb, count(*) FILTER (algo_outcome = 'SB') sb,
    count(*) FILTER (algo_outcome IN ('AB', 'SA')) ab, count(*) FILTER (algo_outcome = 'ECT') ect FROM algo_side GROUP BY 1) a
FULL JOIN (SELECT person_id, count(*) total, count(*) FILTER (gt_outcome = 'LB') lb, count(*) FILTER (gt_outcome = 'SB') sb,
    count(*) FILTER (gt_outcome IN ('AB', 'SA')) ab, count(*) FILTER (gt_outcome = 'ECT') ect FROM gt_side GROUP BY 1) g USING (person_id)"""
V["person_summary"] = """
SELECT count(*) n_persons, count(*) FILTER (gt_total = 0 AND algo_total > 0) n_algo_only, count(*) FILTER (algo_total = 0 AND gt_total > 0) n_gt_only,
  count(*) FILTER (gt_total > 0 AND algo_total > 0) n_both, avg((algo_total = gt_total)::INT) * 100 pct_exact_total_match,
  avg((algo_lb = gt_lb)::INT) * 100 pct_lb_match, avg((algo_ab = gt_ab)::INT) * 100 pct_ab_match, avg(algo_total - gt_total) mean_total_diff,
  median(algo_total - gt_total) median_total_diff, count(*) FILTER (algo_total > gt_total) n_over_count,
  count(*) FILTER (algo_total < gt_total) n_under_count, count(*) FILTER (algo_total = gt_total) n_exact FROM per_person"""


def rounded(view: str, doubles: list[str], others: list[str]) -> str:
    return f"SELECT {', '.join(others + [f'round({c}, 6) {c}' for c in doubles])} FROM {view}"


def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    pregnancies, deliveries, emrn_cohort, cohort_person = tm.registry(spark, sf_dir)
    return agreement.derive_registry_outcome(pregnancies, deliveries, agreement.link_ids(emrn_cohort, cohort_person))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, stored: for queries that read it more than once."""
    return stages(spark, sf_dir).once("registry", lambda: _known(spark, sf_dir))


def _match(spark: SparkSession, sf_dir: str, registry: DataFrame | None = None) -> agreement.MatchResult:
    return agreement.match_episodes(stages(spark, sf_dir).hip, _known(spark, sf_dir) if registry is None else registry, 30)


@register(
    "v1_load_predictions",
    """SELECT DISTINCT person_id, episode_id AS episode_number, inferred_episode_start episode_start_date, inferred_episode_end episode_end_date,
  final_outcome_category outcome_category, gestational_age_days, 'HIP' AS algorithm_used, precision_category FROM study_eps""",
)
def v1_load_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions with their dates split over duplicate columns, every row twice."""
    e = tm.study_episodes(spark, sf_dir)
    odd = F.col("episode_id") % 2 == 1
    start, end = F.col("inferred_episode_start"), F.col("inferred_episode_end")
    raw = e.select(
        "person_id", F.col("episode_id").alias("Episode_Number"),
        F.when(odd, start).alias("episode_start_date"), F.when(~odd, start).alias("episode_start_date_x"),
        F.when(odd, end).alias("episode_end_date"), end.alias("episode_end_date_x"),
        F.col("final_outcome_category").alias("outcome_category"), "gestational_age_days",
        F.lit("HIP").alias("algorithm_used"), "precision_category",
    )
    return agreement.load_predictions(raw.unionByName(raw))


@register(
    "v2_link_ids",
    """SELECT 'registry ids in id table' AS "check", count(DISTINCT emrn) ids, count(DISTINCT CASE WHEN emrn - 500000 IN (SELECT c_custkey FROM customer) THEN emrn END) known FROM registry_rows
UNION ALL SELECT 'predicted persons in linkage', count(DISTINCT person_id), count(DISTINCT CASE WHEN person_id IN (SELECT c_custkey FROM customer) THEN person_id END) FROM hip""",
)
def v2_link_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    pregnancies, _, emrn_cohort, cohort_person = tm.registry(spark, sf_dir)
    linkage = agreement.link_ids(emrn_cohort, cohort_person)
    return agreement.linkage_overlap(stages(spark, sf_dir).hip, pregnancies, emrn_cohort, linkage)


@register("v3_derive_registry_outcome", "SELECT * FROM known_pregnancies")
def v3_derive_registry_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _known(spark, sf_dir)


_MATCHED = """person_id, algo_episode_num, algo_end, algo_outcome, round(algo_ga_days, 6) algo_ga_days, gt_episode_num, gt_end, gt_outcome,
  gt_ga_days, end_date_diff::INT end_date_diff"""


@register("v4_match_episodes", f"SELECT {_MATCHED} FROM matched_episodes")
def v4_match_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _match(spark, sf_dir).matched.select(
        "person_id", "algo_episode_num", "algo_end", "algo_outcome", r6("algo_ga_days"), "gt_episode_num", "gt_end",
        "gt_outcome", "gt_ga_days", "end_date_diff",
    )


@register(
    "v4_match_by_order",
    """SELECT a.person_id, algo_episode_num, gt_episode_num, algo_order, NULL::INT end_date_diff FROM algo_side a
JOIN gt_side g ON a.person_id = g.person_id AND algo_order = gt_order""",
)
def v4_match_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry dates shifted far away: no date matches, so the order within persons decides."""
    shifted = _stored(spark, sf_dir).withColumn("gt_end", F.date_add("gt_end", 36500))
    result = agreement.match_episodes(stages(spark, sf_dir).hip, shifted, 30)
    return result.matched.select("person_id", "algo_episode_num", "gt_episode_num", "algo_order", "end_date_diff")


_RATES = ["match_rate_algo", "match_rate_gt"]
_TOTALS = ["matched", "unmatched_algo", "unmatched_gt", "total_algo", "total_gt"]


@register("v4_match_stats", rounded("match_stats", _RATES, _TOTALS))
def v4_match_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _match(spark, sf_dir, _stored(spark, sf_dir)).stats().select(*_TOTALS, *[r6(c) for c in _RATES])


@register("v5_confusion_matrix", "SELECT * FROM cells")
def v5_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.confusion_matrix(_match(spark, sf_dir).matched)


@register(
    "v6_classification_metrics",
    """SELECT category, tp true_positive, fp false_positive, fn false_negative, tn true_negative, round(prec, 6) AS "precision",
  round(rec, 6) recall, round(2 * prec * rec / nullif(prec + rec, 0), 6) f1_score, tp + fn support FROM metrics""",
)
def v6_classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.classification_metrics(_match(spark, sf_dir).matched).withColumns(
        {c: F.round(c, 6) for c in ("precision", "recall", "f1_score")}
    )


@register(
    "v6_overall_accuracy",
    """SELECT count(*) total_matched, count(*) FILTER (algo_outcome = gt_outcome) total_correct,
  round(count(*) FILTER (algo_outcome = gt_outcome) / count(*), 6) overall_accuracy FROM matched_episodes""",
)
def v6_overall_accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.overall_accuracy(_match(spark, sf_dir).matched).withColumn(
        "overall_accuracy", F.round("overall_accuracy", 6)
    )


_GA = ["mean_diff", "median_diff", "sd_diff", "mae", "rmse", "pct_within_7d", "pct_within_14d", "pct_within_21d",
       "correlation", "lower_limit", "upper_limit"]


@register("v7_ga_agreement", rounded("ga_summary", _GA, ["n"]))
def v7_ga_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.ga_agreement(_match(spark, sf_dir).matched).select("n", *[r6(c) for c in _GA])


@register(
    "v7_ga_by_outcome",
    """SELECT gt_outcome, count(*) n, round(avg(d), 6) mean_diff, round(median(d), 6) median_diff, round(avg(abs(d)), 6) mae,
  round(avg((abs(d) <= 7)::INT) * 100, 6) pct_within_7d, round(avg((abs(d) <= 14)::INT) * 100, 6) pct_within_14d FROM ga_pairs GROUP BY 1""",
)
def v7_ga_by_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    by_outcome = agreement.ga_agreement_by_outcome(_match(spark, sf_dir).matched)
    return by_outcome.select("gt_outcome", "n", *[r6(c) for c in by_outcome.columns[2:]])


@register(
    "v8_person_counts",
    """SELECT *, algo_total - gt_total total_diff, algo_lb = gt_lb lb_match, algo_ab = gt_ab ab_match FROM per_person""",
)
def v8_person_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return agreement.person_counts(stages(spark, sf_dir).hip, _known(spark, sf_dir))


_PERSON_RATES = ["pct_exact_total_match", "pct_lb_match", "pct_ab_match", "mean_total_diff", "median_total_diff"]
_PERSON_COUNTS = ["n_persons", "n_algo_only", "n_gt_only", "n_both", "n_over_count", "n_under_count", "n_exact"]


@register("v8_person_agreement", rounded("person_summary", _PERSON_RATES, _PERSON_COUNTS))
def v8_person_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = agreement.person_counts(stages(spark, sf_dir).hip, _known(spark, sf_dir))
    return agreement.person_agreement(counts).select(*_PERSON_COUNTS, *[r6(c) for c in _PERSON_RATES])


@register(
    "v9_validation_summary",
    """SELECT metric, round(value::DOUBLE, 1) AS value FROM (
SELECT 'Algorithm episodes' metric, total_algo AS value FROM match_stats UNION ALL SELECT 'Ground truth episodes', total_gt FROM match_stats
UNION ALL SELECT 'Matched episodes', matched FROM match_stats UNION ALL SELECT 'Algorithm match rate', match_rate_algo * 100 FROM match_stats
UNION ALL SELECT 'Ground truth match rate', match_rate_gt * 100 FROM match_stats
UNION ALL SELECT 'Overall classification accuracy', avg((algo_outcome = gt_outcome)::INT) * 100 FROM matched_episodes
UNION ALL SELECT 'Mean GA difference (days)', mean_diff FROM ga_summary UNION ALL SELECT 'GA within 7 days', pct_within_7d FROM ga_summary
UNION ALL SELECT 'GA within 14 days', pct_within_14d FROM ga_summary
UNION ALL SELECT 'Person exact count match', pct_exact_total_match FROM person_summary)""",
)
def v9_validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    registry = _stored(spark, sf_dir)
    return agreement.validation_summary(_match(spark, sf_dir, registry), stages(spark, sf_dir).hip, registry)
