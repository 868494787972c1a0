"""Cases worked out on paper."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from care_episodes.config import EpisodeConfig
from care_episodes.functions.dates import date_of
from care_episodes.functions.special import poisson_interval
from care_episodes.operators import agreement, dating, merge, outcomes, progression, stats, study
from tests.helpers import CONFIG, d, day, episodes, events, rules, timing


def hierarchy(spark, rows):
    out = outcomes.outcome_hierarchy(events(spark, rows), rules(spark))
    got = out.select("person_id", "outcome_category", date_of(F.col("outcome_day")).alias("date"), "n_visits")
    return sorted((r[0], r[1], str(r[2]), r[3]) for r in got.collect())


def test_sessions_split_and_chain(spark):
    rows = [(1, "LB", x) for x in ("2001-01-01", "2001-03-01", "2001-12-01")]
    rows += [(2, "LB", x) for x in ("2001-01-01", "2001-05-01", "2001-09-01")]
    assert hierarchy(spark, rows) == [
        (1, "LB", "2001-03-01", 2), (1, "LB", "2001-12-01", 1), (2, "LB", "2001-09-01", 3),
    ]


def test_spacing_rules(spark):
    rows = [
        (1, "LB", "2001-01-01"), (1, "SB", "2001-05-01"),
        (2, "LB", "2001-01-01"), (2, "SB", "2001-07-01"),
        (3, "LB", "2001-01-01"), (3, "SB", "2001-08-01"), (3, "SB", "2002-06-01"),
        (4, "LB", "2001-01-01"), (4, "ECT", "2001-02-01"),
        (5, "LB", "2001-01-01"), (5, "AB", "2001-02-01"),
        (6, "LB", "2001-01-01"), (6, "AB", "2001-04-01"),
        (7, "DELIV", "2001-01-01"), (7, "LB", "2001-01-05"),
    ]
    kept = [(p, c, x) for p, c, x, _ in hierarchy(spark, rows)]
    assert kept == sorted([
        (1, "LB", "2001-01-01"), (2, "LB", "2001-01-01"), (2, "SB", "2001-07-01"),
        (3, "LB", "2001-01-01"), (3, "SB", "2002-06-01"), (4, "LB", "2001-01-01"), (4, "ECT", "2001-02-01"),
        (5, "LB", "2001-01-01"), (6, "LB", "2001-01-01"), (6, "AB", "2001-04-01"), (7, "LB", "2001-01-05"),
    ])


def test_birth_moves_to_delivery_on_request(spark):
    rows = events(spark, [(1, "DELIV", "2001-01-01"), (1, "LB", "2001-01-05")])
    config = EpisodeConfig(as_of=CONFIG.as_of, move_birth_to_delivery=True)
    got = outcomes.outcome_hierarchy(rows, rules(spark), config).select(
        "outcome_category", date_of(F.col("outcome_day")).alias("date")
    )
    assert [tuple(r) for r in got.collect()] == [("LB", d("2001-01-01"))]


def hip(spark, rows):
    out = outcomes.outcome_episodes(events(spark, rows), rules(spark), CONFIG)
    return sorted((r.person_id, str(r.episode_start_date), str(r.episode_end_date), r.outcome_category,
                   r.gestational_age_days) for r in out.collect())


def test_start_dates(spark):
    got = hip(spark, [
        (1, "LB", "2001-10-01"), (1, "GEST", "2001-09-24", 39.0),
        (2, "LB", "2001-10-01"),
        (3, "GEST", "2001-03-01", 10.0), (3, "GEST", "2001-05-10", 20.0),
    ])
    assert (1, "2001-01-01", "2001-10-01", "LB", 273.0) in got
    assert (2, "2000-12-04", "2001-10-01", "LB", 301.0) in got
    assert [g for g in got if g[0] == 3] == [(3, "2001-05-10", "2001-09-27", "PREG", 140.0)]


def test_equal_gestation_records_are_separate_episodes(spark):
    for copies in (2, 3, 5):
        rows = events(spark, [(1, "GEST", "2001-03-01", 20.0)] * copies)
        out = outcomes.gestation_only_episodes(outcomes.gestation_records(rows))
        assert out.agg(F.sum("n_copies")).first()[0] == copies


def assigned(spark, rows):
    runs = progression.runs_with_agreement(timing(spark, rows), 360)
    return progression.assign_progression_episodes(runs)


def test_progression_boundaries(spark):
    rows = [(1, day(0), 1, 4), (1, day(300), 1, 4)]
    rows += [(2, day(0), 3, 3), (2, day(60), 9, 9), (2, day(90), 6, 6)]
    got = assigned(spark, rows).groupBy("person_id").agg(F.max("person_episode_number")).collect()
    assert dict(map(tuple, got)) == {1: 2, 2: 1}


def test_long_episodes_go_and_the_rest_is_renumbered(spark):
    # 13 runs of one month each that agree in turn make one episode of more than twelve months
    rows = [(1, day(31 * i), 1, 11) for i in range(14)]
    out = progression.drop_long_episodes(assigned(spark, rows + [(1, day(2000), 1, 4)]))
    assert [(r.person_episode_number, r.n) for r in out.collect()] == [(1, 1)]


def test_best_outcome_of_a_window(spark):
    found = progression.daily_outcomes(events(spark, [(1, "AB", day(5)), (1, "LB", day(9)), (1, "LB", day(7))]))
    blocks = timing(spark, [(1, day(0), 6, 6)])
    out = progression.progression_episodes(blocks, found, 360, CONFIG).collect()
    assert [(r.outcome_category, r.episode_end_date) for r in out] == [("LB", day(7))]


def test_merge_of_a_pair(spark):
    h = episodes(spark, [(1, 1, "2001-01-01", "2001-10-01", "LB", 273)])
    p = episodes(spark, [(1, 1, "2001-02-01", "2001-09-15", "LB", 226)], "PPS")
    formatted = merge.format_merged(merge.one_to_one_match(merge.interval_full_join(h, p))).collect()
    assert [(r.algorithm_used, r.gestational_age_days) for r in formatted] == [("MERGED", 249.0)]
    final = merge.merge_matched(h, p).collect()
    assert [(r.episode_start_date, r.episode_end_date, r.gestational_age_days) for r in final] == [
        (d("2001-01-01"), d("2001-10-01"), 273.0)
    ]


def test_losers_of_the_match(spark):
    h = episodes(spark, [(1, 1, "2001-01-01", "2001-10-01", "LB", 273), (1, 2, "2001-11-01", "2002-03-01", "AB", 120)])
    p = episodes(spark, [(1, 1, "2001-02-01", "2001-09-15", "LB", 226)], "PPS")
    pairs = merge.interval_full_join(h, p)
    assert [r.hip_id for r in merge.one_to_one_match(pairs).collect()] == [1]
    keep = EpisodeConfig(as_of=CONFIG.as_of, keep_unmatched=True)
    both = merge.one_to_one_match(pairs, keep).orderBy("hip_id").collect()
    assert [(r.hip_id, r.pps_id) for r in both] == [(1, 1), (2, None)]


def test_unpaired_episodes_of_one_person_are_all_kept(spark):
    h = episodes(spark, [
        (1, 1, "2001-01-01", "2001-10-01", "LB", 273), (1, 2, "2005-11-01", "2005-12-01", "AB", 30),
        (2, 1, "2001-01-01", "2001-10-01", "LB", 273),
    ])
    p = episodes(spark, [(2, 1, "2001-02-01", "2001-09-15", "LB", 226)], "PPS")
    assert merge.merge_matched(h, p).filter("person_id = 1").count() == 2


def dated(spark, timing_rows, event_rows, eps):
    return dating.date_episodes(eps, events(spark, event_rows), timing(spark, timing_rows), rules(spark), CONFIG)


def test_dating(spark):
    eps = episodes(spark, [(p, 1, "2000-01-01", "2000-10-01", "LB", 274) for p in (1, 2, 3)])
    base = d("2000-05-01")
    weeks = [(1, "GEST", base + dt.timedelta(days=k), 10.0) for k in (0, 1, 2, 40)]
    weeks.append((2, "GEST", base, 10.0))
    out = {r.person_id: r for r in dated(spark, [(3, base, 1, 4)], weeks, eps).collect()}
    implied = base - dt.timedelta(days=70)
    assert (out[1].episode_start_date, out[1].precision_days, out[1].precision_category) == (
        implied + dt.timedelta(days=1), 2.0, "week",
    )
    assert (out[2].episode_start_date, out[2].precision_days, out[2].precision_category) == (
        implied, -1.0, "week_poor-support",
    )
    assert (out[3].episode_start_date, out[3].precision_days, out[3].precision_category) == (
        d("2000-01-01"), 999.0, "non-specific",
    )


def test_range_consensus(spark):
    rows = [(1, 1, "GR3m", None, float(a), float(b), 1) for a, b in ((1, 5), (2, 6), (3, 9))]
    schema = "person_id long, episode_number int, GT_type string, implied_start double, range_start double, range_end double, n long"
    got = dating.interval_consensus(spark.createDataFrame(rows, schema)).first()
    assert (got.consensus_start, got.consensus_end) == (3.0, 5.0)


def test_registry_outcomes(spark):
    pregnancies = spark.createDataFrame(
        [(7, d("2000-01-01"), d("2000-09-01"), 1, 1, 0, 0, 0, 0), (7, d("2001-01-01"), d("2001-03-01"), 2, 1, 0, 0, 0, 1)],
        "emrn long, estimated_start date, estimated_end date, gravida_count int, para_count int, abortion_count int, "
        "therapeutic_count int, spontaneous_count int, ectopic_count int",
    )
    deliveries = spark.createDataFrame(
        [(7, 1, None, 1.0, None)],
        "emrn long, delivery_id long, gestational_age_days double, born_alive double, living_status string",
    )
    link = spark.createDataFrame([(7, 70)], "emrn long, person_id long")
    out = agreement.derive_registry_outcome(pregnancies, deliveries, link).orderBy("gt_episode_num").collect()
    assert [r.gt_outcome for r in out] == ["LB", "ECT"]


def test_survival_steps(spark):
    df = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 0)], "t int, e int, g int")
    got = {r.time: r.survival for r in stats.kaplan_meier(df, "t", "e", "g").collect()}
    assert got[1] == pytest.approx(2 / 3) and got[3] == 0


def test_poisson_limits():
    low, high = poisson_interval(5)
    assert (round(low, 2), round(high, 2)) == (1.62, 11.67)
    assert poisson_interval(0)[0] == 0 and poisson_interval(0)[1] == pytest.approx(3.688879, abs=1e-5)


def test_incident_condition(spark):
    df = spark.createDataFrame([(1, 1), (0, 1), (0, 0)], "b int, a int")
    got = [r[0] for r in df.select(study.incident(F.col("b"), F.col("a"))).collect()]
    assert got == [None, 1, 0]
