"""Tables that grow with the input are never broadcast, however small their files look."""

import os
import re

import pytest
from pyspark.sql import functions as F

from care_episodes.config import EpisodeConfig
from care_episodes.functions.scan import day_parts, running_sums
from care_episodes.operators import agreement, dating, merge, outcomes, progression, study
from care_episodes.queries import QUERIES
from care_episodes.session import materialize, small_table
from care_episodes.sources import cdm
from tests.helpers import episodes, events, rules, timing


def broadcasts(df) -> int:
    return len(re.findall("BroadcastHashJoin", df._jdf.queryExecution().executedPlan().toString()))


def stored_timing(spark):
    return materialize(timing(spark, [(p, f"2020-0{m}-01", m, m + 1) for p in range(1, 6) for m in range(1, 8)]))


def stored_episodes(spark, source="HIP"):
    rows = [(p, n, f"201{n}-01-01", f"201{n}-09-01", "LB", 240) for p in range(1, 6) for n in range(1, 4)]
    return materialize(episodes(spark, rows, source))


def test_timing_and_dating_broadcast_no_persons(spark):
    records, found = stored_timing(spark), stored_episodes(spark)
    agreeing = progression.agreement_of_records(records)
    assert broadcasts(agreeing) == 0
    assert agreeing.agg(F.sum("n")).first()[0] == records.count()
    assert broadcasts(progression.runs_with_agreement(records, 400)) == 0
    dated = dating.dated_records(records.withColumns({"concept_name": F.lit(None).cast("string"), "gest_value": F.lit(None).cast("double")}))
    matched = materialize(dating.timing_to_episode(materialize(dated), found))
    assert broadcasts(dating.timing_to_episode(materialize(dated), found)) == 0
    refined = dating.refine_start(dating.gw_outlier_filter(matched), dating.interval_consensus(matched), EpisodeConfig())
    assert broadcasts(dating.apply_refinement(found, refined)) == 0


def test_merge_and_registry_broadcast_no_persons(spark):
    hip, pps = stored_episodes(spark), stored_episodes(spark, "PPS")
    assert broadcasts(merge.interval_full_join(hip, pps)) == 0
    assert broadcasts(merge.episode_overlaps(merge.episode_windows(hip), merge.episode_windows(pps))) == 0
    registry = materialize(hip.select(
        "person_id", F.col("episode_number").alias("gt_episode_num"), F.col("episode_start_date").alias("gt_start"),
        F.col("episode_end_date").alias("gt_end"), F.col("outcome_category").alias("gt_outcome"), F.col("gestational_age_days").alias("gt_ga_days"),
    ))
    result = agreement.match_episodes(hip, registry)
    assert result.matched.count() == 15
    assert broadcasts(result.unmatched_predicted) == broadcasts(result.unmatched_registry) == 0
    assert broadcasts(agreement.person_counts(hip, registry)) == 0


def test_parts_broadcast_no_persons(spark):
    records = stored_timing(spark).withColumn("day", F.unix_date("event_date"))
    assert broadcasts(running_sums(day_parts(records, ["person_id"], F.col("day")), ["person_id"], ["concept_id"], {"k": F.lit(1)})) == 0
    gestation = materialize(outcomes.gestation_records(events(spark, [(p, "GEST", f"2020-0{m}-01", None, float(m * 4)) for p in range(5) for m in range(1, 8)])))
    assert broadcasts(outcomes.gestation_only_episodes(gestation)) == 0


def test_study_broadcasts_the_code_lists_only(spark):
    cohort = materialize(stored_episodes(spark).where("episode_number = 1").select(
        "person_id", F.col("episode_number").alias("episode_id"),
        F.col("episode_start_date").alias("inferred_episode_start"), F.col("episode_end_date").alias("inferred_episode_end"),
    ))
    table = materialize(stored_timing(spark).select(
        "person_id", F.lit(5).cast("bigint").alias("condition_concept_id"), F.col("event_date").alias("condition_start_date")))
    wanted = small_table(spark, [("a", 5), ("b", 6)], "set_name string, concept_id long")
    found = study.many_set_events({"condition_occurrence": table}, wanted, {"a": ("condition",), "b": ("condition",)})
    windows = {"a": ("a", "inferred_episode_end", None), "b": ("b", "inferred_episode_start", "inferred_episode_end")}
    assert broadcasts(found) == 1
    assert broadcasts(study.window_summaries(cohort, materialize(found), windows)) == 0
    values = materialize(found.withColumn("value_as_number", F.lit(60.0)))
    near = study.closest_measurement(cohort, values, "weight")
    assert broadcasts(near) == 0 and near.where("weight_value = 60").count() == 5
    assert broadcasts(study.max_measurement_after(cohort, values, "top")) == 0
    assert broadcasts(study.set_summary(cohort, values, "inferred_episode_start", "inferred_episode_end", "a")) == 0


def test_person_filters_broadcast_no_persons(spark):
    persons = materialize(spark.range(1, 5).select(
        F.col("id").alias("person_id"), F.lit(1990).alias("year_of_birth"), F.lit(1).alias("month_of_birth"), F.lit(1).alias("day_of_birth")))
    assert broadcasts(cdm.filter_reproductive_age(stored_timing(spark), persons, EpisodeConfig())) == 0
    table = materialize(stored_timing(spark).select("person_id", F.lit(1000).cast("bigint").alias("condition_concept_id"), F.col("event_date").alias("condition_start_date")))
    domain = next(d for d in cdm.DOMAINS if d.name == "Condition")
    assert broadcasts(cdm.extract_domain({"condition_occurrence": table}, domain, rules(spark).outcome_concepts, persons)) == 1


def test_code_lists_filter_below_the_joins_of_a_view(spark):
    lines = materialize(spark.range(100).select(F.col("id").alias("line"), (F.col("id") % 7).alias("kind")))
    owners = materialize(spark.range(100).select(F.col("id").alias("line_id"), (F.col("id") % 5).alias("person_id")))
    view = lines.join(owners, F.col("line") == F.col("line_id")).select(
        "person_id", F.when(F.col("kind") < 3, F.col("kind") + 1000).otherwise(0).alias("condition_concept_id"),
        F.lit("2020-01-01").cast("date").alias("condition_start_date"),
    )
    persons = owners.select("person_id").distinct()
    domain = next(d for d in cdm.DOMAINS if d.name == "Condition")
    codes = rules(spark).outcome_concepts.where("concept_id = 1002")
    found = cdm.extract_domain({"condition_occurrence": view}, domain, codes, persons)
    assert found.count() == 14 and {r.concept_id for r in found.select("concept_id").distinct().collect()} == {1002}
    scans = re.findall(r"Filter ([^\n]*)\n[ :|+-]*Relation \[line#", found._jdf.queryExecution().optimizedPlan().toString())
    assert len(scans) == 1 and "1002" in scans[0]


def test_very_long_code_lists_are_left_to_the_join(spark, monkeypatch):
    table = stored_timing(spark).select("person_id", (F.lit(998) + F.month("event_date")).cast("bigint").alias("condition_concept_id"), F.col("event_date").alias("condition_start_date"))
    domain = next(d for d in cdm.DOMAINS if d.name == "Condition")
    persons = spark.range(10).select(F.col("id").alias("person_id"))
    asked = lambda: sorted(map(tuple, cdm.extract_domain({"condition_occurrence": table}, domain, rules(spark).outcome_concepts, persons).collect()), key=str)
    by_value = asked()
    monkeypatch.setattr(cdm, "MOST_LISTED", 2)
    assert by_value == asked() and len(by_value) == 30


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="test tables are not here")
def test_queries_that_read_the_registry_twice_read_stored_rows(spark, tmp_path, monkeypatch):
    folder = tmp_path / "tables"
    folder.symlink_to("/root/testdata/sf0.001")  # a path of its own: nothing stored before
    derived, passed = [], []
    derive, match = agreement.derive_registry_outcome, agreement.match_episodes
    monkeypatch.setattr(agreement, "derive_registry_outcome", lambda *a: derived.append(1) or derive(*a))
    monkeypatch.setattr(agreement, "match_episodes", lambda p, registry, days: passed.append(registry) or match(p, registry, days))
    for name in ("v4_match_by_order", "v9_validation_summary", "v4_match_stats"):
        assert QUERIES[name](spark, str(folder)).count() > 0
    assert len(derived) == 1 and len(passed) == 3
    assert not any("Join" in df._jdf.queryExecution().optimizedPlan().toString() for df in passed)
