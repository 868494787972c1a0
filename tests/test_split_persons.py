"""Operators that need a person's order, with a third of all rows on one person; joins as of a date; windows in one pass."""

import random
import re

from pyspark.sql import functions as F

from care_episodes.functions.primitives import best_point
from care_episodes.functions.scan import PART
from care_episodes.operators import agreement, outcomes, progression, study
from care_episodes.queries.study import KEY
from care_episodes.session import small_table
from tests.helpers import day, events, timing


def windows_by_person_alone(df, column="person_id") -> list[str]:
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return re.findall(rf"windowspecdefinition\({column}#\d+L?, (?!{PART})(\w+)", plan)


def test_gestation_only_episodes_of_a_heavy_person(spark):
    rng = random.Random(7)
    rows = []
    for k in range(3000):
        person = 1 if k % 3 == 0 else rng.randrange(2, 400)
        rows.append((person, "GEST", day(rng.randrange(3000 if person == 1 else 700)), None, float(rng.choice([8, 8.5, 12, 20, 30, 38, 44, 45]))))
    found = outcomes.gestation_only_episodes(outcomes.gestation_records(events(spark, rows)))
    assert "rank" not in windows_by_person_alone(found) and windows_by_person_alone(found).count(PART) == 0
    got = sorted((r.person_id, r.outcome_day, r.gestational_weeks, r.n_copies) for r in found.collect())
    want = []
    origin = (day(0) - __import__("datetime").date(1970, 1, 1)).days
    by_person = {}
    for person, _, date, _, weeks in rows:
        if weeks <= 44:
            by_person.setdefault(person, {}).setdefault(((date - day(0)).days, weeks), 0)
            by_person[person][(date - day(0)).days, weeks] += 1
    for person, counted in by_person.items():
        groups, last = [], None
        for (at, weeks), n in sorted(counted.items()):
            for copy in range(1, min(n, 3) + 1):
                starts = last is None or weeks <= last[1] or at - last[0] > 70 or at - last[0] > (weeks - last[1]) * 7 + 28
                if starts:
                    groups.append([at, weeks, 1])
                groups[-1][0], groups[-1][1] = max(groups[-1][0], at), max(groups[-1][1], weeks)
                if n > 2 and copy == 2:
                    groups[-1][2] = n - 2
                last = (at, weeks)
        want += [(person, at + origin + (40 - w) * 7, w, c) for at, w, c in groups]
    assert got == sorted(want)


def test_timing_blocks_window_over_days_only(spark):
    rows = [(1 if k % 3 == 0 else k, day(k % 900), k % 5, k % 5 + 2) for k in range(600)]
    blocks = progression.timing_blocks(timing(spark, rows))
    by_person = windows_by_person_alone(blocks)
    assert set(by_person) <= {"day", "run"} and by_person.count("day") >= 1
    assert blocks.agg(F.sum("n")).first()[0] == 600


def registry(spark, n, seed):
    rng = random.Random(seed)
    people = [(k, 1 if k % 3 == 0 else rng.randrange(2, 60)) for k in range(n)]
    counts = [(k, rng.randrange(1, 30), *(rng.choice([None, 0, 1, 2]) for _ in range(5))) for k, _ in people]
    schema = "emrn long, gravida_count int, para_count int, abortion_count int, therapeutic_count int, spontaneous_count int, ectopic_count int"
    pregnancies = spark.createDataFrame(counts, schema).withColumns({"estimated_start": F.lit(None).cast("date"), "estimated_end": F.lit(None).cast("date")})
    return people, counts, pregnancies, spark.createDataFrame(people, "emrn long, person_id long")


def test_registry_outcomes_of_a_heavy_person(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    people, counts, pregnancies, linkage = registry(spark, 900, 3)
    none = spark.createDataFrame([], "emrn long, delivery_id long, gestational_age_days int, born_alive int, living_status string")
    found = agreement.derive_registry_outcome(pregnancies, none, linkage)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(windows_by_person_alone(found)) <= {PART}
    got = {r.emrn: r.gt_outcome for r in found.collect()}
    by_emrn = {c[0]: c for c in counts}
    own = {}
    for emrn, person in people:
        own.setdefault(person, []).append(by_emrn[emrn])
    for rows in own.values():
        last = (0,) * 5
        for row in sorted(rows, key=lambda c: (c[1], c[0])):
            para, abortion, therapeutic, spontaneous, ectopic = (None if a is None or b is None else a - b for a, b in zip(row[2:], last))
            up = lambda v: v is not None and v > 0
            want = "PREG"
            if up(ectopic):
                want = "ECT"
            elif up(therapeutic):
                want = "AB"
            elif up(spontaneous):
                want = "SA"
            elif up(abortion) and therapeutic == 0 and spontaneous == 0:
                want = "AB"
            elif up(para):
                want = "DELIV"
            assert got[row[0]] == want
            last = row[2:]


def test_matching_in_order_and_patterns_of_a_heavy_person(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(5)
    rows = [(1 if k % 3 == 0 else rng.randrange(2, 90), k, rng.choice([None, 0, 1]), rng.randrange(2000)) for k in range(1500)]
    df = spark.createDataFrame(rows, "person_id long, episode_id long, flag int, at int")
    df = df.withColumn("inferred_episode_end", F.date_from_unix_date("at"))
    pattern, steps = study.exposure_pattern(df, "flag"), study.exposure_transitions(df, "flag")
    assert windows_by_person_alone(pattern) == [] and set(windows_by_person_alone(steps)) <= {PART}
    own = {}
    for person, episode, flag, at in rows:
        own.setdefault(person, []).append((at, episode, flag))
    text = {p: " → ".join("NA" if f is None else str(f) for _, _, f in sorted(x, key=lambda r: r[:2])) for p, x in own.items()}
    assert {r.person_id: r.pattern for r in pattern.collect()} == text
    want = {}
    for p, t in text.items():
        v = t.split(" → ")
        for k, (a, b) in enumerate(zip(v, v[1:])):
            want[k + 1, a, b] = want.get((k + 1, a, b), 0) + 1
    shown = lambda v: "NA" if v is None else str(v)
    assert {(r.preg_number, shown(r.from_value), shown(r.to_value)): r.n for r in steps.collect()} == want
    algo = df.select("person_id", F.col("inferred_episode_end").alias("algo_end"), F.col("episode_id").alias("algo_episode_num"))
    gt = df.where("at % 2 = 0").select("person_id", F.col("inferred_episode_end").alias("gt_end"), F.col("episode_id").alias("gt_episode_num"))
    pairs = agreement._match_in_order(algo, gt)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = set()
    for p, x in own.items():
        want |= {(p, a[1], b[1]) for a, b in zip(sorted(x, key=lambda r: r[:2]), sorted((r for r in x if r[0] % 2 == 0), key=lambda r: r[:2]))}
    assert {(r.person_id, r.algo_episode_num, r.gt_episode_num) for r in pairs.collect()} == want


def test_best_points_match_scans_and_join_few_rows(spark):
    rng = random.Random(2)
    points = sorted({(1 if k % 3 == 0 else rng.randrange(2, 40), rng.randrange(12_000), rng.randrange(50)) for k in range(3000)})
    points = list({(p, d): (p, d, v) for p, d, v in points}.values())
    rows = [(p, rng.randrange(-500, 13_000)) for p in [*range(0, 60), *[1] * 400]]
    df, at = spark.createDataFrame(points, "person_id long, day int, value int"), spark.createDataFrame(rows, "person_id long, at int")
    for side in ("before", "after"):
        inside = (lambda d, a: d <= a) if side == "before" else (lambda d, a: d >= a)
        nearest = F.struct((F.col("day") * (-1 if side == "before" else 1)).alias("order"), "day", "value")
        got = {(r["person_id"], r["at"]): r["best"] for r in best_point(at, df, ["person_id"], "at", "day", nearest, side).collect()}
        highest = F.struct((-F.col("value")).alias("order"), "day", "value")
        top = {(r["person_id"], r["at"]): r["best"] for r in best_point(at, df, ["person_id"], "at", "day", highest, side).collect()}
        assert set(got) == set(rows)
        for person, a in set(rows):
            own = [(d, v) for p, d, v in points if p == person and inside(d, a)]
            want = min(own, key=lambda x: abs(x[0] - a), default=None)
            assert (got[person, a] and (got[person, a]["day"], got[person, a]["value"])) == want
            want = min(own, key=lambda x: (-x[1], x[0]), default=None)
            assert (top[person, a] and (top[person, a]["day"], top[person, a]["value"])) == want
    # A row meets the points of its own bucket only: the join's rows don't grow with a person's history.
    bucket = 366
    listed = at.distinct().withColumn("b", F.floor(F.col("at") / bucket))
    met = listed.join(df.withColumn("b", F.floor(F.col("day") / bucket)), ["person_id", "b"]).count()
    assert met <= at.distinct().count() * bucket and met < at.distinct().join(df, "person_id").count() / 10


def test_many_windows_in_one_pass(spark):
    rng = random.Random(4)
    cohort = [(p, e, rng.randrange(1000), rng.randrange(1000, 2500)) for p in range(60) for e in range(2)]
    df = spark.createDataFrame(cohort, "person_id long, episode_id long, a int, b int").withColumns({c: F.date_from_unix_date(c) for c in "ab"})
    facts = [(1 if k % 3 == 0 else rng.randrange(60), rng.choice([10, 11, 12]), rng.randrange(3500)) for k in range(2000)]
    table = spark.createDataFrame(facts, "person_id long, condition_concept_id long, at int").withColumn("condition_start_date", F.date_from_unix_date("at"))
    concepts = small_table(spark, [("x", 10), ("y", 11), ("y", 10)], "set_name string, concept_id long")
    windows = {"x_in": ("x", "a", "b"), "y_in": ("y", "a", "b"), "y_before": ("y", None, "a"), "x_after": ("x", "b", None), "x_never": ("x", "b", "a")}
    found = study.many_set_events({"condition_occurrence": table}, concepts, {"x": ["condition"], "y": ["condition"]})
    out = study.window_summaries(df, found, windows, KEY)
    got = {(r.person_id, r.episode_id): r for r in out.collect()}
    members = {"x": {10}, "y": {10, 11}}
    for p, e, a, b in cohort:
        for name, (set_name, low, high) in windows.items():
            lo, hi = {"a": a, "b": b, None: -9999}[low], {"a": a, "b": b, None: 9999}[high]
            days = [t for q, c, t in facts if q == p and c in members[set_name] and lo <= t <= hi]
            row = got[p, e]
            assert row[f"{name}_indicator"] == int(bool(days)) and row[f"{name}_concept_count"] == (len(days) or None)
            first = row[f"{name}_date_earliest"]
            assert (first and (first - __import__("datetime").date(1970, 1, 1)).days) == (min(days) if days else None)


def test_study_reads_each_table_once(spark, tmp_path):
    """One scan per fact table for all windows of the study."""
    parts = {}
    for name in ("condition_occurrence", "visit_occurrence"):
        prefix = "condition" if name.startswith("cond") else "visit"
        path = str(tmp_path / name)
        spark.range(10).selectExpr("id AS person_id", f"id AS {prefix}_concept_id", f"date_from_unix_date(int(id)) AS {prefix}_start_date").write.parquet(path)
        parts[name] = spark.read.parquet(path)
    sets = small_table(spark, [("a", 1), ("b", 2), ("v", 3)], "set_name string, concept_id long")
    cohort = spark.createDataFrame([(1, 1)], "person_id long, episode_id long").withColumns({"s": F.lit("1960-01-01").cast("date"), "e": F.lit("1980-01-01").cast("date")})
    found = study.many_set_events(parts, sets, {"a": ["condition"], "b": ["condition"], "v": ["visit"]})
    out = study.window_summaries(cohort, found, {n: (n, "s", "e") for n in "abv"}, KEY)
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    for column in ("condition_concept_id", "visit_concept_id"):
        assert len(re.findall(rf"FileScan parquet \[[^\]]*{column}", plan)) == 1
    assert out.first()["a_indicator"] == 1
