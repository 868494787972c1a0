"""Readers, writers, contracts and code lists."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from care_episodes.config import EpisodeConfig
from care_episodes.functions import dates, rules as r
from care_episodes.functions.fixed_values import SPACING, TIMING_CONCEPTS
from care_episodes.functions.rules import Rules
from care_episodes.operators import dating, merge, regression, report, stats
from care_episodes.session import materialize, small_table
from care_episodes.sources import cdm, rule_files, sinks
from tests.helpers import CONFIG, d, episodes, events, rules


def write(path, text):
    path.write_text(text)
    return str(path)


def test_outcome_concepts(spark, tmp_path):
    path = write(tmp_path / "o.csv", "concept_id,concept_name,domain,category,gest_value\n"
                 '1,"Birth, live",Condition,LB,NA\n1,again,Condition,SB,\n2,week,Observation,GEST,25\n')
    with pytest.warns(UserWarning, match="GEST"):
        out = rule_files.load_outcome_concepts(spark, path)
    assert [tuple(x) for x in out.orderBy("concept_id").collect()] == [
        (1, "Birth, live", "Condition", "LB", None), (2, "week", "Observation", "GEST", 25.0),
    ]
    with pytest.raises(ValueError, match="category"):
        rule_files.load_outcome_concepts(spark, write(tmp_path / "bad.csv", "concept_id,concept_name\n1,a\n"))


def test_timing_concepts(spark, tmp_path):
    path = write(tmp_path / "t.csv", "domain_concept_name,domain_concept_id,min_month,max_month\n"
                 "a,1,3.75,5.5\nb,2,-1,4\nc,3,9,13\nd,4,5,4\na again,1,1,2\n")
    out = rule_files.load_timing_concepts(spark, path).collect()
    assert [tuple(x) for x in out] == [(1, "a", 3.75, 5.5, "Medium")]
    assert rule_files.load_timing_concepts(spark).count() == len(TIMING_CONCEPTS) == 76


def test_rule_tables(spark, tmp_path):
    assert rule_files.load_term_limits(spark, str(tmp_path / "none.csv")).count() == 7
    own = write(tmp_path / "l.csv", "category,min_term,max_term\nSB,1,2\nLB,3,4\n")
    got = rule_files.load_term_limits(spark, own).collect()
    assert [tuple(x) for x in got] == [("SB", 1, 2, 1), ("LB", 3, 4, 2)]
    spacing = write(tmp_path / "s.csv", "first_preg_category,outcome_preg_category,min_days\nLB,SB,168\n")
    assert rule_files.load_term_limits(spark, spacing).first().min_days == 168
    assert r.spacing_literals(rule_files.load_spacing(spark, spacing)) == {("LB", "SB"): 168}
    assert len(r.SPACING) == len(SPACING) == 36
    outcomes = write(tmp_path / "o.csv", "concept_id,concept_name,category\n1,a,LB\n")
    bundle = rule_files.load_rules(spark, outcomes, spacing_path=spacing)
    assert (bundle.spacing, bundle.max_term["ECT"]) == ({("LB", "SB"): 168}, 84)
    assert rule_files.rules_summary(bundle).first().timing_concepts == 76
    assert bundle.timing_span_days() == 360
    assert rule_files.load_term_durations(spark, str(tmp_path / "none.csv")).count() == 6
    durations = write(tmp_path / "d.csv", "category,max_term,min_term,retry\nSA,139,28,14\n")
    assert tuple(rule_files.load_term_durations(spark, durations).first()) == ("SA", 139, 28, 14)


def test_concept_set_folder(spark, tmp_path):
    write(tmp_path / "a.csv", '"","Id","Code","Name","Domain","Ancestors"\n'
          '"","11","x","say ""hi"", twice","Condition","$p[1], tip: ""q"">1"\n')
    write(tmp_path / "b.csv", '"","concept_id_1","concept_id_2","domain_id"\n"1",5,22,"Condition"\n"2",6,22,"Condition"\n')
    write(tmp_path / "c.csv", '"","ancestor_concept_id","descendant_concept_id"\n"1",3,33\n')
    got = rule_files.load_concept_set_folder(spark, str(tmp_path)).orderBy("set_name").collect()
    assert [tuple(x) for x in got] == [("a", 11, "Condition"), ("b", 22, "Condition"), ("c", 33, None)]


def test_coverage(spark):
    complete = small_table(
        spark, [(i, c, x) for i, (c, x) in enumerate(
            zip(("LB", "SB", "DELIV", "ECT", "AB", "SA", "PREG"), ("Condition", "Procedure", "Observation", "Measurement") * 2))],
        "concept_id long, category string, domain_name string",
    )
    timing = small_table(spark, [(0, 1.0, 6.0), (99, 6.0, 9.0)], "concept_id long, min_month double, max_month double")
    full = rule_files.check_concept_coverage(complete, timing)
    assert rule_files.coverage_is_valid(full) and [tuple(x) for x in full.collect()] == [("overlap", "0")]
    poor = rule_files.check_concept_coverage(complete.filter("category <> 'LB'"), timing.filter("concept_id = 0"))
    assert not rule_files.coverage_is_valid(poor)
    assert {tuple(x) for x in poor.collect()} == {("missing_category", "LB"), ("uncovered_stage", "late")}


def test_enrich_domains(spark):
    concepts = small_table(spark, [(1, "a", None), (2, "b", "Drug"), (3, "c", None)], "concept_id long, concept_name string, domain_name string")
    vocabulary = small_table(spark, [(1, "Condition"), (2, "Device")], "concept_id long, domain_id string")
    out = rule_files.enrich_domains(concepts, vocabulary)
    assert {x.concept_id: x.domain_name for x in out.collect()} == {1: "Condition", 2: "Drug", 3: None}
    assert [x.concept_id for x in rule_files.unmapped_concepts(out).collect()] == [3]


def test_read_cdm_formats(spark, tmp_path):
    df = small_table(spark, [(1, 8532)], "person_id long, gender_concept_id int")
    df.write.parquet(f"{tmp_path}/person")
    df.write.option("header", True).csv(f"{tmp_path}/person.csv")
    assert cdm.read_cdm(spark, str(tmp_path), ("person",))["person"].first() == (1, 8532)
    assert cdm.read_cdm(spark, str(tmp_path), ("person",), fmt="csv")["person"].first().person_id == "1"
    df.createOrReplaceTempView("person")
    spark.sql("CREATE DATABASE IF NOT EXISTS clinic")
    df.write.mode("overwrite").option("path", f"{tmp_path}/table").saveAsTable("clinic.person")
    assert cdm.read_cdm(spark, "clinic", ("person",), fmt="table")["person"].count() == 1


def test_contract(spark):
    df = small_table(spark, [(1, "x")], "a long, b string")
    with pytest.raises(ValueError, match="c"):
        cdm.check_contract(df, {"c": "int"})
    with pytest.warns(UserWarning, match="a: bigint instead of int"):
        assert cdm.check_contract(df, {"a": "int", "b": "string"}) == ["a: bigint instead of int"]


def test_date_parsing(spark):
    text = small_table(spark, [("2001-02-03",), ("02/28/2001",), ("28/02/2001",), ("20010203",), ("?",), (None,)], "x string")
    got = [x[0] for x in dates.parse_dates(text, "x").collect()]
    assert got == [d("2001-02-03"), d("2001-02-28"), d("2001-02-28"), d("2001-02-03"), None, None]
    excel = small_table(spark, [(36526,), (None,)], "x int")
    assert dates.parse_dates(excel, "x").first()[0] == d("2000-01-01")
    seconds = small_table(spark, [(946684800,), (0,)], "x long")
    assert [x[0] for x in dates.parse_dates(seconds, "x").collect()] == [d("2000-01-01"), d("1970-01-01")]


def test_defaults_of_persons(spark):
    raw = small_table(spark, [("7", "8532", "1980", None, None, None, None)],
                      "PERSON_ID string, gender_concept_id string, year_of_birth string, month_of_birth string, "
                      "day_of_birth string, race_concept_id string, ethnicity_concept_id string")
    assert tuple(cdm.enforce_types(raw, "person").first()) == (7, 8532, 1980, 1, 1, 0, 0)


def test_writing(spark, tmp_path):
    eps = episodes(spark, [(1, 1, "2001-01-01", "2001-10-01", "LB", 273)])
    for _ in range(2):
        sinks.write_episodes(eps, dt.date(2020, 1, 2), path=f"{tmp_path}/out", runtime_seconds=1.5)
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 2
    assert (back.first().analysis_date, back.first().analysis_version, back.first().runtime_seconds) == (
        dt.date(2020, 1, 2), "2.0.0", 1.5,
    )
    with pytest.raises(ValueError):
        sinks.write_episodes(eps, dt.date(2020, 1, 2))
    paths = sinks.export_for_analysis(eps, str(tmp_path), dt.date(2020, 1, 2))
    assert paths == [f"{tmp_path}/pregnancy_analysis_20200102_csv"]
    assert spark.read.csv(paths[0], header=True).count() == 1
    summaries = sinks.write_summary(eps, str(tmp_path), dt.date(2020, 1, 2))
    assert spark.read.csv(summaries[0], header=True).first().total_episodes == "1"
    assert sinks.to_cohort(eps, 3).columns == ["subject_id", "cohort_start_date", "cohort_end_date", "cohort_definition_id"]


def test_stored_copy_keeps_schema_and_rows(spark):
    df = small_table(spark, [(1, None, d("2001-01-01")), (2, 0.5, None)], "a long, b double, c date")
    stored = materialize(df)
    assert stored.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(tuple, stored.collect()))[0] == (1, None, d("2001-01-01"))


def test_bounds_and_simple_dates(spark):
    eps = episodes(spark, [
        (1, 1, "2001-11-01", "2001-10-01", "LB", 10), (2, 1, "2000-01-01", "2001-10-01", "LB", 10),
        (3, 1, "2001-05-01", "2001-10-01", "LB", 10),
    ])
    got = {x.person_id: x.episode_start_date for x in dating.bound_refined_dates(eps).collect()}
    assert got == {1: d("2000-12-25"), 2: d("2000-12-25"), 3: d("2001-05-01")}
    none = eps.withColumn("gestational_age_days", F.lit(None).cast("double"))
    assert dating.simple_start_dates(none).first().episode_start_date == d("2000-12-25")


def test_merge_paths(spark):
    h = episodes(spark, [(1, 1, "2001-01-01", "2001-10-01", "LB", 273)])
    p = episodes(spark, [(1, 1, "2005-02-01", "2005-09-15", "AB", 226)], "PPS")
    found = events(spark, [(1, "SB", "2005-09-10")]).select(
        "person_id", F.unix_date("event_date").alias("outcome_day"), F.lit(2).alias("outcome_rank"),
        F.col("category").alias("found"),
    )
    apart = merge.merge_episodes(h, p, found).orderBy("episode_number").collect()
    assert [(x.algorithm_used, x.outcome_category, x.episode_end_date) for x in apart] == [
        ("HIP", "LB", d("2001-10-01")), ("PPS", "SB", d("2005-09-10")),
    ]
    only = merge.merge_episodes(h.filter("false"), p, found).collect()
    assert [(x.algorithm_used, x.PPS_flag, x.HIP_outcome_category) for x in only] == [("PPS", 1, None)]


def test_lookups(spark):
    df = small_table(spark, [("SB", "SB", 120), ("LB", "XX", 120), ("XX", "LB", 400)], "a string, b string, g int")
    got = df.select(
        r.min_days_between(F.col("a"), F.col("b")), r.is_valid_ga(F.col("g"), F.col("a"))
    ).collect()
    assert [tuple(x) for x in got] == [(70, False), (28, False), (28, False)]


def test_summaries(spark):
    eps = episodes(spark, [(1, 1, "2001-01-01", "2001-10-01", "LB", 273), (1, 2, "2003-01-01", "2003-10-01", "AB", 100)])
    tables = report.episode_summary(eps)
    assert tuple(tables["overall"].first()) == (2, 1, 2.0)
    assert {x.outcome_category: x.pct for x in tables["by_outcome"].collect()} == {"LB": 50.0, "AB": 50.0}
    assert report.persons_overview(eps).first().max_episodes == 2


def test_fractional_months_on_request(spark):
    concepts = rules(spark)
    tables = {
        "condition_occurrence": small_table(spark, [(1, 2004, d("2001-01-01"))], "person_id long, condition_concept_id long, condition_start_date date"),
        "procedure_occurrence": small_table(spark, [], "person_id long, procedure_concept_id long, procedure_date date"),
        "observation": small_table(spark, [], "person_id long, observation_concept_id long, observation_date date, value_as_number double, value_as_string string"),
        "measurement": small_table(spark, [(1, 2004, d("2001-01-02"), 1.0, 2)], "person_id long, measurement_concept_id long, measurement_date date, value_as_number double, value_as_concept_id long"),
    }
    persons = small_table(spark, [(1,)], "person_id long")
    cut = cdm.extract_timing(tables, concepts, persons, CONFIG).collect()
    assert [(x.min_month, x.max_month) for x in cut] == [(3.0, 5.0)]
    exact = cdm.extract_timing(tables, concepts, persons, EpisodeConfig(fractional_months=True, timing_from_measurement=True))
    assert sorted((x.domain_name, x.min_month) for x in exact.collect()) == [("Condition", 3.75), ("Measurement", 3.75)]


class _StandInReader:
    """Records what a database reader is asked for."""

    def __init__(self, log):
        self.log, self.asked = log, {}

    def format(self, name):
        self.asked["format"] = name
        return self

    def option(self, name, value):
        return self.options(**{name: value})

    def options(self, **more):
        self.asked |= more
        return self

    def load(self):
        if {"query", "dbtable"} <= set(self.asked):
            raise ValueError("both query and dbtable")
        self.log.append(self.asked)
        return self

    def first(self):
        return 1, 90


class _StandInSession:
    def __init__(self):
        self.log = []

    @property
    def read(self):
        return _StandInReader(self.log)


def test_database_tables_get_a_reader_each():
    session = _StandInSession()
    found = cdm.read_cdm(session, "jdbc:x", tables=("person", "concept"), fmt="jdbc", jdbc={"schema": "s", "user": "u"}, partitions=4)
    bounds, person, concept = session.log
    assert "query" in bounds and "dbtable" not in bounds
    assert person["dbtable"] == "s.person" and person["partitionColumn"] == "person_id" and person["upperBound"] == 91
    assert concept["dbtable"] == "s.concept" and "partitionColumn" not in concept and "query" not in concept
    assert set(found) == {"person", "concept"} and all(x["user"] == "u" for x in session.log)


def test_timing_span_uses_the_months_of_the_records(spark):
    timing = spark.createDataFrame([(1, "a", 3.75, 4.0, "Medium"), (2, "b", 9.0, 9.0, "Medium")], "concept_id long, concept_name string, min_month double, max_month double, certainty string")
    bundle = Rules(outcome_concepts=timing.limit(0), timing_concepts=timing)
    assert bundle.timing_span_days() == 240 and bundle.timing_span_days(fractional_months=True) == 218


def test_unknown_categories_are_counted(spark):
    rows = [(k, "x", f"category {k % 30}") for k in range(60)]
    concepts = rule_files.clean_outcome_concepts(spark.createDataFrame(rows, "concept_id long, concept_name string, category string").withColumn("domain_name", F.lit("Condition")))
    assert {r["concepts"] for r in rule_files.unknown_categories(concepts).collect()} == {2}
    assert rule_files.unknown_categories(concepts).count() == 30


def test_two_digit_years(spark):
    df = spark.createDataFrame([("01-02-03",), ("70-02-03",), ("2001/2/3",), ("02-03-2001",)], "d string")
    assert [str(r["d"]) for r in dates.parse_dates(df, "d").collect()] == ["2001-02-03", "1970-02-03", "2001-02-03", "2001-02-03"]


def test_rate_limits_of_many_rows_and_no_convergence(spark):
    rates = spark.range(20_000).selectExpr("id", "id % 7 AS events", "CAST(id % 3 AS double) AS person_years")
    found = stats.incidence_rate_ci(rates).where("person_years > 0 AND events = 0").agg(F.min("rate_low"), F.count("*")).first()
    assert found[0] == 0 and found[1] > 1000
    separated = spark.createDataFrame([(x, int(x > 5)) for x in range(10)], "x int, y int")
    with pytest.raises((RuntimeError, ValueError)):
        regression.logistic_or(separated, "y", ["x"], max_steps=5)
