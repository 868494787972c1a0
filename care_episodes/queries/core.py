"""Queries for extraction, episode building, merge, dating and summaries."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from care_episodes import testmap as tm
from care_episodes.functions import dates, rules as rule_functions
from care_episodes.functions.fixed_values import TERM_LIMITS
from care_episodes.functions.rules import default_spacing, default_term_limits
from care_episodes.operators import dating, merge, outcomes, progression, report
from care_episodes.plans import pipeline
from care_episodes.queries.base import r6, register, stages
from care_episodes.session import materialize, shared_folder
from care_episodes.sources import cdm, rule_files, sinks

CONFIG = tm.CONFIG


def lists_from_parts(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Raw code lists with repeated and invalid rows, as a user's files may hold them."""
    (part,) = tm.read(spark, sf_dir, "part")
    key, size = F.col("p_partkey"), F.col("p_size")
    category = F.element_at(F.array(*[F.lit(c) for c in ("LB", "SB", "DELIV", "ECT", "AB", "SA")]), (size % 6 + 1).cast("int"))
    domain = F.element_at(F.array(*[F.lit(c) for c in ("Condition", "Procedure", "Observation")]), (size % 3 + 1).cast("int"))
    raw_outcomes = part.select(
        (key % 700).alias("concept_id"), F.col("p_name").alias("concept_name"), domain.alias("domain"),
        category.alias("category"), F.when(size % 5 == 0, size.cast("string")).alias("gest_value"),
        key.alias("_row"),
    )
    raw_timing = part.select(
        (key % 900 + 400).alias("domain_concept_id"), F.col("p_name").alias("domain_concept_name"),
        (size % 14 - 1).alias("min_month"), (size % 15).alias("max_month"), key.alias("_row"),
    )
    return raw_outcomes, raw_timing


PART_OUTCOMES = """(SELECT p_partkey % 700 concept_id, p_name concept_name,
  CASE p_size % 3 WHEN 0 THEN 'Condition' WHEN 1 THEN 'Procedure' ELSE 'Observation' END domain_name,
  CASE p_size % 6 WHEN 0 THEN 'LB' WHEN 1 THEN 'SB' WHEN 2 THEN 'DELIV' WHEN 3 THEN 'ECT' WHEN 4 THEN 'AB' ELSE 'SA' END category,
  CASE WHEN p_size % 5 = 0 THEN p_size::DOUBLE END gest_value
  FROM part QUALIFY row_number() OVER (PARTITION BY p_partkey % 700 ORDER BY p_partkey) = 1)"""
PART_TIMING = """(SELECT p_partkey % 900 + 400 concept_id, p_name concept_name, (p_size % 14 - 1)::DOUBLE min_month,
  (p_size % 15)::DOUBLE max_month FROM part
  WHERE p_size % 14 - 1 >= 0 AND p_size % 15 <= 12 AND p_size % 14 - 1 <= p_size % 15
  QUALIFY row_number() OVER (PARTITION BY p_partkey % 900 + 400 ORDER BY p_partkey) = 1)"""


# ---- sources, sinks, contracts --------------------------------------------------------------
@register(
    "s1_read_cdm",
    """SELECT 'person' AS table_name, count(*) n_rows, count(DISTINCT person_id) n_persons FROM person
UNION ALL SELECT 'condition_occurrence', count(*), count(DISTINCT person_id) FROM condition_occurrence
UNION ALL SELECT 'procedure_occurrence', count(*), count(DISTINCT person_id) FROM procedure_occurrence
UNION ALL SELECT 'observation', count(*), count(DISTINCT person_id) FROM observation
UNION ALL SELECT 'measurement', count(*), count(DISTINCT person_id) FROM measurement
UNION ALL SELECT 'observation_period', count(*), count(DISTINCT person_id) FROM observation_period
UNION ALL SELECT 'visit_occurrence', count(*), count(DISTINCT person_id) FROM visit_occurrence""",
)
def s1_read_cdm(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = ("person", "condition_occurrence", "procedure_occurrence", "observation", "measurement",
             "observation_period", "visit_occurrence")
    folder = f"{shared_folder(spark)}/cdm-{uuid.uuid4().hex}"
    for name, table in tm.tables(spark, sf_dir).items():
        if name in names:
            table.write.parquet(f"{folder}/{name}")
    out = None
    for name, table in cdm.read_cdm(spark, folder, names).items():
        part = table.agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"),
            F.count_distinct("person_id").alias("n_persons"),
        )
        out = part if out is None else out.unionByName(part)
    return out


@register("s2_load_outcome_concepts", f"SELECT * FROM {PART_OUTCOMES}")
def s2_load_outcome_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_files.clean_outcome_concepts(lists_from_parts(spark, sf_dir)[0])


@register("s3_load_timing_concepts", f"SELECT *, 'Medium' AS certainty FROM {PART_TIMING}")
def s3_load_timing_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_files.clean_timing_concepts(lists_from_parts(spark, sf_dir)[1])


_TERMS = ", ".join(f"('{c}', {lo}, {hi}, {h})" for c, lo, hi, h in TERM_LIMITS)
_STUDY = "study_eps"


@register(
    "s4_load_term_limits",
    f"""SELECT t.category, t.min_term, t.max_term, t.hierarchy, count(e.person_id) episodes,
  count(e.person_id) FILTER (e.gestational_age_days BETWEEN t.min_term AND t.max_term) in_term
FROM (VALUES {_TERMS}) AS t(category, min_term, max_term, hierarchy)
LEFT JOIN study_eps e ON e.final_outcome_category = t.category GROUP BY ALL""",
)
def s4_load_term_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    limits = rule_files.load_term_limits(spark)
    episodes = tm.study_episodes(spark, sf_dir)
    in_term = F.col("gestational_age_days").between(F.col("min_term"), F.col("max_term"))
    return (
        limits.join(episodes, F.col("category") == F.col("final_outcome_category"), "left")
        .groupBy("category", "min_term", "max_term", "hierarchy")
        .agg(F.count("person_id").alias("episodes"), F.count_if(in_term).alias("in_term"))
    )


@register(
    "s5_load_spacing",
    """SELECT first_preg_category, outcome_preg_category, min_days, count(*) followed,
  count(*) FILTER (gap >= min_days) far_enough FROM (
  SELECT *, lead(final_outcome_category) OVER w next_category, lead(inferred_episode_end) OVER w - inferred_episode_end gap
  FROM study_eps WINDOW w AS (PARTITION BY person_id ORDER BY inferred_episode_end, episode_id)) e
JOIN spacing_rules s ON s.first_preg_category = e.final_outcome_category AND s.outcome_preg_category = e.next_category
GROUP BY ALL""",
)
def s5_load_spacing(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("person_id").orderBy("inferred_episode_end", "episode_id")
    pairs = tm.study_episodes(spark, sf_dir).select(
        F.col("final_outcome_category").alias("first_preg_category"),
        F.lead("final_outcome_category").over(order).alias("outcome_preg_category"),
        F.datediff(F.lead("inferred_episode_end").over(order), "inferred_episode_end").alias("gap"),
    )
    rules = rule_files.load_spacing(spark)
    return (
        pairs.join(rules, ["first_preg_category", "outcome_preg_category"])
        .groupBy("first_preg_category", "outcome_preg_category", "min_days")
        .agg(F.count(F.lit(1)).alias("followed"), F.count_if(F.col("gap") >= F.col("min_days")).alias("far_enough"))
    )


@register(
    "s6_rule_bundle",
    f"""SELECT (SELECT count(*) FROM {PART_OUTCOMES}) outcome_concepts,
  (SELECT count(DISTINCT category) FROM {PART_OUTCOMES}) outcome_categories,
  (SELECT count(DISTINCT domain_name) FROM {PART_OUTCOMES}) outcome_domains,
  (SELECT count(*) FROM {PART_TIMING}) timing_concepts, 7::BIGINT term_categories, 36::BIGINT spacing_pairs""",
)
def s6_rule_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_outcomes, raw_timing = lists_from_parts(spark, sf_dir)
    rules = rule_functions.Rules(
        outcome_concepts=rule_files.clean_outcome_concepts(raw_outcomes),
        timing_concepts=rule_files.clean_timing_concepts(raw_timing),
        spacing=rule_functions.spacing_literals(default_spacing(spark)),
        max_term=rule_functions.max_term_literals(default_term_limits(spark)),
    )
    return rule_files.rules_summary(rules)


@register(
    "s7_load_concept_sets",
    """SELECT 'browser' AS set_name, concept_id, domain_id AS domain FROM concept WHERE vocabulary_id = 'SNOMED'
UNION SELECT 'mapped', r.concept_id_2, c.domain_id FROM concept_relationship r JOIN concept c ON c.concept_id = r.concept_id_2
  WHERE relationship_id = 'Maps to'
UNION SELECT 'descendants', descendant_concept_id, NULL FROM concept_ancestor""",
)
def s7_load_concept_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes the three file layouts and loads them as one table."""
    t = tm.tables(spark, sf_dir)
    folder = f"{shared_folder(spark)}/sets-{uuid.uuid4().hex}"
    browser = t["concept"].filter("vocabulary_id = 'SNOMED'").select(
        F.col("concept_id").alias("Id"), F.col("concept_code").alias("Code"),
        F.concat_ws("", F.lit('a "quoted", name '), "concept_name").alias("Name"), F.col("domain_id").alias("Domain"),
        F.lit('$parents[1], tooltip: "x"">1').alias("Ancestors"),
    )
    mapped = (
        t["concept_relationship"].filter("relationship_id = 'Maps to'")
        .join(t["concept"], F.col("concept_id_2") == F.col("concept_id")).select("concept_id_1", "concept_id_2", "domain_id")
    )
    frames = {"browser": browser, "mapped": mapped, "descendants": t["concept_ancestor"]}
    for name, frame in frames.items():
        frame.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}")
    return rule_files.load_concept_sets(spark, {name: f"{folder}/{name}" for name in frames})


_FINAL_SHORT = "person_id, episode_number, episode_start_date, episode_end_date, outcome_category, round(gestational_age_days, 6) gestational_age_days, algorithm_used"


def _short(df: DataFrame) -> DataFrame:
    return df.select(
        "person_id", "episode_number", "episode_start_date", "episode_end_date", "outcome_category",
        r6("gestational_age_days"), "algorithm_used",
    )


@register(
    "s8_write_episodes",
    f"SELECT {_FINAL_SHORT}, DATE '{tm.AS_OF}' analysis_date, '2.0.0' analysis_version FROM hip",
)
def s8_write_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{shared_folder(spark)}/episodes-{uuid.uuid4().hex}"
    sinks.write_episodes(_short(stages(spark, sf_dir).hip), tm.AS_OF, path=path)
    return spark.read.parquet(path)


@register("s9_export_for_analysis", f"SELECT {_FINAL_SHORT} FROM hip")
def s9_export_for_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = _short(stages(spark, sf_dir).hip)
    folder = f"{shared_folder(spark)}/export-{uuid.uuid4().hex}"
    path, _ = sinks.export_for_analysis(episodes, folder, tm.AS_OF, ("csv", "parquet"))
    return spark.read.csv(path, header=True, schema=episodes.schema)


@register(
    "s10_to_cohort",
    """SELECT person_id subject_id, episode_start_date cohort_start_date, episode_end_date cohort_end_date,
  7 AS cohort_definition_id FROM hip""",
)
def s10_to_cohort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sinks.to_cohort(stages(spark, sf_dir).hip, 7)


@register(
    "s11_enforce_types",
    """SELECT 'person' AS domain, person_id, coalesce(month_of_birth, 1) a, coalesce(race_concept_id, 0) b,
  coalesce(ethnicity_concept_id, 0) c, NULL::DATE d FROM person
UNION ALL SELECT 'condition', person_id, condition_concept_id::INT, NULL, NULL, condition_start_date FROM condition_occurrence""",
)
def s11_enforce_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Everything arrives as upper-case named strings, as some databases deliver it."""
    t = tm.tables(spark, sf_dir)
    person = t["person"].select(*[F.col(c).cast("string").alias(c.upper()) for c in t["person"].columns])
    events = t["condition_occurrence"].select(
        F.col("person_id").cast("string").alias("PERSON_ID"),
        F.col("condition_concept_id").cast("string").alias("CONCEPT_ID"),
        F.col("condition_start_date").cast("string").alias("EVENT_DATE"),
        *[F.lit(None).cast("string").alias(c.upper()) for c in
          ("concept_name", "category", "gest_value", "value_as_number", "value_as_string")],
    )
    p = cdm.enforce_types(person, "person")
    e = cdm.enforce_types(events, "condition")
    none = F.lit(None)
    return p.select(
        F.lit("person").alias("domain"), "person_id", F.col("month_of_birth").alias("a"),
        F.col("race_concept_id").alias("b"), F.col("ethnicity_concept_id").alias("c"), none.cast("date").alias("d"),
    ).unionByName(
        e.select(
            F.lit("condition").alias("domain"), "person_id", F.col("concept_id").cast("int").alias("a"),
            none.cast("int").alias("b"), none.cast("int").alias("c"), F.col("event_date").alias("d"),
        )
    )


@register(
    "s12_parse_dates",
    """SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_orderdate::DATE WHEN 1 THEN o_orderdate::DATE
  WHEN 2 THEN CASE WHEN day(o_orderdate) <= 12 THEN make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) ELSE o_orderdate::DATE END
  END text_date, o_orderdate::DATE excel_date, o_orderdate::DATE unix_date FROM orders""",
)
def s12_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates as text in three notations (and junk), as spreadsheet days and as unix seconds."""
    (orders,) = tm.read(spark, sf_dir, "orders")
    day, kind = tm.day("o_orderdate"), F.col("o_orderkey") % 4
    text = (
        F.when(kind == 0, F.date_format(day, "yyyy-MM-dd"))
        .when(kind == 1, F.date_format(day, "MM/dd/yyyy"))
        .when(kind == 2, F.date_format(day, "dd/MM/yyyy"))
        .otherwise("unknown")
    )
    df = orders.select(
        "o_orderkey", text.alias("text_date"),
        (F.unix_date(day) + 25569).cast("double").alias("excel_date"),
        (F.unix_date(day).cast("bigint") * 86400).alias("unix_date"),
    )
    for name in ("text_date", "excel_date", "unix_date"):
        df = dates.parse_dates(df, name)
    return df


@register("s12_parse_dates_by_column", "SELECT o_orderkey, o_orderdate::DATE day_first, CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate::DATE END month_first FROM orders")
def s12_parse_dates_by_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two columns of text, each with one order of day and month for all its values."""
    (orders,) = tm.read(spark, sf_dir, "orders")
    day, even = tm.day("o_orderdate"), F.col("o_orderkey") % 2 == 0
    df = orders.select("o_orderkey", F.date_format(day, "dd/MM/yyyy").alias("day_first"), F.when(even, F.date_format(day, "MM.dd.yyyy")).alias("month_first"))
    for name in ("day_first", "month_first"):
        df = dates.parse_dates(df, name, one_order=True)
    return df


@register(
    "s13_check_contract",
    """SELECT 'c_custkey: bigint instead of int' AS problem, count(*) n_rows FROM customer
UNION ALL SELECT 'c_nationkey: int instead of string', count(*) FROM customer""",
)
def s13_check_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    import warnings

    (customer,) = tm.read(spark, sf_dir, "customer")
    required = {"c_custkey": "int", "c_nationkey": "string", "c_acctbal": "double"}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        problems = cdm.check_contract(customer, required)
    return customer.select(F.explode(F.array(*[F.lit(p) for p in problems])).alias("problem")).groupBy(
        "problem"
    ).agg(F.count(F.lit(1)).alias("n_rows"))


@register(
    "s14_check_concept_coverage",
    f"""SELECT 'missing_category' AS issue, c AS value FROM (VALUES ('LB'), ('SB'), ('DELIV'), ('ECT'), ('AB'), ('SA'), ('PREG')) t(c)
  WHERE c NOT IN (SELECT category FROM {PART_OUTCOMES})
UNION ALL SELECT 'missing_domain', c FROM (VALUES ('Condition'), ('Procedure'), ('Observation'), ('Measurement')) t(c)
  WHERE c NOT IN (SELECT domain_name FROM {PART_OUTCOMES})
UNION ALL SELECT 'uncovered_stage', 'early' FROM {PART_TIMING} HAVING NOT bool_or(min_month <= 3)
UNION ALL SELECT 'uncovered_stage', 'mid' FROM {PART_TIMING} HAVING NOT bool_or(min_month <= 6 AND max_month >= 6)
UNION ALL SELECT 'uncovered_stage', 'late' FROM {PART_TIMING} HAVING NOT bool_or(max_month >= 9)
UNION ALL SELECT 'overlap', concept_id::VARCHAR FROM {PART_OUTCOMES} WHERE concept_id IN (SELECT concept_id FROM {PART_TIMING})""",
)
def s14_check_concept_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw_outcomes, raw_timing = lists_from_parts(spark, sf_dir)
    return rule_files.check_concept_coverage(
        rule_files.clean_outcome_concepts(raw_outcomes), rule_files.clean_timing_concepts(raw_timing)
    )


_HALF_KNOWN = "(SELECT concept_id, concept_name, CASE WHEN concept_id % 2 = 0 THEN domain_name END domain_name FROM {0})"


@register(
    "s15_enrich_domains",
    f"""SELECT o.concept_id, o.concept_name, coalesce(o.domain_name, c.domain_id) domain_name,
  coalesce(o.domain_name, c.domain_id) IS NULL unmapped
FROM (SELECT * REPLACE (CASE WHEN concept_id % 5 = 0 THEN concept_id + 10000000 ELSE concept_id END AS concept_id)
  FROM {_HALF_KNOWN.format(PART_OUTCOMES)}) o LEFT JOIN concept c USING (concept_id)""",
)
def s15_enrich_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("concept_id")
    concepts = rule_files.clean_outcome_concepts(lists_from_parts(spark, sf_dir)[0]).select(
        F.when(key % 5 == 0, key + 10_000_000).otherwise(key).alias("concept_id"),  # ids the vocabulary lacks
        "concept_name",
        F.when(key % 2 == 0, F.col("domain_name")).alias("domain_name"),
    )
    enriched = rule_files.enrich_domains(concepts, tm.concept(spark, sf_dir))
    unmapped = rule_files.unmapped_concepts(enriched).select("concept_id", F.lit(True).alias("unmapped"))
    return enriched.join(unmapped, "concept_id", "left").fillna(False, ["unmapped"])


# ---- projection, filter, extraction ---------------------------------------------------------
@register("p1_select_persons", "SELECT * FROM persons")
def p1_select_persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdm.select_persons(tm.person(spark, sf_dir), CONFIG)


_EVENT_COLUMNS = "person_id, concept_id, event_date, domain, concept_name, category, gest_value, value_as_number, value_as_string"


@register("p2_extract_domain", f"SELECT {_EVENT_COLUMNS} FROM ev WHERE domain = 'Measurement'")
def p2_extract_domain(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, rules = tm.tables(spark, sf_dir), tm.rules(spark)
    return cdm.extract_domain(t, cdm.DOMAINS[3], rules.outcome_concepts, cdm.select_persons(t["person"], CONFIG))


@register(
    "p3_extract_by_ids",
    """SELECT e.person_id, e.concept_id, e.event_date, e.domain, c.concept_name, c.category, c.gest_value, e.value_as_number, e.value_as_string
FROM source_events e JOIN outcome_concepts c ON e.concept_id = c.concept_id AND e.domain = c.domain_name
WHERE e.domain = 'Condition' AND e.person_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""",
)
def p3_extract_by_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, rules = tm.tables(spark, sf_dir), tm.rules(spark)
    (customer,) = tm.read(spark, sf_dir, "customer")
    ids = customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("person_id"))
    return cdm.extract_by_ids(t, cdm.DOMAINS[0], rules.outcome_concepts, ids)


@register("p4_extract_timing", "SELECT * FROM timing")
def p4_extract_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, rules = tm.tables(spark, sf_dir), tm.rules(spark)
    return cdm.extract_timing(t, rules, cdm.select_persons(t["person"], CONFIG), CONFIG)


@register(
    "p5_split_concepts",
    f"SELECT domain_name, category, count(*) concepts FROM {PART_OUTCOMES} GROUP BY 1, 2",
)
def p5_split_concepts(spark: SparkSession, sf_dir: str) -> DataFrame:
    concepts = rule_files.clean_outcome_concepts(lists_from_parts(spark, sf_dir)[0])
    out = None
    for domain in cdm.DOMAINS:
        part = rule_functions.concepts_of_domain(concepts, domain.name)
        counts = part.groupBy("domain_name", "category").agg(F.count(F.lit(1)).alias("concepts"))
        out = counts if out is None else out.unionByName(counts)
    return out


@register("p6_union_domains", f"SELECT {_EVENT_COLUMNS} FROM ev")
def p6_union_domains(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, rules = tm.tables(spark, sf_dir), tm.rules(spark)
    return cdm.union_domains(t, rules, cdm.select_persons(t["person"], CONFIG))


@register(
    "p6_extract_raw_list",
    """SELECT e.person_id, e.concept_id, e.event_date, e.domain, o.concept_name, o.category, o.gest_value, e.value_as_number, e.value_as_string
FROM source_events e JOIN outcome_concepts o ON e.concept_id = o.concept_id JOIN concept c ON o.concept_id = c.concept_id AND e.domain = c.domain_id
WHERE e.person_id IN (SELECT person_id FROM persons)""",
)
def p6_extract_raw_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A code list without domains: the vocabulary fills them in before extraction."""
    rules = tm.rules(spark)
    raw = rules.outcome_concepts.withColumn("domain_name", F.lit(None).cast("string"))
    return pipeline.extract_cohort(tm.tables(spark, sf_dir), replace(rules, outcome_concepts=raw), CONFIG, store=False).events


@register(
    "p7_filter_reproductive_age",
    "SELECT person_id, concept_id, event_date, min_month, max_month, round(age_at_event, 6) age_at_event FROM eligible",
)
def p7_filter_reproductive_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return cdm.filter_reproductive_age(s.cohort.timing, s.cohort.persons, CONFIG).select(
        "person_id", "concept_id", "event_date", "min_month", "max_month", r6("age_at_event")
    )


@register("p8_gestation_records", "SELECT person_id, concept_id, event_date, domain, weeks FROM gest")
def p8_gestation_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.gestation_records(stages(spark, sf_dir).cohort.events).select(
        "person_id", "concept_id", "event_date", "domain", "weeks"
    )


_SHIFTED = """(SELECT person_id, episode_id, inferred_episode_start episode_start_date,
  CASE WHEN episode_id % 7 = 0 THEN inferred_episode_end - 25569 ELSE inferred_episode_end END episode_end_date, gestational_age_days FROM study_eps)"""


def _shifted(spark: SparkSession, sf_dir: str) -> DataFrame:
    end = F.col("inferred_episode_end")
    return tm.study_episodes(spark, sf_dir).select(
        "person_id", "episode_id", F.col("inferred_episode_start").alias("episode_start_date"),
        F.when(F.col("episode_id") % 7 == 0, F.date_sub(end, 25569)).otherwise(end).alias("episode_end_date"),
        "gestational_age_days",
    )


@register(
    "p9_repair_epoch_shift",
    f"""SELECT * EXCLUDE (episode_end_date), CASE WHEN (year(episode_start_date) > 1970 AND year(episode_end_date) < 1960)
    OR episode_end_date < episode_start_date OR abs((episode_end_date - episode_start_date) - gestational_age_days) > 1000
  THEN episode_end_date + 25569 ELSE episode_end_date END episode_end_date FROM {_SHIFTED}""",
)
def p9_repair_epoch_shift(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cdm.repair_epoch_shift(_shifted(spark, sf_dir))


@register(
    "p10_check_episode_dates",
    f"""SELECT count(*) episodes, count(*) FILTER (episode_start_date < DATE '1900-01-01' OR episode_end_date < DATE '1900-01-01'
    OR episode_start_date > DATE '2001-01-01' OR episode_end_date > DATE '2001-01-01' + 365) invalid_dates,
  count(*) FILTER (abs((episode_end_date - episode_start_date) - gestational_age_days) < 2) matching_lengths FROM {_SHIFTED}""",
)
def p10_check_episode_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    import datetime as dt

    return cdm.check_episode_dates(_shifted(spark, sf_dir), dt.date(2001, 1, 1))


@register(
    "p11_shift_date",
    "SELECT o_orderkey, o_orderdate::DATE - 280 minus_280, o_orderdate::DATE + (o_orderkey % 100)::INT plus_some FROM orders",
)
def p11_shift_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    (orders,) = tm.read(spark, sf_dir, "orders")
    date = F.col("o_orderdate")
    return orders.select(
        "o_orderkey", dates.shift_date(date, -280).alias("minus_280"),
        dates.shift_date(date, F.col("o_orderkey") % 100).alias("plus_some"),
    )


# ---- outcome episodes -----------------------------------------------------------------------
def _sessions_out(df: DataFrame) -> DataFrame:
    return df.select(
        "person_id", "step", dates.date_of(F.col("outcome_day")).alias("outcome_date"), "outcome_category", "n_visits"
    )


@register(
    "h1_sessionize_outcomes",
    "SELECT person_id, session AS episode_number, outcome_date, outcome_category, n_visits FROM sessions WHERE step = 1",
)
def h1_sessionize_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t, rules = tm.tables(spark, sf_dir), tm.rules(spark)
    births = cdm.extract_domain(t, cdm.DOMAINS[0], rules.outcome_concepts, cdm.select_persons(t["person"], CONFIG))
    return outcomes.outcome_sessions(births, rules, ("LB",)).select(
        "person_id", F.col("session").alias("episode_number"),
        dates.date_of(F.col("outcome_day")).alias("outcome_date"), "outcome_category", "n_visits",
    )


@register(
    "h1_sessionize_all_groups",
    "SELECT person_id, step, outcome_date, outcome_category, n_visits FROM sessions",
)
def h1_sessionize_all_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return _sessions_out(outcomes.outcome_sessions(s.cohort.events, s.rules))


def _up_to(spark: SparkSession, sf_dir: str, last: int) -> DataFrame:
    s = stages(spark, sf_dir)
    kept = outcomes.outcome_sessions(s.cohort.events, s.rules).filter(F.col("step") <= last)
    for step in range(2, last + 1):
        kept = outcomes.apply_step(kept, step, s.rules)
    return _sessions_out(kept)


def _kept_sql(step: int) -> str:
    return f"SELECT person_id, step, outcome_date, outcome_category, n_visits FROM kept{step}"


register("h2_add_stillbirths", _kept_sql(2))(lambda spark, sf_dir: _up_to(spark, sf_dir, 2))
register("h3_add_ectopics", _kept_sql(3))(lambda spark, sf_dir: _up_to(spark, sf_dir, 3))
register("h4_add_abortions", _kept_sql(4))(lambda spark, sf_dir: _up_to(spark, sf_dir, 4))
register("h5_add_deliveries", _kept_sql(5))(lambda spark, sf_dir: _up_to(spark, sf_dir, 5))


@register(
    "h6_outcome_hierarchy",
    "SELECT person_id, episode_number, outcome_date, outcome_category, n_visits FROM outcomes",
)
def h6_outcome_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return outcomes.outcome_hierarchy(s.cohort.events, s.rules).select(
        "person_id", "episode_number", dates.date_of(F.col("outcome_day")).alias("outcome_date"),
        "outcome_category", "n_visits",
    )


def _with_gestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    gestation = outcomes.gestation_records(s.cohort.events)
    return outcomes.attach_gestation(outcomes.outcome_hierarchy(s.cohort.events, s.rules), gestation)


@register(
    "h7_attach_gestation",
    """SELECT person_id, episode_number, outcome_date, outcome_category, gestational_weeks, n_gest_records,
  gestational_weeks IS NOT NULL has_gestational_info FROM with_gest""",
)
def h7_attach_gestation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_gestation(spark, sf_dir).select(
        "person_id", "episode_number", dates.date_of(F.col("outcome_day")).alias("outcome_date"),
        "outcome_category", "gestational_weeks", "n_gest_records", "has_gestational_info",
    )


@register(
    "h8_gestation_only_episodes",
    "SELECT person_id, day_date(floor(outcome_day)) outcome_date, gestational_weeks, n_gest_records FROM gest_only",
)
def h8_gestation_only_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    gestation = outcomes.gestation_records(stages(spark, sf_dir).cohort.events)
    return outcomes.each_copy(outcomes.gestation_only_episodes(gestation)).select(
        "person_id", dates.date_of(F.col("outcome_day")).alias("outcome_date"), "gestational_weeks", "n_gest_records"
    )


def _all_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    gestation = outcomes.gestation_records(s.cohort.events)
    return outcomes.add_gestation_only(_with_gestation(spark, sf_dir), outcomes.gestation_only_episodes(gestation))


@register(
    "h8_add_gestation_only",
    "SELECT person_id, episode_number, outcome_day, outcome_category, gestational_weeks, n_gest_records FROM all_episodes",
)
def h8_add_gestation_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _all_episodes(spark, sf_dir).select(
        "person_id", "episode_number", "outcome_day", "outcome_category", "gestational_weeks", "n_gest_records"
    )


@register(
    "h9_start_dates",
    "SELECT person_id, episode_number, day_date(floor(start_day)) episode_start_date, outcome_category, ga gestational_age_days FROM started",
)
def h9_start_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return outcomes.start_from_gestation_or_term(_all_episodes(spark, sf_dir), s.rules).select(
        "person_id", "episode_number", dates.date_of(F.col("start_day")).alias("episode_start_date"),
        "outcome_category", "gestational_age_days",
    )


@register("h10_validate_and_clip", f"SELECT {_FINAL_SHORT} FROM hip")
def h10_validate_and_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return _short(outcomes.outcome_episodes(s.cohort.events, s.rules, CONFIG))


@register(
    "h11_rule_lookups",
    """SELECT e.episode_id, coalesce(s.min_days, 28) min_days_to_next, coalesce(t.min_term, 0) min_term, coalesce(t.max_term, 301) max_term,
  gestational_age_days BETWEEN coalesce(t.min_term, 0) AND coalesce(t.max_term, 301) valid_ga
FROM (SELECT *, lead(final_outcome_category) OVER (PARTITION BY person_id ORDER BY inferred_episode_end, episode_id) next_category FROM study_eps) e
LEFT JOIN lookup_spacing s ON s.first_preg_category = e.final_outcome_category AND s.outcome_preg_category = e.next_category
LEFT JOIN lookup_terms t ON t.category = e.final_outcome_category""",
)
def h11_rule_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = Window.partitionBy("person_id").orderBy("inferred_episode_end", "episode_id")
    category = F.col("final_outcome_category")
    low, high = rule_functions.term_bounds(category)
    return (
        tm.study_episodes(spark, sf_dir)
        .withColumn("next_category", F.lead("final_outcome_category").over(order))
        .select(
            "episode_id",
            rule_functions.min_days_between(category, F.col("next_category")).alias("min_days_to_next"),
            low.alias("min_term"), high.alias("max_term"),
            rule_functions.is_valid_ga(F.col("gestational_age_days"), category).alias("valid_ga"),
        )
    )


# ---- progression episodes -------------------------------------------------------------------
def _eligible(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return cdm.filter_reproductive_age(s.cohort.timing, s.cohort.persons, CONFIG)


@register(
    "g1_pair_compatibility",
    "SELECT person_id, s_run AS run, max(e_run) reaches_run FROM compatible WHERE e_run > s_run GROUP BY 1, 2",
)
def g1_pair_compatibility(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = progression.timing_blocks(_eligible(spark, sf_dir))
    return progression.pair_compatibility(blocks, stages(spark, sf_dir).rules.timing_span_days())


def _runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progression.runs_with_agreement(_eligible(spark, sf_dir), stages(spark, sf_dir).rules.timing_span_days())


@register(
    "g2_record_agreement",
    """SELECT person_id, run, min(event_date) first_date, max(event_date) last_date, count(*) n, arg_min(agrees, rid) agrees
FROM agreeing GROUP BY 1, 2""",
)
def g2_record_agreement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _runs(spark, sf_dir).select(
        "person_id", "run", dates.date_of(F.col("first_day")).alias("first_date"),
        dates.date_of(F.col("last_day")).alias("last_date"), "n", "agrees",
    )


@register(
    "g2_agreement_of_records",
    "SELECT person_id, concept_id, event_date, min_month, max_month, agrees, count(*) n FROM agreeing GROUP BY ALL",
)
def g2_agreement_of_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progression.agreement_of_records(_eligible(spark, sf_dir))


@register(
    "g3_assign_episodes",
    "SELECT person_id, run, max(raw_episode) person_episode_number, count(*) n FROM assigned GROUP BY 1, 2",
)
def g3_assign_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progression.assign_progression_episodes(_runs(spark, sf_dir)).select(
        "person_id", "run", "person_episode_number", "n"
    )


def _short_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return progression.drop_long_episodes(progression.assign_progression_episodes(_runs(spark, sf_dir)))


@register(
    "g4_drop_long_episodes",
    "SELECT person_id, run, max(person_episode_number) person_episode_number, count(*) n FROM short_episodes GROUP BY 1, 2",
)
def g4_drop_long_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _short_episodes(spark, sf_dir).select("person_id", "run", "person_episode_number", "n")


_RECORD = "person_id, concept_id, event_date, min_month, max_month"


@register("g3_record_episodes", f"SELECT {_RECORD}, run, raw_episode AS person_episode_number FROM assigned")
def g3_record_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    assigned = progression.assign_progression_episodes(_runs(spark, sf_dir))
    records = progression.of_records(_eligible(spark, sf_dir), assigned, "run", "person_episode_number")
    return records.select(*_RECORD.split(", "), "run", "person_episode_number")


@register("g4_record_episodes", f"SELECT {_RECORD}, person_episode_number FROM short_episodes")
def g4_record_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = progression.of_records(_eligible(spark, sf_dir), _short_episodes(spark, sf_dir), "person_episode_number")
    return records.select(*_RECORD.split(", "), "person_episode_number")


_BOUNDS = """person_id, person_episode_number, min_date, max_date, earliest_month, latest_month, n_gt_concepts AS "n_GT_concepts",
  n_records, day_date(floor(expected_end_day)) expected_end_date"""


def _bounds_out(df: DataFrame, *more: str) -> DataFrame:
    return df.select(
        "person_id", "person_episode_number", dates.date_of(F.col("min_day")).alias("min_date"),
        dates.date_of(F.col("max_day")).alias("max_date"), "earliest_month", "latest_month", "n_GT_concepts",
        "n_records", dates.date_of(F.col("expected_end_day")).alias("expected_end_date"), *more,
    )


@register("g5_progression_bounds", f"SELECT {_BOUNDS} FROM bounds")
def g5_progression_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bounds_out(progression.progression_bounds(_short_episodes(spark, sf_dir)))


@register("g6_progression_outcome", f"SELECT {_BOUNDS}, outcome_category, day_date(floor(outcome_day)) outcome_date FROM progressed")
def g6_progression_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    bounds = progression.progression_bounds(_short_episodes(spark, sf_dir))
    found = progression.progression_outcome(bounds, stages(spark, sf_dir).outcomes)
    return _bounds_out(found, "outcome_category", dates.date_of(F.col("outcome_day")).alias("outcome_date"))


@register("g7_validate_progression", f'SELECT {_FINAL_SHORT}, n_gt_concepts AS "n_GT_concepts", n_records FROM pps')
def g7_validate_progression(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    pps = progression.progression_episodes(_eligible(spark, sf_dir), s.outcomes, s.rules.timing_span_days(), CONFIG)
    return pps.select(
        "person_id", "episode_number", "episode_start_date", "episode_end_date", "outcome_category",
        r6("gestational_age_days"), "algorithm_used", "n_GT_concepts", "n_records",
    )


# ---- merge ----------------------------------------------------------------------------------
_WINDOW = """person_id, episode_number, episode_start_date, episode_end_date, lookback_date, expected_end_date, lookahead_date,
  window_start, window_end"""


@register(
    "m1_episode_windows",
    f"SELECT 'HIP' AS source, {_WINDOW} FROM hip_windows UNION ALL SELECT 'PPS', {_WINDOW} FROM pps_windows",
)
def m1_episode_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    columns = [c.strip() for c in _WINDOW.split(",")]
    hip = merge.episode_windows(s.hip).select(F.lit("HIP").alias("source"), *columns)
    return hip.unionByName(merge.episode_windows(s.pps).select(F.lit("PPS").alias("source"), *columns))


@register(
    "m2_episode_overlaps",
    """SELECT *, round(core_overlap_days / (hip_end - hip_start + 1), 6) hip_overlap_pct,
  round(core_overlap_days / (pps_end - pps_start + 1), 6) pps_overlap_pct,
  CASE WHEN core_overlap_days > 0 THEN 'core' WHEN window_overlap_days > 0 THEN 'window' ELSE 'none' END overlap_type
FROM (SELECT h.person_id, h.episode_number hip_episode_num, p.episode_number pps_episode_num, h.episode_start_date hip_start,
    h.episode_end_date hip_end, p.episode_start_date pps_start, p.episode_end_date pps_end,
    greatest(0, least(h.episode_end_date, p.episode_end_date) - greatest(h.episode_start_date, p.episode_start_date) + 1)::INT core_overlap_days,
    (least(h.window_end, p.window_end) - greatest(h.window_start, p.window_start) + 1)::INT window_overlap_days
  FROM hip_windows h JOIN pps_windows p ON h.person_id = p.person_id AND h.window_start <= p.window_end AND h.window_end >= p.window_start)""",
)
def m2_episode_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return merge.episode_overlaps(merge.episode_windows(s.hip), merge.episode_windows(s.pps)).select(
        "person_id", "hip_episode_num", "pps_episode_num", "hip_start", "hip_end", "pps_start", "pps_end",
        "core_overlap_days", "window_overlap_days", r6("hip_overlap_pct"), r6("pps_overlap_pct"), "overlap_type",
    )


@register(
    "m3_interval_full_join",
    """SELECT person_id, hip_id, pps_id, least(hip_start, pps_start, hip_end) merged_start, greatest(pps_end, hip_end) merged_end,
  round((greatest(pps_end, hip_end) - least(hip_start, pps_start, hip_end)) / 30.25, 6) merged_length_months, hip_dup, pps_dup FROM flagged""",
)
def m3_interval_full_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return merge.interval_full_join(s.hip, s.pps).select(
        "person_id", "hip_id", "pps_id", "merged_start", "merged_end", r6("merged_length_months"), "hip_dup", "pps_dup"
    )


@register("m4_one_to_one_match", "SELECT person_id, hip_id, pps_id, hip_start, hip_end, pps_start, pps_end FROM matched_pairs")
def m4_one_to_one_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return merge.one_to_one_match(merge.interval_full_join(s.hip, s.pps)).select(
        "person_id", "hip_id", "pps_id", "hip_start", "hip_end", "pps_start", "pps_end"
    )


@register(
    "m5_format_merged",
    """SELECT person_id, row_number() OVER (PARTITION BY person_id ORDER BY episode_start_date, hip_id NULLS FIRST, pps_id NULLS FIRST)::INT episode_number,
  episode_start_date, episode_end_date, hip_outcome AS "HIP_outcome_category", pps_outcome AS "PPS_outcome_category", hip_end AS "HIP_end_date",
  pps_end AS "PPS_end_date", outcome_category, gestational_age_days, algorithm_used, hip_id, pps_id FROM merged_raw""",
)
def m5_format_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return merge.format_merged(merge.one_to_one_match(merge.interval_full_join(s.hip, s.pps)))


_SIDE = """person_id, hip_id, pps_id, episode_start_date, episode_end_date, outcome_category, gestational_age_days, algorithm_used,
  lookback_date, lookahead_date"""
_SIDE_COLUMNS = [c.strip() for c in _SIDE.split(",")]


@register("m6_no_overlap_union", f"SELECT {_SIDE} FROM side_by_side")
def m6_no_overlap_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return merge.no_overlap_union(merge.episode_windows(s.hip), merge.episode_windows(s.pps)).select(*_SIDE_COLUMNS)


@register("m7_window_outcome_update", f"SELECT {_SIDE} FROM window_updated")
def m7_window_outcome_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    union = merge.no_overlap_union(merge.episode_windows(s.hip), merge.episode_windows(s.pps))
    return merge.window_outcome_update(union, s.outcomes).select(*_SIDE_COLUMNS)


_MERGED = "person_id, episode_number, episode_start_date, episode_end_date, outcome_category, gestational_age_days, algorithm_used"


@register("m8_finalize_episodes", f"SELECT {_MERGED}, hip_id, pps_id FROM merged")
def m8_finalize_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    formatted = merge.format_merged(merge.one_to_one_match(merge.interval_full_join(s.hip, s.pps)))
    return merge.finalize_episodes(formatted).select(*[c.strip() for c in _MERGED.split(",")], "hip_id", "pps_id")


_OUTPUT = """person_id, episode_number, episode_start_date recorded_episode_start, episode_end_date recorded_episode_end,
  round((episode_end_date - episode_start_date) / 30.25, 6) recorded_episode_length, episode_start_date, episode_end_date,
  hip_outcome AS "HIP_outcome_category", pps_outcome AS "PPS_outcome_category", hip_end AS "HIP_end_date", pps_end AS "PPS_end_date",
  (algorithm_used IN ('HIP', 'MERGED'))::INT AS "HIP_flag", (algorithm_used IN ('PPS', 'MERGED'))::INT AS "PPS_flag", outcome_category,
  gestational_age_days, algorithm_used"""


def _output(df: DataFrame) -> DataFrame:
    return df.withColumn("recorded_episode_length", F.round("recorded_episode_length", 6))


@register("m9_episode_output", f"SELECT {_OUTPUT} FROM merged")
def m9_episode_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return _output(merge.merge_matched(s.hip, s.pps))


@register(
    "m10_single_source",
    f"""SELECT {_OUTPUT} FROM (SELECT *, outcome_category hip_outcome, NULL::VARCHAR pps_outcome, episode_end_date hip_end, NULL::DATE pps_end FROM hip)""",
)
def m10_single_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return _output(merge.merge_episodes(s.hip, s.pps.filter("false"), s.outcomes))


# ---- dating ---------------------------------------------------------------------------------
def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return dating.timing_records(s.cohort.events, s.cohort.timing, s.rules)


_TIMED = "person_id, concept_id, event_date, concept_name, gest_value, value_as_number, min_month, max_month"
_TIMED_COLUMNS = [c.strip() for c in _TIMED.split(",")]


@register("e1_timing_records", f"SELECT {_TIMED} FROM timed")
def e1_timing_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _records(spark, sf_dir).select(*_TIMED_COLUMNS)


def _episode_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.timing_to_episode(dating.dated_records(_records(spark, sf_dir)), stages(spark, sf_dir).merged)


@register(
    "e2_timing_to_episode",
    """SELECT person_id, episode_number, gt_type AS "GT_type", implied_start, range_start, range_end, count(*) n FROM ep_timing GROUP BY ALL""",
)
def e2_timing_to_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _episode_timing(spark, sf_dir)


@register("e3_classify_timing", f'SELECT {_TIMED}, gt_type AS "GT_type" FROM typed')
def e3_classify_timing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.classify_timing(_records(spark, sf_dir)).select(*_TIMED_COLUMNS, "GT_type")


@register("e4_gestational_weeks", 'SELECT person_id, concept_id, event_date, gt_type AS "GT_type", gestational_weeks FROM weeked')
def e4_gestational_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.gestational_weeks(dating.classify_timing(_records(spark, sf_dir))).select(
        "person_id", "concept_id", "event_date", "GT_type", "gestational_weeks"
    )


@register("e5_implied_dates", 'SELECT person_id, concept_id, event_date, gt_type AS "GT_type", implied_start, range_start, range_end FROM implied')
def e5_implied_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = dating.gestational_weeks(dating.classify_timing(_records(spark, sf_dir)))
    return dating.implied_dates(records).select(
        "person_id", "concept_id", "event_date", "GT_type", "implied_start", "range_start", "range_end"
    )


@register("e6_interval_consensus", "SELECT * FROM consensus")
def e6_interval_consensus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.interval_consensus(_episode_timing(spark, sf_dir))


@register("e7_gw_outlier_filter", "SELECT person_id, episode_number, implied_start, count(*) n FROM gw_clean GROUP BY ALL")
def e7_gw_outlier_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.gw_outlier_filter(_episode_timing(spark, sf_dir))


@register(
    "e8_iqr_date_filter",
    """SELECT person_id, episode_number, implied_start, count(*) n FROM (
  SELECT *, quantile_cont(implied_start, 0.25) OVER w q1, quantile_cont(implied_start, 0.75) OVER w q3, count(*) OVER w total
  FROM gw WINDOW w AS (PARTITION BY person_id, episode_number))
WHERE total <= 2 OR implied_start BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) GROUP BY ALL""",
)
def e8_iqr_date_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.iqr_date_filter(_episode_timing(spark, sf_dir))


@register(
    "e9_range_midpoint",
    """SELECT person_id, episode_number,
  CASE WHEN max(range_start) <= min(range_end) THEN max(range_start) + trunc((min(range_end) - max(range_start)) / 2)
    ELSE median(range_start + trunc((range_end - range_start) / 2)) END midpoint,
  CASE WHEN max(range_start) <= min(range_end) THEN min(range_end) - max(range_start) ELSE 999 END::DOUBLE range_days
FROM ranges GROUP BY 1, 2""",
)
def e9_range_midpoint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.range_midpoint(_episode_timing(spark, sf_dir))


@register("e10_refine_start", "SELECT person_id, episode_number, inferred_start, precision_days FROM refined")
def e10_refine_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    timing = materialize(_episode_timing(spark, sf_dir))  # both parts read it
    return dating.refine_start(dating.gw_outlier_filter(timing), dating.interval_consensus(timing))


@register(
    "e11_precision_category",
    """SELECT precision_days, CASE WHEN precision_days = 999 THEN 'non-specific' WHEN precision_days = -1 THEN 'week_poor-support'
  WHEN precision_days <= 7 THEN 'week' WHEN precision_days <= 14 THEN 'two-week' WHEN precision_days <= 21 THEN 'three-week'
  WHEN precision_days <= 28 THEN 'month' WHEN precision_days <= 56 THEN 'two-month' WHEN precision_days <= 84 THEN 'three-month'
  ELSE 'non-specific' END precision_category, count(*) n
FROM (SELECT CASE WHEN o_orderkey % 97 = 0 THEN 999 ELSE o_orderkey % 95 - 1 END::DOUBLE precision_days FROM orders) GROUP BY ALL""",
)
def e11_precision_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    (orders,) = tm.read(spark, sf_dir, "orders")
    days = F.when(F.col("o_orderkey") % 97 == 0, 999).otherwise(F.col("o_orderkey") % 95 - 1).cast("double")
    return (
        orders.select(days.alias("precision_days"))
        .withColumn("precision_category", dates.precision_category(F.col("precision_days")))
        .groupBy("precision_days", "precision_category").agg(F.count(F.lit(1)).alias("n"))
    )


_DATED = "person_id, episode_number, episode_start_date, episode_end_date, outcome_category, gestational_age_days, precision_days, precision_category"
_DATED_COLUMNS = [c.strip() for c in _DATED.split(",")]


@register("e12_apply_refinement", f"SELECT {_DATED} FROM dated")
def e12_apply_refinement(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = stages(spark, sf_dir)
    return dating.date_episodes(s.merged, s.cohort.events, s.cohort.timing, s.rules, CONFIG).select(*_DATED_COLUMNS)


@register(
    "e13_bound_refined_dates",
    """SELECT person_id, episode_number, s AS episode_start_date, episode_end_date, (episode_end_date - s)::DOUBLE gestational_age_days FROM (
  SELECT *, CASE WHEN episode_start_date > episode_end_date OR episode_start_date < episode_end_date - 320 THEN episode_end_date - 280
    ELSE episode_start_date END s FROM final)""",
)
def e13_bound_refined_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dating.bound_refined_dates(stages(spark, sf_dir).final).select(
        "person_id", "episode_number", "episode_start_date", "episode_end_date", "gestational_age_days"
    )


@register(
    "e14_simple_start_dates",
    """SELECT episode_id, inferred_episode_end - coalesce(CASE WHEN episode_id % 2 = 0 THEN gestational_age_days END,
  CASE final_outcome_category WHEN 'LB' THEN 280 WHEN 'SB' THEN 280 WHEN 'DELIV' THEN 280 WHEN 'AB' THEN 91 WHEN 'SA' THEN 91
    WHEN 'ECT' THEN 63 WHEN 'PREG' THEN 140 ELSE 200 END) episode_start_date FROM study_eps""",
)
def e14_simple_start_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    episodes = tm.study_episodes(spark, sf_dir).select(
        "episode_id", F.col("inferred_episode_end").alias("episode_end_date"),
        F.col("final_outcome_category").alias("outcome_category"),
        F.when(F.col("episode_id") % 2 == 0, F.col("gestational_age_days")).cast("double").alias("gestational_age_days"),
    )
    return dating.simple_start_dates(episodes).select("episode_id", "episode_start_date")


# ---- summaries ------------------------------------------------------------------------------
@register(
    "a1_overall",
    """SELECT count(*) total_episodes, count(DISTINCT person_id) unique_persons,
  round(count(*) / count(DISTINCT person_id), 6) episodes_per_person FROM final""",
)
def a1_overall(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.overall_summary(stages(spark, sf_dir).final).withColumn(
        "episodes_per_person", F.round("episodes_per_person", 6)
    )


@register(
    "a1_by_outcome",
    """SELECT outcome_category, count(*) AS "count", round(count(*) / sum(count(*)) OVER () * 100, 6) pct,
  round(avg(gestational_age_days), 6) avg_gest_days FROM final GROUP BY 1""",
)
def a1_by_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.outcome_summary(stages(spark, sf_dir).final).select(
        "outcome_category", "count", r6("pct"), r6("avg_gest_days")
    )


@register(
    "a1_by_algorithm",
    """SELECT algorithm_used, count(*) AS "count", round(count(*) / sum(count(*)) OVER () * 100, 6) pct FROM final GROUP BY 1""",
)
def a1_by_algorithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.algorithm_summary(stages(spark, sf_dir).final).select("algorithm_used", "count", r6("pct"))


@register(
    "a1_gestational_age",
    """SELECT min(d) min_gest_days, quantile_cont(d, 0.25) q1_gest_days, median(d) median_gest_days, round(avg(d), 6) mean_gest_days,
  quantile_cont(d, 0.75) q3_gest_days, max(d) max_gest_days, round(stddev_samp(d), 6) sd_gest_days
FROM (SELECT gestational_age_days d FROM final)""",
)
def a1_gestational_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.length_summary(stages(spark, sf_dir).final).select(
        "min_gest_days", "q1_gest_days", "median_gest_days", r6("mean_gest_days"), "q3_gest_days", "max_gest_days",
        r6("sd_gest_days"),
    )


@register("a1_by_year", """SELECT year(episode_end_date)::INT AS "year", count(*) AS "count" FROM final GROUP BY 1""")
def a1_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.year_summary(stages(spark, sf_dir).final)


@register("a2_precision_summary", "SELECT precision_category, count(*) n FROM final GROUP BY 1")
def a2_precision_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.precision_summary(stages(spark, sf_dir).final)


@register("a2_outcome_by_algorithm", "SELECT outcome_category, algorithm_used, count(*) n FROM final GROUP BY 1, 2")
def a2_outcome_by_algorithm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.outcome_by_algorithm(stages(spark, sf_dir).final)


@register(
    "a3_person_summary",
    """SELECT person_id, count(*) episodes, min(episode_start_date) first_episode, max(episode_end_date) last_episode FROM final GROUP BY 1""",
)
def a3_person_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.person_summary(stages(spark, sf_dir).final)


@register(
    "a3_persons_overview",
    """SELECT count(*) persons, round(avg(n), 6) mean_episodes, max(n) max_episodes FROM (SELECT count(*) n FROM final GROUP BY person_id)""",
)
def a3_persons_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.persons_overview(stages(spark, sf_dir).final).select("persons", r6("mean_episodes"), "max_episodes")


@register("pipeline_episodes", f"SELECT {_DATED}, algorithm_used FROM final")
def pipeline_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship: extraction to dated episodes in one run."""
    episodes = pipeline.identify_episodes(tm.tables(spark, sf_dir), tm.rules(spark), CONFIG)
    return episodes.select(*_DATED_COLUMNS, "algorithm_used")
