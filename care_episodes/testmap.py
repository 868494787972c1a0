"""The driver's sales tables seen as clinical tables.

The test tables are not clinical.  This maps them to the layout the operators read: customers
become persons, orders become conditions and visits, line items become measurements,
observations and procedures.  Every view covers its whole source table; rows that are not meant
to be found carry concept 0, which is on no list.
"""

from __future__ import annotations

import datetime as dt
from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from care_episodes.config import EpisodeConfig
from care_episodes.functions.primitives import join_growing
from care_episodes.functions.rules import OUTCOME_CONCEPT_SCHEMA, TIMING_CONCEPT_SCHEMA, Rules
from care_episodes.session import small_table
from care_episodes.sources.cdm import Tables

AS_OF = dt.date(2001, 12, 31)
CONFIG = EpisodeConfig(as_of=AS_OF)

OUTCOME_ROWS = [
    *[(1000 + i, f"Live birth {i}", "Condition", "LB", None) for i in range(5)],
    (1005, "Stillbirth", "Condition", "SB", None),
    (1006, "Ectopic pregnancy", "Condition", "ECT", None),
    (1007, "Induced abortion", "Condition", "AB", None),
    (1008, "Termination", "Condition", "AB", None),
    (1009, "Miscarriage", "Condition", "SA", None),
    (1010, "Delivery", "Condition", "DELIV", None),
    (1011, "Normal delivery", "Condition", "DELIV", None),
    *[(1012 + i, f"Pregnant {i}", "Condition", "PREG", None) for i in range(3)],
    (1015, "Gestation period, 30 weeks", "Condition", "GEST", 30.0),
    (1050, "Delivery procedure", "Procedure", "DELIV", None),
    (2011, "Gestation period, 36 weeks", "Observation", "GEST", None),
    (3048230, "Gestational age in weeks", "Measurement", "GEST", None),
]
TIMING_MONTHS = [
    (1.0, 4.0), (1.0, 3.0), (2.0, 2.0), (2.5, 2.5), (3.75, 5.5), (4.0, 7.0),
    (5.0, 5.0), (6.0, 8.0), (6.0, 9.0), (7.25, 7.25), (8.0, 11.0), (9.0, 9.0),
]
TIMING_ROWS = [
    *[(2000 + i, f"Timing {i}", low, high, "Medium") for i, (low, high) in enumerate(TIMING_MONTHS)],
    (1015, "Gestation period, 30 weeks", 7.5, 7.5, "Medium"),
    (1050, "Delivery procedure", 9.0, 10.0, "Medium"),
]
PHENOTYPES = {"hdp": [1016], "mi": [1017], "stroke": [1018], "hf": [1019], "htn": [1014], "dm": [1013]}


def read(spark: SparkSession, sf_dir: str, *names: str) -> list[DataFrame]:
    return [spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names]


def day(col: str) -> Column:
    return F.to_date(F.col(col))


def person(spark: SparkSession, sf_dir: str) -> DataFrame:
    (customer,) = read(spark, sf_dir, "customer")
    key = F.col("c_custkey")
    return customer.select(
        key.alias("person_id"),
        F.when(F.col("c_mktsegment") == "MACHINERY", 0).otherwise(8532).alias("gender_concept_id"),
        (1940 + key % 50).cast("int").alias("year_of_birth"),
        F.when(key % 10 != 0, 1 + key % 12).cast("int").alias("month_of_birth"),
        (1 + key % 28).cast("int").alias("day_of_birth"),
        F.when(key % 7 != 0, F.col("c_nationkey")).cast("int").alias("race_concept_id"),
        F.lit(None).cast("int").alias("ethnicity_concept_id"),
    )


def condition_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    (orders,) = read(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").alias("person_id"),
        (1000 + F.col("o_orderkey") % 20).alias("condition_concept_id"),
        day("o_orderdate").alias("condition_start_date"),
    )


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders, lineitem = read(spark, sf_dir, "orders", "lineitem")
    return join_growing(lineitem, orders, F.col("l_orderkey") == F.col("o_orderkey"))


def procedure_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = (F.col("l_returnflag") == "R") & (F.col("l_linenumber") == 1) & (F.col("l_partkey") % 5 == 0)
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").alias("person_id"),
        F.when(listed, 1050).otherwise(0).cast("bigint").alias("procedure_concept_id"),
        day("l_shipdate").alias("procedure_date"),
    )


def observation(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = (F.col("l_linenumber") == 1) & (F.col("l_orderkey") % 4 == 0)
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").alias("person_id"),
        F.when(listed, 2000 + F.col("l_partkey") % 12).otherwise(0).cast("bigint").alias("observation_concept_id"),
        day("l_shipdate").alias("observation_date"),
        F.lit(None).cast("double").alias("value_as_number"),
        F.col("l_linestatus").alias("value_as_string"),
    )


def measurement(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(
        F.col("o_custkey").alias("person_id"),
        F.when(F.col("l_partkey") % 10 == 0, 3048230)
        .when(F.col("l_partkey") % 10 == 1, 3025315)
        .when(F.col("l_partkey") % 10 == 2, 3036277)
        .otherwise(0).cast("bigint").alias("measurement_concept_id"),
        day("l_shipdate").alias("measurement_date"),
        F.when(F.col("l_partkey") % 10 == 1, F.col("l_quantity") + 45)
        .when(F.col("l_partkey") % 10 == 2, F.col("l_quantity") * 3 + 80)
        .otherwise(F.col("l_quantity")).alias("value_as_number"),
        F.col("l_suppkey").alias("value_as_concept_id"),
    )


def observation_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    (orders,) = read(spark, sf_dir, "orders")
    return orders.groupBy(F.col("o_custkey").alias("person_id")).agg(
        F.min(day("o_orderdate")).alias("observation_period_start_date"),
        F.max(day("o_orderdate")).alias("observation_period_end_date"),
    )


def visit_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    (orders,) = read(spark, sf_dir, "orders")
    return orders.select(
        F.col("o_custkey").alias("person_id"),
        (9200 + F.substring("o_orderpriority", 1, 1).cast("int")).cast("bigint").alias("visit_concept_id"),
        day("o_orderdate").alias("visit_start_date"),
    )


def concept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary table: parts as source codes (ICD) that map to condition concepts."""
    (part,) = read(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("concept_id"),
        F.concat_ws("", F.lit("C"), (F.col("p_partkey") % 40).cast("string")).alias("concept_code"),
        F.col("p_name").alias("concept_name"),
        F.when(F.col("p_size") % 2 == 0, "ICD10CM").otherwise("SNOMED").alias("vocabulary_id"),
        F.when(F.col("p_size") % 3 == 0, "Condition").otherwise("Procedure").alias("domain_id"),
    )


def concept_relationship(spark: SparkSession, sf_dir: str) -> DataFrame:
    (part,) = read(spark, sf_dir, "part")
    return part.select(
        F.col("p_partkey").alias("concept_id_1"),
        ((F.col("p_partkey") * 7) % 1999).alias("concept_id_2"),
        F.when(F.col("p_partkey") % 3 == 0, "Is a").otherwise("Maps to").alias("relationship_id"),
    )


def concept_ancestor(spark: SparkSession, sf_dir: str) -> DataFrame:
    (part,) = read(spark, sf_dir, "part")
    return part.select(
        (1000 + F.col("p_partkey") % 20).alias("ancestor_concept_id"),
        (1000 + F.col("p_size") % 20).cast("bigint").alias("descendant_concept_id"),
    )


def tables(spark: SparkSession, sf_dir: str) -> Tables:
    makers = (
        person, condition_occurrence, procedure_occurrence, observation, measurement,
        observation_period, visit_occurrence, concept, concept_relationship, concept_ancestor,
    )
    return {m.__name__: m(spark, sf_dir) for m in makers}


def rules(spark: SparkSession) -> Rules:
    return Rules(
        outcome_concepts=small_table(spark, OUTCOME_ROWS, OUTCOME_CONCEPT_SCHEMA),
        timing_concepts=small_table(spark, TIMING_ROWS, TIMING_CONCEPT_SCHEMA),
    )


def concept_set(spark: SparkSession, *names: str) -> DataFrame:
    ids = sorted(set(chain.from_iterable(PHENOTYPES[n] for n in names)))
    return small_table(spark, [(i,) for i in ids], "concept_id long")


OUTCOME_OF_ORDER = (
    "LB", "LB", "LB", "LB", "LB", "SB", "ECT", "AB", "AB", "SA",
    "DELIV", "DELIV", "PREG", "PREG", "PREG", "LB", "LB", "SB", "DELIV", "LB",
)
PRECISION_OF_ORDER = (
    "week", "two-week", "three-week", "month", "two-month", "three-month", "week_poor-support", "non-specific",
)


def outcome_of_order() -> Column:
    names = F.array(*[F.lit(v) for v in OUTCOME_OF_ORDER])
    return F.element_at(names, (F.col("o_orderkey") % 20 + 1).cast("int"))


def study_episodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Finished episodes as the study takes them: one per order, with the given score columns."""
    (orders,) = read(spark, sf_dir, "orders")
    length = (100 + F.col("o_orderkey") % 230).cast("int")
    precision = F.array(*[F.lit(v) for v in PRECISION_OF_ORDER])
    return (
        orders.withColumns({"end": day("o_orderdate"), "ga": length})
        .select(
            F.col("o_custkey").alias("person_id"),
            F.col("o_orderkey").alias("episode_id"),
            F.date_sub("end", F.col("ga")).alias("inferred_episode_start"),
            F.col("end").alias("inferred_episode_end"),
            F.col("ga").alias("gestational_age_days"),
            outcome_of_order().alias("final_outcome_category"),
            F.element_at(precision, (F.col("o_orderkey") % 8 + 1).cast("int")).alias("precision_category"),
            (F.col("o_orderkey") % 3).cast("int").alias("outcome_concordance_score"),
            (F.col("ga") < 259).cast("int").alias("preterm"),
        )
    )


QUESTIONS = {0: "race_eth", 1: "income", 2: "education", 3: "pregnancy"}
ANSWERS = {
    0: ("White", "Black", "Hispanic, Other", "Asian, White"),
    1: ("less10k", "25k35k", "more200k", "PreferNotToAnswer"),
    2: ("CollegeGraduate", "TwelveOrGED", "AdvancedDegree", "NeverAttended"),
    3: ("Yes", "No", "DontKnow", "No"),
}


def survey(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Survey answers: one row per order, the question and answer by its key."""
    (orders,) = read(spark, sf_dir, "orders")
    key, number = F.col("o_orderkey"), F.floor(F.col("o_orderkey") / 4) % 4
    answers = F.array(*[F.array(*[F.lit(a) for a in ANSWERS[q]]) for q in range(4)])
    question = (key % 4).cast("int")
    return orders.select(
        F.col("o_custkey").alias("person_id"),
        F.element_at(F.array(*[F.lit(QUESTIONS[q]) for q in range(4)]), question + 1).alias("question"),
        F.element_at(F.element_at(answers, question + 1), (number + 1).cast("int")).alias("answer"),
        day("o_orderdate").alias("survey_date"),
        key.alias("response_id"),
    )


def registry(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Registry pregnancies with running counts, deliveries, and the two id tables."""
    (orders, customer) = read(spark, sf_dir, "orders", "customer")
    kind = outcome_of_order()
    order = Window.partitionBy("o_custkey").orderBy("o_orderdate", "o_orderkey")

    def count(*names: str) -> Column:
        return F.sum(F.when(kind.isin(*names), 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))

    pregnancies = orders.select(
        (F.col("o_custkey") + 500000).alias("emrn"),
        F.date_sub(day("o_orderdate"), 280).alias("estimated_start"),
        F.date_add(day("o_orderdate"), (F.col("o_orderkey") % 41 - 20).cast("int")).alias("estimated_end"),
        F.row_number().over(order).alias("gravida_count"),
        count("LB", "SB", "DELIV").alias("para_count"),
        count("AB", "SA").alias("abortion_count"),
        F.lit(0).cast("bigint").alias("therapeutic_count"),
        count("SA").alias("spontaneous_count"),
        count("ECT").alias("ectopic_count"),
    )
    deliveries = orders.filter(kind.isin("LB", "SB", "DELIV")).select(
        (F.col("o_custkey") + 500000).alias("emrn"),
        F.col("o_orderkey").alias("delivery_id"),
        F.when(F.col("o_orderkey") % 11 != 0, 140 + F.col("o_orderkey") % 160).cast("double").alias("gestational_age_days"),
        F.when(F.col("o_orderkey") % 9 != 0, (F.col("o_orderkey") % 5 != 0).cast("int")).cast("double").alias("born_alive"),
        F.when(F.col("o_orderkey") % 13 == 0, "Stillborn").alias("living_status"),
    )
    emrn_cohort = customer.select(
        (F.col("c_custkey") + 500000).alias("emrn"), (F.col("c_custkey") + 900000).alias("cohort_id")
    )
    cohort_person = customer.select(
        (F.col("c_custkey") + 900000).alias("cohort_id"), F.col("c_custkey").alias("person_id")
    )
    return pregnancies, deliveries, emrn_cohort, cohort_person
