"""Registered queries against their reference SQL, on the given tables and on a skewed copy.

In the skewed copy a third of all orders (and with them of all events) belong to one person.
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from check_oracle import rows_of

SOURCE = "/root/testdata/sf0.001"
TABLES = ("customer", "orders", "lineitem", "part")
SQL = oracle_sql()
PLAIN = [
    "s2_load_outcome_concepts", "s12_parse_dates", "s14_check_concept_coverage", "p1_select_persons",
    "p6_union_domains", "h6_outcome_hierarchy", "h10_validate_and_clip", "g2_record_agreement",
    "g7_validate_progression", "m4_one_to_one_match", "m7_window_outcome_update", "m9_episode_output",
    "e6_interval_consensus", "e12_apply_refinement", "a1_by_outcome", "v4_match_episodes", "v9_validation_summary",
    "k2_closest_episode_to_survey", "k13_concept_set_events_all", "k22_first_episode", "t2_kaplan_meier", "t3_log_rank",
    "t4_incidence_rate_ci", "t5_cox_ph", "t5_ph_test", "t6_logistic_or", "t6_logistic_profile",
]
SKEWED = [
    "h1_sessionize_all_groups", "h6_outcome_hierarchy", "h8_gestation_only_episodes", "h10_validate_and_clip",
    "g1_pair_compatibility", "g3_assign_episodes", "g7_validate_progression", "m4_one_to_one_match",
    "e12_apply_refinement", "k13_concept_set_events_all", "k14_set_summary", "v4_match_episodes",
    "v3_derive_registry_outcome", "v4_match_by_order", "k13_measurements_before", "k13_visit_ever_before", "k23_exposure_pattern",
    "g2_agreement_of_records", "k23_exposure_transitions", "k25_closest_measurement", "k26_max_measurement_after", "t1_table_one_numbers",
]
if os.environ.get("ALL_QUERIES"):
    PLAIN = SKEWED = list(SQL)

pytestmark = pytest.mark.skipif(not os.path.isdir(SOURCE), reason="test tables are not here")


@pytest.fixture(scope="session")
def skewed(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("skewed"))
    for name in TABLES:
        df = spark.read.parquet(f"{SOURCE}/{name}.parquet")
        if name == "orders":
            hot = F.xxhash64("o_orderkey") % 3 == 0
            df = df.withColumn("o_custkey", F.when(hot, 51).otherwise(F.col("o_custkey")))
        df.coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def same(spark, name, folder):
    df = queries()[name](spark, folder)
    got = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    for table in TABLES:
        path = f"{folder}/{table}.parquet"
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{source}'")
    result = con.execute(SQL[name])
    want = rows_of([c[0] for c in result.description], result.fetchall())
    assert rows_of(df.columns, got) == want


@pytest.mark.parametrize("name", PLAIN)
def test_given_tables(spark, name):
    same(spark, name, SOURCE)


@pytest.mark.parametrize("name", SKEWED)
def test_one_person_with_a_third_of_the_rows(spark, skewed, name):
    same(spark, name, skewed)


def test_every_query_is_named_after_its_operator():
    names = queries()
    ids = {n.split("_")[0] for n in names}
    for letter, last in (("s", 15), ("p", 11), ("h", 11), ("g", 7), ("m", 10), ("e", 14), ("a", 3), ("v", 9), ("k", 31), ("t", 7)):
        for i in range(1, last + 1):
            assert f"{letter}{i}" in ids
