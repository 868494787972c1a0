"""Reading clinical tables and extracting the event rows the episode operators use."""

from __future__ import annotations

import datetime as dt
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from care_episodes.config import EpisodeConfig
from care_episodes.functions.dates import age_years, parse_dates
from care_episodes.functions.primitives import join_growing
from care_episodes.functions.rules import Rules, concepts_of_domain

CDM_TABLES = (
    "person", "condition_occurrence", "procedure_occurrence", "observation", "measurement",
    "concept", "concept_relationship", "concept_ancestor", "visit_occurrence",
    "device_exposure", "observation_period",
)


@dataclass(frozen=True)
class Domain:
    """Where the rows of one clinical domain live.  `rank` orders rows of the same day."""

    name: str
    rank: int
    table: str
    concept_column: str
    date_column: str
    has_value: bool


DOMAINS = (
    Domain("Condition", 1, "condition_occurrence", "condition_concept_id", "condition_start_date", False),
    Domain("Procedure", 2, "procedure_occurrence", "procedure_concept_id", "procedure_date", False),
    Domain("Observation", 3, "observation", "observation_concept_id", "observation_date", True),
    Domain("Measurement", 4, "measurement", "measurement_concept_id", "measurement_date", True),
)

Tables = dict[str, DataFrame]


def read_cdm(
    spark: SparkSession,
    location: str,
    tables: tuple[str, ...] = CDM_TABLES,
    fmt: str = "parquet",
    jdbc: dict | None = None,
    partitions: int = 200,
) -> Tables:
    """Open the clinical tables lazily.

    `location` is a folder (one sub-folder or file per table), a catalog schema when
    fmt='table', or a database url when fmt='jdbc'.  Over JDBC every table that has person ids
    is read in `partitions` parallel ranges of them.
    """
    if fmt == "table":
        return {t: spark.table(f"{location}.{t}") for t in tables}
    if fmt == "jdbc":
        options = jdbc or {}
        schema = options.get("schema")
        plain = {k: v for k, v in options.items() if k != "schema"}

        def source(**more) -> DataFrame:
            # A reader keeps its options, so each table gets one of its own.
            return spark.read.format("jdbc").option("url", location).options(**plain, **more).load()

        person = f"{schema}.person" if schema else "person"
        low, high = source(query=f"select min(person_id) lo, max(person_id) hi from {person}").first()
        ranges = {} if low is None else {
            "partitionColumn": "person_id", "lowerBound": low, "upperBound": high + 1, "numPartitions": partitions,
        }
        return {
            t: source(dbtable=f"{schema}.{t}" if schema else t, **({} if t.startswith("concept") else ranges)) for t in tables
        }
    options = {"header": True} if fmt == "csv" else {}
    suffix = "" if fmt in ("parquet", "orc", "delta") else f".{fmt}"
    return {
        t: spark.read.format(fmt).options(**options).load(f"{location}/{t}{suffix}") for t in tables
    }


PERSON_DEFAULTS = {
    "month_of_birth": 1, "day_of_birth": 1, "race_concept_id": 0, "ethnicity_concept_id": 0,
}
EVENT_TYPES = {
    "person_id": "bigint", "concept_id": "bigint", "event_date": "date", "concept_name": "string",
    "category": "string", "gest_value": "double", "value_as_number": "double", "value_as_string": "string",
}
TYPES_BY_DOMAIN = {
    "person": {
        "person_id": "bigint", "gender_concept_id": "int", "year_of_birth": "int",
        "month_of_birth": "int", "day_of_birth": "int", "race_concept_id": "int",
        "ethnicity_concept_id": "int",
    },
    "condition": EVENT_TYPES,
    "procedure": EVENT_TYPES,
    "observation": EVENT_TYPES,
    "measurement": EVENT_TYPES,
    "gestational": {
        "person_id": "bigint", "concept_id": "bigint", "event_date": "date", "domain_name": "string",
        "value_as_number": "double", "value_as_string": "string", "min_month": "int", "max_month": "int",
    },
}


def enforce_types(df: DataFrame, domain: str) -> DataFrame:
    """Lower-case names, cast to the domain's types, fill the person defaults."""
    df = df.toDF(*[c.lower() for c in df.columns])
    types = TYPES_BY_DOMAIN.get(domain)
    if types is None:
        types = {c: "bigint" for c, t in df.dtypes if t == "string" and c.endswith("_id")}
        types |= {c: "date" for c, t in df.dtypes if t == "string" and c.endswith("_date")}
        types |= {c: "int" for c, t in df.dtypes if t == "boolean"}
    for name, kind in types.items():
        if kind == "date" and name in df.columns:
            df = parse_dates(df, name)

    def typed(name: str) -> Column:
        kind = types.get(name)
        if kind is None:
            return F.col(name)
        col = F.col(name)
        if kind == "date":
            return col
        source = dict(df.dtypes)[name]
        col = col.try_cast(kind) if source == "string" else col.cast(kind)
        if domain == "person" and name in PERSON_DEFAULTS:
            col = F.coalesce(col, F.lit(PERSON_DEFAULTS[name]))
        return col.alias(name)

    out = [typed(c) for c in df.columns]
    if domain == "gestational":
        out += [F.lit(None).cast("int").alias(c) for c in ("min_month", "max_month") if c not in df.columns]
    return df.select(*out)


def check_contract(df: DataFrame, required: dict[str, str]) -> list[str]:
    """Missing columns are an error; columns of another type are warned about and returned."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    have = dict(df.dtypes)
    wrong = [f"{c}: {have[c]} instead of {kind}" for c, kind in required.items() if have[c] != kind]
    for line in wrong:
        warnings.warn(line, stacklevel=2)
    return wrong


def select_persons(person: DataFrame, config: EpisodeConfig) -> DataFrame:
    """Distinct persons of the gender set whose age in the year of `as_of` is in range."""
    year = config.as_of.year
    return (
        person.filter(
            F.col("gender_concept_id").isin(*config.gender_concepts)
            & F.col("year_of_birth").between(year - config.max_age, year - config.min_age)
        )
        .select(
            "person_id", "gender_concept_id", "year_of_birth", "month_of_birth", "day_of_birth",
            "race_concept_id", "ethnicity_concept_id",
            (F.lit(year) - F.col("year_of_birth")).alias("age_current"),
        )
        .distinct()
    )


def _events(table: DataFrame, domain: Domain) -> DataFrame:
    """One clinical table in the common event layout, without code-list columns."""
    none = F.lit(None)
    number, text = none.cast("double"), none.cast("string")
    if domain.has_value:
        number = F.col("value_as_number").cast("double")
        text = F.col(
            "value_as_concept_id" if domain.name == "Measurement" else "value_as_string"
        ).cast("string")
    return table.filter(F.col(domain.date_column).isNotNull()).select(
        "person_id",
        F.col(domain.concept_column).cast("bigint").alias("concept_id"),
        F.col(domain.date_column).cast("date").alias("event_date"),
        F.lit(domain.name).alias("domain"),
        number.alias("value_as_number"),
        text.alias("value_as_string"),
    )


_LIST_COLUMNS = (("concept_name", "string"), ("category", "string"), ("gest_value", "double"))


#: Code lists up to this size also filter by value.
MOST_LISTED = 20_000


def with_codes(events: DataFrame, codes: DataFrame) -> DataFrame:
    """Events on a code list, with the columns of the list.

    The codes also go into a filter, because Spark moves a filter down to the scan: below the joins that
    a clinical view may be made of, which then shuffle listed rows only.  It moves no join below them.  A very
    long list is left to the join, which decides in either case.
    """
    ids = [r.concept_id for r in codes.select("concept_id").distinct().limit(MOST_LISTED + 1).collect()]
    if len(ids) <= MOST_LISTED:
        events = events.filter(F.col("concept_id").isin(ids))
    return events.join(codes, "concept_id")


def _listed(tables: Tables, domain: Domain, concepts: DataFrame) -> DataFrame:
    """Rows of one domain whose concept is on the list, with the columns of the list."""
    listed = concepts_of_domain(concepts, domain.name).select(
        "concept_id", "concept_name", "category", "gest_value"
    )
    return (
        with_codes(_events(tables[domain.table], domain), listed)
        .select(
            "person_id", "concept_id", "event_date", "domain", "concept_name", "category",
            "gest_value", "value_as_number", "value_as_string",
        )
    )


def extract_domain(
    tables: Tables, domain: Domain, concepts: DataFrame, persons: DataFrame
) -> DataFrame:
    """Rows of one domain whose concept is on the list and whose person is in the cohort.

    The code list comes first: it is small enough for Spark to broadcast and removes nearly all
    rows before anything has to be shuffled for the person filter.
    """
    return _of_persons(_listed(tables, domain, concepts), persons)


def _of_persons(events: DataFrame, persons: DataFrame) -> DataFrame:
    """Events of the cohort's persons.

    An inner join with distinct ids, not a semi join: a semi join is pushed below the code-list
    join and would shuffle the whole clinical table by person.
    """
    return join_growing(events, persons.select("person_id").distinct(), "person_id")


def extract_by_ids(
    tables: Tables, domain: Domain, concepts: DataFrame, person_ids: DataFrame
) -> DataFrame:
    """The same rows for an explicit list of persons (a DataFrame with `person_id`)."""
    return extract_domain(tables, domain, concepts, person_ids.select("person_id").distinct())


def union_domains(tables: Tables, rules: Rules, persons: DataFrame) -> DataFrame:
    """Extracted rows of all four domains as one DataFrame, with one person filter for all."""
    out = None
    for domain in DOMAINS:
        part = _listed(tables, domain, rules.outcome_concepts)
        out = part if out is None else out.unionByName(part)
    return _of_persons(out, persons)


def extract_listed(
    tables: Tables, rules: Rules, persons: DataFrame, config: EpisodeConfig
) -> DataFrame:
    """P4 and P6 in one pass: every clinical table is scanned once and joined with both code lists.

    `listed_outcome` and `listed_timing` tell which list a row is on; `outcome_rows` and
    `timing_rows` take the two results apart again.
    """
    timing = rules.timing_concepts.select(
        "concept_id", *[F.lit(None).cast(t).alias(c) for c, t in _LIST_COLUMNS], "min_month", "max_month",
        F.lit(False).alias("listed_outcome"), F.lit(True).alias("listed_timing"),
    )
    out = None
    for domain in DOMAINS:
        codes = concepts_of_domain(rules.outcome_concepts, domain.name).select(
            "concept_id", *[c for c, _ in _LIST_COLUMNS],
            *[F.lit(None).cast("double").alias(c) for c in ("min_month", "max_month")],
            F.lit(True).alias("listed_outcome"), F.lit(False).alias("listed_timing"),
        )
        if domain.name != "Measurement" or config.timing_from_measurement:
            # A row per concept: both lists hold a concept once.
            codes = codes.unionByName(timing)
            codes = codes.groupBy("concept_id").agg(*[F.max(c).alias(c) for c in codes.columns[1:]])
        part = with_codes(_events(tables[domain.table], domain), codes)
        out = part if out is None else out.unionByName(part)
    return _of_persons(out, persons)


def outcome_rows(listed: DataFrame) -> DataFrame:
    """P6 from rows extracted in one pass."""
    return listed.filter("listed_outcome").select(
        "person_id", "concept_id", "event_date", "domain", "concept_name", "category",
        "gest_value", "value_as_number", "value_as_string",
    )


def timing_rows(listed: DataFrame, config: EpisodeConfig) -> DataFrame:
    """P4 from rows extracted in one pass."""
    return _with_months(listed.filter("listed_timing"), config)


def _with_months(timing: DataFrame, config: EpisodeConfig) -> DataFrame:
    if not config.fractional_months:
        for c in ("min_month", "max_month"):
            timing = timing.withColumn(c, F.col(c).cast("int").cast("double"))
    return timing.select(
        "person_id", "concept_id", "event_date", F.col("domain").alias("domain_name"),
        "value_as_number", "value_as_string", "min_month", "max_month",
    )


def extract_timing(
    tables: Tables, rules: Rules, persons: DataFrame, config: EpisodeConfig
) -> DataFrame:
    """Condition, procedure and observation rows on the timing list, with their months."""
    months = rules.timing_concepts.select("concept_id", "min_month", "max_month")
    out = None
    for domain in DOMAINS:
        if domain.name == "Measurement" and not config.timing_from_measurement:
            continue
        part = with_codes(_events(tables[domain.table], domain), months)
        out = part if out is None else out.unionByName(part)
    return _with_months(_of_persons(out, persons), config)


def filter_reproductive_age(
    timing: DataFrame, persons: DataFrame, config: EpisodeConfig
) -> DataFrame:
    """Timing rows at an age of at least 15 and below 56 years."""
    birth = persons.select("person_id", "year_of_birth", "month_of_birth", "day_of_birth")
    age = age_years(
        F.col("event_date"), F.col("year_of_birth"), F.col("month_of_birth"), F.col("day_of_birth")
    )
    return (
        join_growing(timing, birth, "person_id")
        .withColumn("age_at_event", age)
        .filter(
            (F.col("age_at_event") >= config.timing_min_age)
            & (F.col("age_at_event") < config.timing_max_age)
        )
        .drop("year_of_birth", "month_of_birth", "day_of_birth")
    )


def repair_epoch_shift(df: DataFrame) -> DataFrame:
    """Add 25569 days to end dates that lost the difference between two date epochs."""
    days = F.datediff("episode_end_date", "episode_start_date")
    shifted = (
        ((F.year("episode_start_date") > 1970) & (F.year("episode_end_date") < 1960))
        | (days < 0)
        | (F.abs(days - F.col("gestational_age_days")) > 1000)
    )
    return df.withColumn(
        "episode_end_date",
        F.when(shifted, F.date_add("episode_end_date", 25569)).otherwise(F.col("episode_end_date")),
    )


def invalid_dates(df: DataFrame, as_of: dt.date) -> DataFrame:
    """P10: episodes with a missing or impossible date."""
    start, end, oldest = F.col("episode_start_date"), F.col("episode_end_date"), F.lit("1900-01-01").cast("date")
    today = F.lit(as_of).cast("date")
    return df.filter(
        start.isNull() | end.isNull() | (start < oldest) | (end < oldest)
        | (start > today) | (end > F.date_add(today, 365))
    )


def check_episode_dates(df: DataFrame, as_of: dt.date) -> DataFrame:
    """P10: one row counting episodes, impossible dates and dates that fit the stated length."""
    start, end = F.col("episode_start_date"), F.col("episode_end_date")
    today, oldest = F.lit(as_of).cast("date"), F.lit("1900-01-01").cast("date")
    bad = (
        start.isNull() | end.isNull() | (start < oldest) | (end < oldest)
        | (start > today) | (end > F.date_add(today, 365))
    )
    fits = F.abs(F.datediff(end, start) - F.col("gestational_age_days")) < 2
    return df.agg(
        F.count(F.lit(1)).alias("episodes"),
        F.count_if(bad).alias("invalid_dates"),
        F.count_if(fits).alias("matching_lengths"),
    )
