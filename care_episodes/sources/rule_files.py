"""Loading rule tables and code lists that a user keeps in CSV files."""

from __future__ import annotations

import warnings
from pathlib import PurePosixPath
from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from care_episodes.functions import fixed_values as fv
from care_episodes.functions import rules as r
from care_episodes.functions.primitives import join_growing
from care_episodes.session import small_table


def _read(spark: SparkSession, path: str) -> DataFrame:
    """A code list as strings, in file order (`_row`).  Quoted fields may span lines."""
    df = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return df.withColumn("_row", F.monotonically_increasing_id())


def _require(df: DataFrame, columns: list[str], what: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns in {what}: {', '.join(missing)}")


def _first_per_concept(df: DataFrame) -> DataFrame:
    first = F.row_number().over(Window.partitionBy("concept_id").orderBy("_row"))
    return df.withColumn("_n", first).filter("_n = 1").drop("_n", "_row")


def _text(df: DataFrame, name: str):
    value = F.col(name) if name in df.columns else F.lit(None)
    return F.when(value.cast("string") != "NA", value.cast("string"))


def clean_outcome_concepts(raw: DataFrame) -> DataFrame:
    """Required columns, types, first row per concept; `domain` is read as `domain_name`."""
    if "_row" not in raw.columns:
        raw = raw.withColumn("_row", F.monotonically_increasing_id())
    _require(raw, ["concept_id", "concept_name", "category"], "the outcome concepts")
    domain = "domain" if "domain" in raw.columns else "domain_name"
    return _first_per_concept(
        raw.select(
            F.col("concept_id").cast("bigint").alias("concept_id"),
            F.col("concept_name").cast("string").alias("concept_name"),
            _text(raw, domain).alias("domain_name"),
            F.col("category").cast("string").alias("category"),
            _text(raw, "gest_value").cast("double").alias("gest_value"),
            "_row",
        )
    )


def load_outcome_concepts(spark: SparkSession, path: str) -> DataFrame:
    """Outcome code list from a file, with a warning for categories nobody knows."""
    out = clean_outcome_concepts(_read(spark, path))
    unknown = unknown_categories(out)
    found = unknown.agg(F.count(F.lit(1)), F.sum("concepts"), F.min("category")).first()
    if found[0]:
        warnings.warn(
            f"{found[0]} unexpected outcome categories on {found[1]} concepts, {found[2]} for one; unknown_categories() lists all",
            stacklevel=2,
        )
    return out


def unknown_categories(concepts: DataFrame) -> DataFrame:
    """Categories of a code list that no rule knows, with the number of their concepts."""
    known = F.coalesce(F.col("category").isin(*fv.OUTCOME_CHOICE_ORDER), F.lit(False))
    return concepts.filter(~known).groupBy("category").agg(F.count(F.lit(1)).alias("concepts"))


def clean_timing_concepts(raw: DataFrame) -> DataFrame:
    """S3: timing list with months in 0..12 and in order; first row per concept."""
    if "_row" not in raw.columns:
        raw = raw.withColumn("_row", F.monotonically_increasing_id())
    for long, short in (("domain_concept_id", "concept_id"), ("domain_concept_name", "concept_name")):
        if long in raw.columns:
            raw = raw.withColumn(short, F.col(long))
    _require(raw, ["concept_id", "concept_name", "min_month", "max_month"], "the timing concepts")
    certainty = F.col("certainty").cast("string") if "certainty" in raw.columns else F.lit("Medium")
    return _first_per_concept(
        raw.select(
            F.col("concept_id").cast("bigint").alias("concept_id"),
            F.col("concept_name").cast("string").alias("concept_name"),
            F.col("min_month").cast("double").alias("min_month"),
            F.col("max_month").cast("double").alias("max_month"),
            certainty.alias("certainty"),
            "_row",
        ).filter("min_month >= 0 AND max_month <= 12 AND min_month <= max_month")
    )


def load_timing_concepts(spark: SparkSession, path: str | None = None) -> DataFrame:
    """S3: timing list from a file, else the published one."""
    return r.default_timing_concepts(spark) if path is None else clean_timing_concepts(_read(spark, path))


def _paths(spark: SparkSession, path: str, names: str = "*") -> list[str]:
    """Files at `path` (a file or folder), in order; their content is not read.  None if nothing is there."""
    try:
        rows = spark.read.format("binaryFile").option("pathGlobFilter", names).load(path).select("path").collect()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted(r["path"] for r in rows)


def _exists(spark: SparkSession, path: str) -> bool:
    return bool(_paths(spark, path))


def load_term_limits(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Term limits ordered by hierarchy; defaults when the file or a column is missing.

    A spacing table given here by mistake is passed through as it is.
    """
    if path is None or not _exists(spark, path):
        return r.default_term_limits(spark).orderBy("hierarchy")
    raw = _read(spark, path)
    if "min_days" in raw.columns:
        return raw.drop("_row").withColumn("min_days", F.col("min_days").cast("int"))
    if not {"category", "min_term", "max_term"} <= set(raw.columns):
        warnings.warn("term limits lack columns, using the defaults", stacklevel=2)
        return r.default_term_limits(spark).orderBy("hierarchy")
    by_row = F.row_number().over(Window.orderBy("_row"))
    rank = F.col("hierarchy").cast("int") if "hierarchy" in raw.columns else by_row
    return raw.select(
        "category", F.col("min_term").cast("int").alias("min_term"),
        F.col("max_term").cast("int").alias("max_term"), rank.alias("hierarchy"),
    ).orderBy("hierarchy")


def load_spacing(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Minimum days between outcome pairs."""
    if path is None:
        return r.default_spacing(spark)
    raw = _read(spark, path)
    _require(raw, ["first_preg_category", "outcome_preg_category", "min_days"], "the spacing table")
    return raw.select(
        "first_preg_category", "outcome_preg_category", F.col("min_days").cast("int").alias("min_days")
    )


def load_term_durations(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Term durations with the retry time of each outcome."""
    if path is None or not _exists(spark, path):
        return r.default_term_durations(spark)
    raw = _read(spark, path)
    _require(raw, ["category", "max_term", "min_term", "retry"], "the term durations")
    days = [F.col(c).cast("int").alias(c) for c in ("max_term", "min_term", "retry")]
    return raw.select("category", *days)


def load_rules(
    spark: SparkSession,
    outcome_path: str,
    timing_path: str | None = None,
    term_path: str | None = None,
    spacing_path: str | None = None,
    vocabulary: DataFrame | None = None,
) -> r.Rules:
    """All rules of a run.  With the vocabulary table missing domains are filled in at once;
    the pipeline does so otherwise."""
    outcomes = load_outcome_concepts(spark, outcome_path)
    return r.Rules(
        outcome_concepts=outcomes if vocabulary is None else enrich_domains(outcomes, vocabulary),
        timing_concepts=load_timing_concepts(spark, timing_path),
        spacing=r.spacing_literals(load_spacing(spark, spacing_path)),
        max_term=r.max_term_literals(load_term_limits(spark, term_path)),
    )


def rules_summary(rules: r.Rules) -> DataFrame:
    """Size of each list, one row."""
    outcomes = rules.outcome_concepts.agg(
        F.count(F.lit(1)).alias("outcome_concepts"),
        F.count_distinct("category").alias("outcome_categories"),
        F.count_distinct("domain_name").alias("outcome_domains"),
        F.lit(0).cast("bigint").alias("timing_concepts"),
    )
    timing = rules.timing_concepts.agg(
        F.lit(0).cast("bigint").alias("outcome_concepts"),
        F.lit(0).cast("bigint").alias("outcome_categories"),
        F.lit(0).cast("bigint").alias("outcome_domains"),
        F.count(F.lit(1)).alias("timing_concepts"),
    )
    both = outcomes.unionByName(timing)
    return both.agg(*[F.sum(c).alias(c) for c in both.columns]).withColumns(
        {
            "term_categories": F.lit(len(rules.max_term)).cast("bigint"),
            "spacing_pairs": F.lit(len(rules.spacing)).cast("bigint"),
        }
    )


def load_concept_sets(spark: SparkSession, files: dict[str, str]) -> DataFrame:
    """Phenotype code lists, given as {set name: path}, as one (set_name, concept_id, domain).

    Three layouts are known by their columns: a vocabulary-browser export (`Id`), a mapped code
    list (`concept_id_2`) and a list of descendants (`descendant_concept_id`).
    """
    parts = []
    for name, path in files.items():
        raw = _read(spark, path)
        id_column = next(
            (c for c in ("Id", "descendant_concept_id", "concept_id_2", "concept_id") if c in raw.columns), None
        )
        if id_column is None:
            raise ValueError(f"no concept id column in {path}")
        domain = next((c for c in ("Domain", "domain_id") if c in raw.columns), None)
        parts.append(
            raw.select(
                F.lit(name).alias("set_name"),
                F.col(id_column).try_cast("bigint").alias("concept_id"),
                (F.col(domain) if domain else F.lit(None).cast("string")).alias("domain"),
            ).filter("concept_id IS NOT NULL")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.distinct()


def load_concept_set_folder(spark: SparkSession, folder: str) -> DataFrame:
    """Every CSV file of a folder as a concept set named after the file."""
    files = {PurePosixPath(unquote(p)).stem: unquote(p) for p in _paths(spark, folder, "*.csv")}
    return load_concept_sets(spark, files)


def check_concept_coverage(outcomes: DataFrame, timing: DataFrame) -> DataFrame:
    """What the code lists lack, as rows (issue, value).

    Issues: missing_category, missing_domain, uncovered_stage (early, mid, late) and overlap for
    a concept on both lists.  Lists are valid if nothing but overlaps is reported.
    """
    spark = outcomes.sparkSession

    def missing(expected: tuple[str, ...], column: str, issue: str) -> DataFrame:
        want = small_table(spark, [(v,) for v in expected], f"{column} string")
        return want.join(outcomes, column, "left_anti").select(
            F.lit(issue).alias("issue"), F.col(column).alias("value")
        )

    covered = timing.agg(
        F.bool_or(F.col("min_month") <= 3).alias("early"),
        F.bool_or((F.col("min_month") <= 6) & (F.col("max_month") >= 6)).alias("mid"),
        F.bool_or(F.col("max_month") >= 9).alias("late"),
    )
    stages = covered.unpivot([], ["early", "mid", "late"], "value", "ok").filter(
        ~F.coalesce(F.col("ok"), F.lit(False))
    )
    overlap = outcomes.select("concept_id").intersect(timing.select("concept_id"))
    return (
        missing(fv.OUTCOME_CHOICE_ORDER, "category", "missing_category")
        .unionByName(missing(fv.DOMAINS, "domain_name", "missing_domain"))
        .unionByName(stages.select(F.lit("uncovered_stage").alias("issue"), "value"))
        .unionByName(
            overlap.select(F.lit("overlap").alias("issue"), F.col("concept_id").cast("string").alias("value"))
        )
    )


def coverage_is_valid(report: DataFrame) -> bool:
    return report.filter("issue <> 'overlap'").isEmpty()


def enrich_domains(concepts: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """Fill a missing domain from the vocabulary table."""
    known = vocabulary.select("concept_id", F.col("domain_id").alias("_domain")).distinct()
    return (
        join_growing(concepts, known, "concept_id", "left")
        .withColumn("domain_name", F.coalesce("domain_name", "_domain"))
        .drop("_domain")
    )


def unmapped_concepts(enriched: DataFrame) -> DataFrame:
    """Concepts that still have no domain."""
    return enriched.filter("domain_name IS NULL").select("concept_id", "concept_name")
