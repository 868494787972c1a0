"""Writing results."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from care_episodes.operators.report import episode_summary

ANALYSIS_VERSION = "2.0.0"


def with_run_columns(
    episodes: DataFrame, as_of: dt.date, runtime_seconds: float | None = None
) -> DataFrame:
    out = episodes.withColumn("analysis_date", F.lit(as_of).cast("date")).withColumn(
        "analysis_version", F.lit(ANALYSIS_VERSION)
    )
    if runtime_seconds is not None:
        out = out.withColumn("runtime_seconds", F.lit(float(runtime_seconds)))
    return out


def write_episodes(
    episodes: DataFrame,
    as_of: dt.date,
    path: str | None = None,
    table: str | None = None,
    fmt: str = "parquet",
    runtime_seconds: float | None = None,
) -> None:
    """Append the episodes, stamped with date and version of the run, to a table or folder."""
    if (path is None) == (table is None):
        raise ValueError("give either a path or a table")
    writer = with_run_columns(episodes, as_of, runtime_seconds).write.mode("append").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if table is not None:
        writer.saveAsTable(table)
    else:
        writer.save(path)


def write_summary(episodes: DataFrame, folder: str, as_of: dt.date) -> list[str]:
    """The summary tables of the episodes, one CSV folder each."""
    paths = []
    for name, table in episode_summary(episodes).items():
        path = f"{folder}/pregnancy_summary_{as_of:%Y%m%d}_{name}"
        table.write.mode("overwrite").option("header", True).csv(path)
        paths.append(path)
    return paths


def export_for_analysis(
    episodes: DataFrame, folder: str, as_of: dt.date, formats: tuple[str, ...] = ("csv",)
) -> list[str]:
    """One export folder per format, named after the day."""
    paths = []
    for fmt in formats:
        path = f"{folder}/pregnancy_analysis_{as_of:%Y%m%d}_{fmt}"
        writer = episodes.write.mode("overwrite").format(fmt)
        (writer.option("header", True) if fmt == "csv" else writer).save(path)
        paths.append(path)
    return paths


def to_cohort(episodes: DataFrame, cohort_id: int = 1) -> DataFrame:
    """Cohort rows, ordered by subject and start."""
    return episodes.select(
        F.col("person_id").alias("subject_id"),
        F.col("episode_start_date").alias("cohort_start_date"),
        F.col("episode_end_date").alias("cohort_end_date"),
        F.lit(cohort_id).alias("cohort_definition_id"),
    ).orderBy("subject_id", "cohort_start_date")
